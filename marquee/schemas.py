"""Fixed table layouts: staging files, star schema, documents, snapshot catalogue."""

from __future__ import annotations

from pyspark.sql import types as T

# Staging files, their columns in file order and the longest text each may hold
# (None = unlimited).
STAGING_COLUMNS = {
    "title_basics": [
        ("tconst", 10), ("titletype", 50), ("primarytitle", 500), ("originaltitle", 500),
        ("isadult", 1), ("startyear", 10), ("endyear", 10), ("runtimeminutes", 10), ("genres", None),
    ],
    "name_basics": [
        ("nconst", 10), ("primaryname", 200), ("birthyear", 10), ("deathyear", 10),
        ("primaryprofession", None), ("knownfortitles", None),
    ],
    "title_ratings": [("tconst", 10), ("averagerating", 10), ("numvotes", 20)],
    "title_crew": [("tconst", 10), ("directors", None), ("writers", None)],
    "title_principals": [
        ("tconst", 10), ("ordering", 10), ("nconst", 10), ("category", 100), ("job", None), ("characters", None),
    ],
    "title_episode": [("tconst", 10), ("parenttconst", 10), ("seasonnumber", 10), ("episodenumber", 10)],
    "title_akas": [
        ("titleid", 10), ("ordering", 10), ("title", None), ("region", 10), ("language", 10),
        ("types", None), ("attributes", None), ("isoriginaltitle", 1),
    ],
}

# File name of each staging table.
STAGING_FILES = {
    "title_basics": "title.basics.tsv",
    "name_basics": "name.basics.tsv",
    "title_ratings": "title.ratings.tsv",
    "title_crew": "title.crew.tsv",
    "title_principals": "title.principals.tsv",
    "title_episode": "title.episode.tsv",
    "title_akas": "title.akas.tsv",
}

# Allowed title types and crew roles.
TITLE_TYPES = ["movie", "short", "tvseries", "tvepisode", "video", "tvMovie", "tvShort", "tvMiniSeries", "tvSpecial"]
CREW_TYPES = ["director", "writer"]

# Star schema as DDL, without the audit columns.
STAR_DDL = {
    "titles": "tconst string, title_type string, primary_title string, original_title string, is_adult boolean, "
              "start_year smallint, end_year smallint, runtime_minutes int",
    "people": "nconst string, primary_name string, birth_year smallint, death_year smallint",
    "ratings": "tconst string, average_rating decimal(3,1), num_votes bigint",
    "episodes": "episode_tconst string, parent_tconst string, season_number smallint, episode_number int",
    "genres": "genre_id int, genre_name string, description string",
    "categories": "category_id int, category_name string, description string",
    "title_genres": "tconst string, genre_id int, genre_order smallint",
    "title_principals": "tconst string, ordering smallint, nconst string, category_id int, job string, "
                        "characters string",
    "title_crew": "tconst string, nconst string, crew_type string",
}

# Keys, required columns, allowed values and references of the star schema.
PRIMARY_KEYS = {
    "titles": ["tconst"], "people": ["nconst"], "ratings": ["tconst"], "episodes": ["episode_tconst"],
    "genres": ["genre_id"], "categories": ["category_id"],
}
UNIQUE_KEYS = {"genres": ["genre_name"], "categories": ["category_name"]}
REQUIRED = {
    "titles": ["title_type", "primary_title"],
    "people": ["primary_name"],
    "ratings": ["average_rating", "num_votes"],
    "episodes": ["parent_tconst"],
    "genres": ["genre_name"],
    "categories": ["category_name"],
    "title_genres": ["tconst", "genre_id", "genre_order"],
    "title_principals": ["tconst", "ordering", "nconst", "category_id"],
    "title_crew": ["tconst", "nconst", "crew_type"],
}
ALLOWED = {("titles", "title_type"): TITLE_TYPES, ("title_crew", "crew_type"): CREW_TYPES}
# (child table, child column, parent table, parent column, removing the parent removes the child)
FOREIGN_KEYS = [
    ("ratings", "tconst", "titles", "tconst", True),
    ("episodes", "episode_tconst", "titles", "tconst", True),
    ("episodes", "parent_tconst", "titles", "tconst", True),
    ("title_genres", "tconst", "titles", "tconst", True),
    ("title_genres", "genre_id", "genres", "genre_id", True),
    ("title_principals", "tconst", "titles", "tconst", True),
    ("title_principals", "nconst", "people", "nconst", True),
    ("title_principals", "category_id", "categories", "category_id", False),
    ("title_crew", "tconst", "titles", "tconst", True),
    ("title_crew", "nconst", "people", "nconst", True),
]

# Fields of one snapshot-catalogue record, in the order they are registered.
CATALOGUE_FIELDS = [
    "fecha", "hora", "tipo_backup", "direccion_almacenamiento", "maestro_usado", "metodo", "stanza",
]


def staging_schema(table: str) -> T.StructType:
    """All-text schema of one staging table."""
    return T.StructType([T.StructField(name, T.StringType()) for name, _ in STAGING_COLUMNS[table]])


def staging_names(table: str) -> list[str]:
    return [name for name, _ in STAGING_COLUMNS[table]]

