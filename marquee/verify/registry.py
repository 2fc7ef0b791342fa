"""Every operator as a named query over the driver tables, flattened to scalar columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schemas as S
from marquee.functions import columns as X
from marquee.operators import backups as B
from marquee.operators import clean as C
from marquee.operators import digests as DG
from marquee.operators import documents as D
from marquee.operators import integrity as I
from marquee.operators import normalize as N
from marquee.operators import rankings as RK
from marquee.operators import search as SE
from marquee.operators import snapshots as SN
from marquee.operators import text_index as TI
from marquee.operators import upsert as U
from marquee.plans import directors as PD
from marquee.plans import films as PF
from marquee.session import ensure_shared_dir, shared_path, tune
from marquee.sinks import layout, publish
from marquee.sources import catalogue as SC
from marquee.sources import tsv
from marquee.streaming import ingest as ST
from marquee.verify import shapes as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The search terms and names used below; the SQL twins name the same ones.
DIRECTOR = "Person 10"
DIRECTOR_RAW = " Person 10"
PHRASE = "October urgent"
AS_OF = "2024-01-16 00:00:00"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(tune(spark), folder)

    QUERIES[fn.__name__] = run
    return run


def _wide(df: DataFrame) -> DataFrame:
    """Small integers as bigint and decimals as double, so both engines report one type."""
    cols = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("smallint", "int", "tinyint"):
            c = c.cast("bigint").alias(name)
        elif kind.startswith("decimal"):
            c = c.cast("double").alias(name)
        cols.append(c)
    return df.select(*cols)


def _joined(c: str | Column, sep: str = ",") -> Column:
    return F.array_join(c, sep)


def _ratio(c: Column) -> Column:
    """A share as whole millionths, so no engine's last digit matters."""
    return F.floor(c * 1_000_000 + 0.5).cast("bigint")


# --- staging text ----------------------------------------------------------------------------


def _title_lines(spark: SparkSession, folder: str) -> DataFrame:
    raw = V.titles_raw(spark, folder)
    fields = [F.coalesce(F.replace(F.col(c), F.lit(" "), F.lit("\\t")), F.lit(X.NULL_MARK)) for c in raw.columns]
    line = F.concat_ws("\t", *fields)
    # Some lines lose their last field and some have one more, as a broken export would.
    short, wide = F.concat_ws("\t", *fields[:-1]), F.concat(line, F.lit("\tmore"))
    return raw.select(F.when(F.col("isadult") == "1", short).when(F.endswith("tconst", F.lit("9")), wide).otherwise(line).alias("value"))


@query
def tsv_rows(spark, folder):
    names = S.staging_names("title_basics")
    cut = tsv.cut(_title_lines(spark, folder), names, escapes=True)
    good = cut.filter(F.col("_width") == len(names))
    return good.select(*[F.replace(F.col(c), F.lit("\t"), F.lit("~")).alias(c) for c in names])


@query
def tsv_rejects(spark, folder):
    names = S.staging_names("title_basics")
    cut = tsv.cut(_title_lines(spark, folder), names)
    return cut.filter(F.col("_width") != len(names)).select(
        F.replace("value", F.lit("\t"), F.lit("|")).alias("value"), F.col("_width").cast("bigint").alias("fields"))


def _plain_lines(raw: DataFrame) -> DataFrame:
    fields = [F.coalesce(F.col(c), F.lit(X.NULL_MARK)) for c in raw.columns]
    return raw.select(F.concat_ws("\t", *fields).alias("value"))


@query
def tsv_extra_na(spark, folder):
    raw = V.akas_raw(spark, folder)
    return tsv.cut(_plain_lines(raw), raw.columns, extra_na=["NA"]).select(*raw.columns)


def _write_text(lines: DataFrame, heading: str, path: str, encoding: str = "UTF-8") -> None:
    """Lines as text files, each with a heading of its own wording."""
    plain = {"sep": tsv.NO_SEPARATOR[0], "quote": "", "escape": "", "lineSep": "\n", "encoding": encoding,
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines.select(F.col("value").alias(heading)).write.options(header="true", **plain).csv(path)


@query
def staging_files(spark, folder):
    """Written as text and read back: escapes, a header by position, latin-1, a missing file."""
    ensure_shared_dir(spark)
    root = shared_path(spark, "text")
    titles, akas = V.titles_raw(spark, folder), V.akas_raw(spark, folder)
    escaped = titles.withColumn("primarytitle", F.replace("primarytitle", F.lit(" "), F.lit("\\t")))
    _write_text(_plain_lines(escaped), "any heading", f"{root}/basics")
    accented = _plain_lines(akas.withColumn("title", F.concat("title", F.lit(" caf\u00e9"))))
    _write_text(accented, "other heading", f"{root}/akas", "ISO-8859-1")
    read = {
        "title_basics": (tsv.read_staging(spark, f"{root}/basics", "title_basics", strict=True), "genres", "primarytitle"),
        "title_akas": (tsv.read_staging(spark, f"{root}/akas", "title_akas", encoding="ISO-8859-1"), "region", "title"),
        "title_ratings": (tsv.read_staging(spark, f"{root}/none", "title_ratings"), "numvotes", "tconst"),
    }
    parts = [df.agg(F.count(F.lit(1)).alias("rows"), F.count(c).alias("filled"), F.sum(F.length(t)).alias("letters"))
             .select(F.lit(name).alias("table"), "rows", "filled", "letters") for name, (df, c, t) in read.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def staging_continued(spark, folder):
    """Titles whose spaces are written as a backslash and a line feed: records over several lines, read back whole."""
    ensure_shared_dir(spark)
    path = shared_path(spark, "continued")
    broken = V.titles_raw(spark, folder).withColumn("primarytitle", F.replace("primarytitle", F.lit(" "), F.lit("\\\n")))
    _plain_lines(broken).write.text(path)
    read = tsv.read_staging(spark, path, "title_basics", header=False, continued=True)
    return read.select("tconst", F.replace("primarytitle", F.lit("\n"), F.lit(" ")).alias("title"),
                       F.length("primarytitle").cast("bigint").alias("letters"))


@query
def staging_append(spark, folder):
    ensure_shared_dir(spark)
    path = shared_path(spark, "staging")
    ratings = V.ratings_raw(spark, folder)
    tsv.write_staging(ratings, path)
    tsv.write_staging(ratings, path, append=True)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("tconst").alias("keys"))


@query
def literal_regions(spark, folder):
    areas = tsv.literal_rows(spark, [("AFRICA", "south"), ("ASIA", "east"), ("EUROPE", "north")], "r_name string, area string")
    regions, nations = V.table(spark, folder, "region"), V.table(spark, folder, "nation")
    return areas.join(regions, "r_name").join(nations, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name", "area").agg(
        F.count(F.lit(1)).alias("nations"))


@query
def key_page(spark, folder):
    return C.key_page(V.names_raw(spark, folder), "nconst", "nm0000100", 50).select("nconst")


@query
def key_range(spark, folder):
    return C.key_range(V.titles_raw(spark, folder), "tconst", "tt0000100", "tt0000900").select("tconst", "titletype")


# --- cleaning and star schema ----------------------------------------------------------------


@query
def titles_clean(spark, folder):
    return _wide(C.clean_titles(V.titles_raw(spark, folder)))


@query
def titles_clean_all_types(spark, folder):
    return _wide(C.clean_titles(V.titles_raw(spark, folder), keep_all_types=True))


@query
def people_clean(spark, folder):
    return _wide(C.clean_people(V.names_raw(spark, folder)))


def _titles(spark, folder):
    return C.clean_titles(V.titles_raw(spark, folder))


def _people(spark, folder):
    return C.clean_people(V.names_raw(spark, folder))


@query
def ratings_clean(spark, folder):
    return _wide(C.clean_ratings(V.ratings_raw(spark, folder), _titles(spark, folder)))


@query
def genres_dim(spark, folder):
    return _wide(N.genres_dim(V.titles_raw(spark, folder)))


@query
def title_genres_bridge(spark, folder):
    raw = V.titles_raw(spark, folder)
    return _wide(N.title_genres(raw, N.genres_dim(raw), C.clean_titles(raw)))


@query
def categories_dim(spark, folder):
    return _wide(N.categories_dim(V.principals_raw(spark, folder)))


@query
def title_principals_bridge(spark, folder):
    raw = V.principals_raw(spark, folder)
    return _wide(N.title_principals(raw, N.categories_dim(raw), _titles(spark, folder), _people(spark, folder)))


@query
def title_crew_bridge(spark, folder):
    return N.title_crew(V.crew_raw(spark, folder), _titles(spark, folder), _people(spark, folder))


@query
def episodes_clean(spark, folder):
    return _wide(N.episodes(V.episodes_raw(spark, folder), _titles(spark, folder)))


@query
def akas_table(spark, folder):
    return _wide(N.akas(V.akas_raw(spark, folder)))


@query
def table_counts(spark, folder):
    return I.table_counts(N.build_star(V.staging(spark, folder)))


# --- director reports over the star schema ---------------------------------------------------


@query
def director_info(spark, folder):
    return _wide(PD.director_info(N.build_star(V.staging(spark, folder)), DIRECTOR))


@query
def director_movies(spark, folder):
    return _wide(PD.director_movies(N.build_star(V.staging(spark, folder)), DIRECTOR))


def _sql(spark, folder, call: str) -> DataFrame:
    PD.register_views(spark, N.build_star(V.staging(spark, folder)))
    PD.register_functions(spark)
    return _wide(spark.sql(f"SELECT * FROM {call}"))


@query
def director_info_sql(spark, folder):
    return _sql(spark, folder, f"get_director_info('{DIRECTOR}')")


@query
def director_movies_sql(spark, folder):
    return _sql(spark, folder, f"get_director_movies('{DIRECTOR}')")


# --- documents -------------------------------------------------------------------------------


def _title_docs(spark, folder, *parts: str) -> DataFrame:
    """Title documents with the named parts embedded."""
    docs = D.title_base(V.titles_raw(spark, folder))
    if "rating" in parts:
        docs = D.embed(docs, D.rating_part(V.ratings_raw(spark, folder)))
    if "crew" in parts:
        docs = D.embed(docs, D.crew_part(V.crew_raw(spark, folder)))
    if "episode" in parts:
        docs = D.embed(docs, D.episode_part(V.episodes_raw(spark, folder)))
    if "principals" in parts:
        docs = D.embed_principals(docs, V.principals_raw(spark, folder))
    return docs


def _people_docs(spark, folder):
    return D.people_docs(V.names_raw(spark, folder))


@query
def embed_rating(spark, folder):
    docs = _title_docs(spark, folder, "rating")
    return docs.select("tconst", F.col("rating.average").alias("average"), F.col("rating.votes").alias("votes"))


@query
def embed_crew(spark, folder):
    docs = _title_docs(spark, folder, "crew")
    return docs.select("tconst", _joined("crew.directors").alias("directors"), _joined("crew.writers").alias("writers"))


def _unfolded(docs: DataFrame) -> DataFrame:
    rows = docs.select("tconst", "page", "titleType", F.posexplode("principals").alias("pos", "p"))
    return _wide(rows.select("tconst", "page", "pos", "titleType", "p.ordering", "p.nconst", "p.category", "p.job",
                             _joined("p.characters", "/").alias("characters")))


@query
def embed_principals(spark, folder):
    return _unfolded(_title_docs(spark, folder, "principals"))


@query
def embed_principals_paged(spark, folder):
    base = D.title_base(V.titles_raw(spark, folder))
    return _unfolded(D.embed_principals(base, V.principals_raw(spark, folder), page_size=3))


@query
def embed_principals_ranked(spark, folder):
    """Cast entries without an ordering, or with one that repeats, in pages of three."""
    cast = V.principals_raw(spark, folder)
    line = F.col("ordering").cast("int")
    cast = cast.withColumn("ordering", F.when(line % 3 == 0, None).when(line % 3 == 1, F.lit("9")).otherwise(F.col("ordering")))
    return _unfolded(D.embed_principals(D.title_base(V.titles_raw(spark, folder)), cast, page_size=3, pages_by="rank"))


@query
def embed_episode(spark, folder):
    docs = _title_docs(spark, folder, "episode")
    return _wide(docs.select("tconst", "parent_tconst", "season_number", "episode_number"))


def _title_facts(docs: DataFrame) -> DataFrame:
    return _wide(docs.select(
        "tconst", "page", "titleType", "startYear", _joined("genres").alias("genres"),
        F.col("rating.votes").alias("votes"), F.size("crew.directors").alias("directors"),
        "parent_tconst", F.size("principals").alias("principals")))


@query
def title_documents(spark, folder):
    return _title_facts(D.build_documents(V.staging(spark, folder))["titles"])


@query
def title_documents_paged(spark, folder):
    return _title_facts(D.build_documents(V.staging(spark, folder), page_size=3)["titles"])


@query
def documents_loaded_twice(spark, folder):
    """A second load of titles, ratings, crew and episodes, with gaps, changes nothing."""
    staging = V.staging(spark, folder)
    again = {"title_basics": "genres", "title_ratings": "numvotes", "title_crew": "writers", "title_episode": "seasonnumber"}
    for table, gap in again.items():
        staging[table] = staging[table].unionByName(staging[table].withColumn(gap, F.lit(None).cast("string")))
    return _title_facts(D.build_documents(staging)["titles"])


@query
def people_documents(spark, folder):
    docs = _people_docs(spark, folder)
    return _wide(docs.select("nconst", "primaryName", "birthYear", _joined("primaryProfession").alias("professions"),
                             F.size("knownForTitles").alias("known_for")))


@query
def json_records(spark, folder):
    return D.to_json_records(_people_docs(spark, folder))


@query
def collapse_last_non_null(spark, folder):
    raw = V.principals_raw(spark, folder).withColumn("ordering", F.col("ordering").cast("int"))
    return _wide(U.collapse_last_non_null(raw, ["tconst"], ["ordering", "nconst"]))


@query
def collapse_akas(spark, folder):
    raw = V.akas_raw(spark, folder).withColumn("ordering", F.col("ordering").cast("int"))
    return _wide(U.collapse_last_non_null(raw, ["titleid"], ["ordering", "title"]))


@query
def character_lists(spark, folder):
    raw = V.principals_raw(spark, folder).select(
        "category",
        _joined(X.json_list(F.col("characters")), "/").alias("as_json"),
        _joined(X.stripped_list(F.col("characters")), "/").alias("as_split"),
        F.size(X.json_list(F.col("characters"))).cast("bigint").alias("n"))
    return raw.groupBy("category", "as_json", "as_split", "n").agg(F.count(F.lit(1)).alias("rows"))


@query
def crew_positions(spark, folder):
    docs = _title_docs(spark, folder, "crew").filter(F.size("crew.directors") > 0)
    d = F.col("crew.directors")
    return docs.select(
        "tconst", F.size(d).cast("bigint").alias("n"), X.nth(d, 0).alias("first"), X.nth(d, 1).alias("second"),
        X.index_of(d, X.nth(d, 1)).cast("bigint").alias("second_at"),
        _joined(F.transform(d, lambda x: F.lower(F.substring(x, 3, 20)))).alias("numbers"))


# --- reports over documents ------------------------------------------------------------------


def _section(name: str, rows: Column, fields: Callable[[Column], tuple]) -> Column:
    """Entries of one list of a report as (section, a, b) structs."""

    def entry(x: Column) -> Column:
        first, second = fields(x)
        return F.struct(F.lit(name).alias("section"), first.alias("a"), second.alias("b"))

    return F.transform(rows, entry)


def _card_rows(card: DataFrame) -> DataFrame:
    """The card unfolded to (page, section, pos, a, b) rows."""
    year, minutes = F.col("año_lanzamiento").cast("string"), F.col("duracion_minutos").cast("string")
    facts = F.array(
        F.struct(F.col("titulo_principal").alias("a"), F.col("tipo").alias("b")),
        F.struct(F.coalesce(year, F.lit("?")).alias("a"), F.coalesce(minutes, F.lit("?")).alias("b")),
        F.struct(F.coalesce(F.col("rating.promedio").cast("string"), F.lit("?")).alias("a"),
                 F.coalesce(F.col("rating.votos").cast("string"), F.lit("?")).alias("b")),
        F.struct(_joined("generos").alias("a"), _joined("directores", ";").alias("b")))
    sections = {
        "film": F.when(F.col("page") == 0, _section("film", facts, lambda x: (x["a"], x["b"]))),
        "cast": _section("cast", F.col("reparto_principal"), lambda p: (p["nombre_actor"], F.array_join(p["personajes"], "/"))),
        "aka": _section("aka", F.col("otros_titulos"), lambda a: (a["titulo"], a["region"])),
    }
    parts = [card.select("tconst", "page", F.posexplode(rows).alias("pos", "s")).select(
        "tconst", "page", "s.section", "pos", "s.a", "s.b") for rows in sections.values()]
    return _wide(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query
def film_card(spark, folder):
    return _card_rows(PF.film_card_from_staging(V.staging(spark, folder), PHRASE))


@query
def film_card_paged(spark, folder):
    return _card_rows(PF.film_card_from_staging(V.staging(spark, folder), PHRASE, page_size=3))


def _published(spark, folder, label: str) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The documents written as one run and read back, and the rows each step wrote."""
    ensure_shared_dir(spark)
    root = shared_path(spark, label)
    staging = V.staging(spark, folder)
    rows = publish.publish(spark, root, lambda store: D.build_documents(staging, store=store), write=layout.write_documents)
    return publish.current(spark, root), rows


@query
def catalogue_film_card(spark, folder):
    return _card_rows(PF.film_card(_published(spark, folder, "card")[0], PHRASE))


def _found_rows(found: DataFrame) -> DataFrame:
    """One row per found title and one per cast name of it, with its place."""
    title = F.when(F.col("page") == 0, F.array(F.concat(F.col("title"), F.lit("/"), _joined("directors", ";"))))
    facts = ["tconst", "page", "year", "rating", "votes", _joined("genres").alias("genres"), "score"]
    rows = [found.select(*facts, F.lit(kind).alias("kind"), F.posexplode(texts).alias("pos", "text"))
            for kind, texts in (("title", title), ("actor", F.col("actors")))]
    return _wide(rows[0].unionByName(rows[1]))


@query
def film_search(spark, folder):
    return _found_rows(PF.film_search_from_staging(V.staging(spark, folder), "may specified"))


@query
def film_search_paged(spark, folder):
    return _found_rows(PF.film_search_from_staging(V.staging(spark, folder), "may specified", page_size=3))


@query
def catalogue_film_search(spark, folder):
    return _found_rows(PF.film_search(_published(spark, folder, "search")[0], "may specified"))


@query
def publish_steps(spark, folder):
    """Rows written per step of a publish run."""
    _, rows = _published(spark, folder, "steps")
    return spark.createDataFrame(list(rows.items()), "tabla string, total bigint")


def _works(df: DataFrame) -> DataFrame:
    return _wide(df.withColumnRenamed("año", "ano"))


@query
def director_works(spark, folder):
    return _works(PF.director_works(_title_docs(spark, folder, "crew"), _people_docs(spark, folder), DIRECTOR_RAW))


@query
def director_works_titles(spark, folder):
    docs = _title_docs(spark, folder, "rating", "crew")
    works = PF.director_works_titles(docs, _people_docs(spark, folder), DIRECTOR_RAW)
    return _wide(works.withColumn("genres", _joined("genres")))


@query
def top_rated(spark, folder):
    top = PF.top_rated(_title_docs(spark, folder, "rating"))
    return _works(top.select("tconst", "titulo", F.col("rating.average").alias("average"),
                             F.col("rating.votes").alias("votes"), "año"))


@query
def top_rated_details(spark, folder):
    top = PF.top_rated_details(_title_docs(spark, folder, "rating", "crew"), _people_docs(spark, folder))
    return _wide(top.withColumn("directors", _joined("directors", ";")).withColumn("genres", _joined("genres")))


@query
def top_directors(spark, folder):
    return PF.top_directors(_title_docs(spark, folder, "crew"), _people_docs(spark, folder))


@query
def top_directors_films(spark, folder):
    return PF.top_directors(_title_docs(spark, folder, "crew"), _people_docs(spark, folder), films_only=True)


@query
def top_actors(spark, folder):
    return PF.top_actors(_title_docs(spark, folder, "principals"), _people_docs(spark, folder))


@query
def top_actors_films(spark, folder):
    docs = _title_docs(spark, folder, "principals")
    return PF.top_actors(docs, _people_docs(spark, folder), categories=["actor"], films_only=True)


@query
def top_actors_staging(spark, folder):
    return PF.top_actors_flat(V.titles_raw(spark, folder), V.principals_raw(spark, folder), _people_docs(spark, folder))


def _maintained(spark, versions: list[DataFrame], keys: list[str], entries) -> DataFrame:
    """Counts of the first version, moved by the change set of each later one; stored after every step."""
    ensure_shared_dir(spark)
    counts = RK.recount(versions[0], entries)
    for step, (old, new) in enumerate(zip(versions, versions[1:])):
        change = RK.deltas(SN.diff(old, new, keys), old, keys, entries)
        path = shared_path(spark, f"counts-{step}")
        RK.moved(counts, change).write.parquet(path)
        counts = spark.read.parquet(path)
    return counts


@query
def maintained_directors(spark, folder):
    """The directors' ranking after two change sets: titles that come, that go and that change directors."""
    new = V.crew_raw(spark, folder).select("tconst", "directors").filter("tconst is not null")
    last = F.substring("tconst", -1, 1)
    other = F.when(last.isin("2", "5"), F.lit("nm0000001,nm0000002")).otherwise(F.col("directors"))
    first = new.filter(last != "7").select("tconst", other.alias("directors")).unionByName(
        new.filter(last == "3").select(F.concat(F.lit("x"), "tconst").alias("tconst"), "directors"))
    half = first.filter("tconst not like 'x%' or tconst like '%13'")

    def entries(rows: DataFrame) -> DataFrame:
        return rows.filter("directors is not null").select(F.explode(X.split_list(F.col("directors"))).alias("nconst"))

    counts = _maintained(spark, [first, half, new], ["tconst"], entries)
    return _wide(RK.top(counts, _people_docs(spark, folder), 25))


@query
def maintained_actors(spark, folder):
    """The actors' ranking from title documents, of which some lose their cast and some are new."""
    docs = D.embed_principals(D.title_base(V.titles_raw(spark, folder)).select("tconst"), V.principals_raw(spark, folder))
    # Dealt out once by the keys of the change set. No filter on a version passes the one that holds for every row, so all
    # uses of both versions read the same exchanges.
    docs = docs.select("tconst", "page", "principals").repartition("tconst", "page").filter(F.monotonically_increasing_id() >= 0)
    last = F.substring("tconst", -1, 1)
    none = F.slice("principals", 1, 0)
    first = docs.filter(last != "4").withColumn("principals", F.when(last == "8", none).otherwise(F.col("principals")))

    def entries(rows: DataFrame) -> DataFrame:
        billed = rows.select(F.explode("principals").alias("p"))
        return billed.filter(F.col("p.category").isin(*PF.ACTING)).select("p.nconst")

    counts = _maintained(spark, [first, docs], ["tconst", "page"], entries)
    return _wide(RK.top(counts, _people_docs(spark, folder), 25))


# --- search ----------------------------------------------------------------------------------


@query
def phrase_search(spark, folder):
    return SE.phrase_search(V.titles_raw(spark, folder), "primarytitle", "OCTOBER  urgent").select("tconst", "primarytitle")


@query
def phrase_search_documents(spark, folder):
    docs = V.table(spark, folder, "documents")
    return SE.phrase_search(docs, "text", "of the").select("doc_id", "lang")


@query
def token_search(spark, folder):
    found = SE.token_search(V.titles_raw(spark, folder), "primarytitle", "may specified")
    return _wide(found.select("tconst", "primarytitle", "score"))


@query
def token_search_documents(spark, folder):
    docs = V.table(spark, folder, "documents")
    return _wide(SE.token_search(docs, "text", "the entre où").select("doc_id", "score"))


def _title_index(spark, folder, rows: DataFrame) -> str:
    ensure_shared_dir(spark)
    path = shared_path(spark, "title-index")
    TI.build_index(rows.select("tconst", "primarytitle").filter("tconst is not null"), "tconst", "primarytitle", path)
    return path


def _indexed_titles(spark, folder, path: str, phrase: str) -> DataFrame:
    keys = TI.phrase_keys(spark, path, phrase).withColumnRenamed("key", "tconst")
    return V.titles_raw(spark, folder).join(keys, "tconst", "left_semi").select("tconst", "primarytitle")


@query
def index_phrase_search(spark, folder):
    return _indexed_titles(spark, folder, _title_index(spark, folder, V.titles_raw(spark, folder)), "OCTOBER  urgent")


@query
def index_token_search(spark, folder):
    titles = V.titles_raw(spark, folder)
    scores = TI.token_scores(spark, _title_index(spark, folder, titles), "may specified").withColumnRenamed("key", "tconst")
    return _wide(titles.join(scores, "tconst").select("tconst", "primarytitle", "score"))


@query
def index_token_search_documents(spark, folder):
    docs = V.table(spark, folder, "documents")
    ensure_shared_dir(spark)
    path = shared_path(spark, "document-index")
    TI.build_index(docs, "doc_id", "text", path)
    return _wide(TI.token_scores(spark, path, "the entre où").withColumnRenamed("key", "doc_id"))


@query
def index_word_frequencies(spark, folder):
    path = _title_index(spark, folder, V.titles_raw(spark, folder))
    return _wide(TI.frequencies(spark, path, ["october", "urgent", "may", "specified", "nowhere"]))


@query
def index_phrase_after_changes(spark, folder):
    """An index of other titles, brought up to date by two change sets and merged in between."""
    new = V.titles_raw(spark, folder).select("tconst", "primarytitle").filter("tconst is not null")
    last = F.substring("tconst", -1, 1)
    retitled = F.when(last.isin("1", "4"), F.lit("An October urgent day")).otherwise(F.col("primarytitle"))
    old = new.filter(last != "7").select("tconst", retitled.alias("primarytitle"))
    old = old.unionByName(new.filter(last == "2").select(F.concat(F.lit("x"), "tconst").alias("tconst"), "primarytitle"))
    half = old.select("tconst", F.when(last == "1", F.lit("urgent October")).otherwise(F.col("primarytitle")).alias("primarytitle"))
    path = _title_index(spark, folder, old)
    TI.update_index(SN.diff(old, half, ["tconst"]), "tconst", "primarytitle", path)
    TI.merge_runs(spark, path)
    TI.update_index(SN.diff(half, new, ["tconst"]), "tconst", "primarytitle", path)
    return _indexed_titles(spark, folder, path, "OCTOBER  urgent")


@query
def ilike_search(spark, folder):
    return SE.ilike_search(V.titles_raw(spark, folder), "primarytitle", "R URG").select("tconst", "primarytitle")


@query
def aka_lookup(spark, folder):
    found = SE.aka_lookup(D.title_base(V.titles_raw(spark, folder)), D.aka_docs(V.akas_raw(spark, folder)), "Aka 42")
    return found.select("tconst", "primaryTitle")


@query
def trigram_similarity(spark, folder):
    found = SE.similar(V.table(spark, folder, "part"), "p_name", "red widgets", 0.4)
    return found.select("p_partkey", "p_name", _ratio(F.col("similarity")).alias("similarity"))


@query
def trigram_terms(spark, folder):
    titles = D.embed(D.title_base(V.titles_raw(spark, folder)), D.rating_part(V.ratings_raw(spark, folder)))
    terms = PF.top_rated(titles).select(F.col("titulo").alias("term"))
    found = SE.similar_to_terms(V.titles_raw(spark, folder), "tconst", "primarytitle", terms, "term", 0.7)
    return found.select("tconst", "primarytitle", "term", _ratio(F.col("similarity")).alias("similarity"))


# --- writes ----------------------------------------------------------------------------------


def _priced(df: DataFrame) -> DataFrame:
    """Prices as whole cents."""
    return df.withColumn("o_totalprice", F.floor(F.col("o_totalprice") * 100 + 0.5).cast("bigint"))


@query
def upsert_replace(spark, folder):
    return _priced(U.upsert_replace(V.old_version(spark, folder), V.new_version(spark, folder), ["o_orderkey"]))


@query
def insert_ignore(spark, folder):
    lines = V.sparse_changes(spark, folder)
    incoming = lines.select(
        "o_orderkey", F.col("l_partkey").alias("o_custkey"), F.lit("X").alias("o_orderstatus"),
        F.col("l_suppkey").cast("double").alias("o_totalprice"))
    return _priced(U.insert_ignore(V.old_version(spark, folder), incoming, ["o_orderkey"], ["o_custkey", "o_totalprice"]))


@query
def upsert_sparse(spark, folder):
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    return _priced(U.upsert_sparse(V.old_version(spark, folder), V.sparse_changes(spark, folder), ["o_orderkey"], order))


@query
def update_matched(spark, folder):
    changes = V.new_version(spark, folder).filter("o_orderstatus = 'P'").select("o_orderkey", "o_totalprice")
    return _priced(U.update_matched(V.old_version(spark, folder), changes, ["o_orderkey"], ["o_totalprice"]))


@query
def batches_fold(spark, folder):
    inserts = V.table(spark, folder, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("batch"), F.lit("insert").alias("kind"), "o_custkey",
        F.floor("o_totalprice").cast("bigint").alias("price"))
    updates = V.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.year("l_shipdate").alias("batch"), F.lit("update").alias("kind"),
        F.lit(None).cast("bigint").alias("o_custkey"),
        F.when(F.col("l_returnflag") != "N", F.floor("l_extendedprice").cast("bigint")).alias("price"))
    return U.fold_batches(inserts.unionByName(updates), ["o_orderkey"], "batch", "kind", ["price"])


@query
def audit_stamp(spark, folder):
    t0, t1 = F.lit("2001-01-01").cast("timestamp"), F.lit("2002-01-01").cast("timestamp")
    old = V.old_version(spark, folder).withColumn("created_at", t0).withColumn("updated_at", t0)
    out = U.stamp_audit(old, V.new_version(spark, folder), ["o_orderkey"], now=t1)
    return out.select("o_orderkey", "o_orderstatus", F.year("created_at").cast("bigint").alias("created"),
                      F.year("updated_at").cast("bigint").alias("updated"))


@query
def publish_star(spark, folder):
    ensure_shared_dir(spark)
    root = shared_path(spark, "star")
    staging = V.staging(spark, folder)
    publish.publish(spark, root, lambda store: N.build_star(staging, store=store), I.check_star, layout.write_star)
    return I.table_counts(publish.current(spark, root))


@query
def layout_partitioned(spark, folder):
    ensure_shared_dir(spark)
    path = shared_path(spark, "layout")
    layout.write_partitioned(_titles(spark, folder), path, ["title_type"], ["tconst"])
    return spark.read.parquet(path).groupBy("title_type").agg(
        F.count(F.lit(1)).alias("rows"), F.min("tconst").alias("low"), F.max("tconst").alias("high"))


@query
def layout_curve(spark, folder):
    """Rated titles along a curve over rating, votes and year; the top list, a year and a range of votes read from it."""
    ensure_shared_dir(spark)
    path = shared_path(spark, "curve")
    rated = _title_docs(spark, folder, "rating").select(
        "tconst", "titleType", F.col("startYear").alias("year"), F.col("rating.average").cast("double").alias("average"),
        F.col("rating.votes").cast("bigint").alias("votes"))
    layout.write_curve(rated, path, ["average", "votes", "year"], cells=64)
    stored = spark.read.parquet(path)
    top = stored.filter("titleType = 'movie' and votes >= 200000").orderBy(F.desc("average"), F.desc("votes"), "tconst").limit(10)
    parts = {"top": top, "year": stored.filter("year = 2001"), "unknown": stored.filter("year is null and votes < 100000")}
    return _wide(reduce(DataFrame.unionByName, [
        rows.select(F.lit(name).alias("part"), "tconst", "year", "votes") for name, rows in parts.items()]))


@query
def stream_upsert(spark, folder):
    ensure_shared_dir(spark)
    schema = V.table(spark, folder, "events").schema
    stream = ST.file_stream(spark, f"{folder.rstrip('/')}/events.parquet*", schema)
    stream = stream.select(F.col("user_id"), "ts", "event_id",
                           F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
                           F.when(F.col("value") > 0, F.floor("value").cast("bigint")).alias("value"))
    target, checkpoint = shared_path(spark, "stream"), shared_path(spark, "stream-state")
    out = ST.ingest(spark, stream, target, checkpoint, ["user_id"], ["ts", "event_id"])
    return out.select("user_id", "event_id", "event_type", "value")


@query
def stream_levels(spark, folder):
    """events in ten batches, folded level by level as they come; the first three come twice."""
    ensure_shared_dir(spark)
    rows = V.table(spark, folder, "events").select(
        "user_id", "ts", "event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        F.when(F.col("value") > 0, F.floor("value").cast("bigint")).alias("value"))
    target = shared_path(spark, "levels")
    for batch in [*range(10), 0, 1, 2]:
        ST.put_batch(rows.filter(F.col("event_id") % 10 == batch), batch, target, ["user_id"], ["ts", "event_id"], fan_out=3)
    return ST.fold(spark, target, rows.schema, ["user_id"]).select("user_id", "event_id", "event_type", "value")


# --- integrity -------------------------------------------------------------------------------


@query
def pk_duplicates(spark, folder):
    return _wide(I.pk_duplicates(V.principals_raw(spark, folder), ["tconst", "ordering"]))


@query
def null_violations(spark, folder):
    return I.null_violations(V.titles_raw(spark, folder), ["tconst", "startyear", "endyear", "genres"])


@query
def enum_violations(spark, folder):
    return I.enum_violations(V.titles_raw(spark, folder), "titletype", S.TITLE_TYPES)


@query
def length_violations(spark, folder):
    """The limits of every staging table."""
    parts = [I.length_violations(df, S.STAGING_COLUMNS[name]).select(F.lit(name).alias("table"), "*")
             for name, df in V.staging(spark, folder).items()]
    return _wide(reduce(DataFrame.unionByName, parts))


@query
def duplicate_batch_keys(spark, folder):
    return U.duplicate_keys(V.principals_raw(spark, folder), ["tconst", "ordering"]).withColumnRenamed("count", "rows")


def _unchecked_star(spark, folder) -> dict[str, DataFrame]:
    """All nine tables, children as they are before cleaning, dimensions with gaps."""
    staging = V.staging(spark, folder)
    genres, categories = N.genres_dim(staging["title_basics"]), N.categories_dim(staging["title_principals"])
    listed = staging["title_basics"].filter("genres is not null").select(
        "tconst", F.posexplode(X.split_list(F.col("genres"))).alias("pos", "genre_name"))
    roles = [staging["title_crew"].filter(f"{c} is not null").select(
        "tconst", F.explode(X.split_list(F.col(c))).alias("nconst"), F.lit(role).alias("crew_type"))
        for c, role in (("directors", "director"), ("writers", "writer"))]
    return {
        "titles": _titles(spark, folder), "people": _people(spark, folder),
        "genres": genres.filter("genre_id % 4 <> 0"), "categories": categories.filter("category_id <> 2"),
        "ratings": staging["title_ratings"].select(
            "tconst", F.col("averagerating").alias("average_rating"), F.col("numvotes").alias("num_votes")),
        "episodes": staging["title_episode"].select(
            F.col("tconst").alias("episode_tconst"), F.col("parenttconst").alias("parent_tconst")),
        "title_genres": listed.join(genres, "genre_name").select("tconst", "genre_id", F.col("pos").alias("genre_order")),
        "title_principals": staging["title_principals"].join(categories, F.col("category") == F.col("category_name")).select(
            "tconst", "ordering", "nconst", "category_id"),
        "title_crew": roles[0].unionByName(roles[1]),
    }


@query
def fk_violations(spark, folder):
    return I.fk_report(_unchecked_star(spark, folder))


@query
def star_checks(spark, folder):
    return I.check_star(_unchecked_star(spark, folder))


@query
def cascade_delete(spark, folder):
    star = N.build_star(V.staging(spark, folder))
    gone_titles = star["titles"].filter("title_type = 'tvseries'").select("tconst")
    gone_people = star["people"].filter("birth_year >= 1990").select("nconst")
    return I.table_counts(I.cascade_delete(star, gone_titles, gone_people))


PROFILED = ["orders", "lineitem", "part", "customer", "supplier", "nation", "region", "events", "documents", "pages",
            "embeddings", "benchmark", "labels", "conversations"]


@query
def table_shapes(spark, folder):
    """Rows and columns of every driver table. File sizes are no SQL matter; a test compares them with the files."""
    paths = {n: f"{folder.rstrip('/')}/{n}.parquet" for n in PROFILED}
    return layout.profile(spark, paths).select("table", "rows", "columns")


@query
def table_columns(spark, folder):
    """Rows, NULLs and bounds of every column of the driver tables, from file footers alone."""
    return layout.column_profile(spark, {n: f"{folder.rstrip('/')}/{n}.parquet" for n in PROFILED})


# --- versions --------------------------------------------------------------------------------


@query
def snapshot_diff(spark, folder):
    return _priced(SN.diff(V.old_version(spark, folder), V.new_version(spark, folder), ["o_orderkey"]))


def _stored_versions(spark, folder) -> tuple[str, str, str]:
    """The old version, a copy of it and the new one, stored with their digests."""
    ensure_shared_dir(spark)
    old, same, new = (shared_path(spark, f"version-{n}") for n in ("old", "same", "new"))
    DG.write_version(V.old_version(spark, folder), ["o_orderkey"], old)
    DG.write_version(V.old_version(spark, folder), ["o_orderkey"], same, follows=old)
    DG.write_version(V.new_version(spark, folder), ["o_orderkey"], new, follows=old)
    return old, same, new


@query
def digest_diff(spark, folder):
    """The change set between stored versions, joined in the differing key ranges only."""
    old, _, new = _stored_versions(spark, folder)
    return _priced(DG.diff_versions(spark, old, new, ["o_orderkey"]))


@query
def unchanged_versions(spark, folder):
    """Whether a version differs from the old one, from the roots of their digest trees."""
    old, same, new = _stored_versions(spark, folder)
    found = [(name, not DG.unchanged(spark, old, path)) for name, path in (("same", same), ("new", new))]
    return spark.createDataFrame(found, "version string, changed boolean")


@query
def apply_changes(spark, folder):
    old, new = V.old_version(spark, folder), V.new_version(spark, folder)
    return _priced(SN.apply_changes(old, SN.diff(old, new, ["o_orderkey"]), ["o_orderkey"]))


@query
def rebuild_chain(spark, folder):
    old, new = V.old_version(spark, folder), V.new_version(spark, folder)
    third = new.filter("o_orderstatus <> 'O'")
    sets = [(1, SN.diff(old, new, ["o_orderkey"])), (2, SN.diff(new, third, ["o_orderkey"]))]
    return _priced(SN.rebuild(old, sets, ["o_orderkey"]))


@query
def restore_as_of(spark, folder):
    events = V.table(spark, folder, "events")
    op = F.when(F.col("event_type") == "error", "delete").otherwise("upsert")
    log = events.select("user_id", op.alias("op"), "event_type", F.floor("value").cast("bigint").alias("value"), "ts", "event_id")
    out = SN.rebuild_log(log, ["user_id"], "ts", F.lit(AS_OF).cast("timestamp"))
    return out.select("user_id", "event_type", "value", "event_id")


@query
def change_counts(spark, folder):
    """An unchanged version gives an empty change set."""
    old, new = V.old_version(spark, folder), V.new_version(spark, folder)
    parts = [SN.diff(old, v, ["o_orderkey"]).agg(F.count(F.lit(1)).alias("changes")).select(
        F.lit(name).alias("version"), "changes", (F.col("changes") > 0).alias("changed")) for name, v in (("same", old), ("new", new))]
    return parts[0].unionByName(parts[1])


def _chain(df: DataFrame) -> DataFrame:
    return df.select("stanza", "event_id", "role", "label")


@query
def restore_chain(spark, folder):
    return _chain(SN.restore_chain(V.snapshots(spark, folder)))


@query
def restore_chain_as_of(spark, folder):
    return _chain(SN.restore_chain(V.snapshots(spark, folder), F.lit(AS_OF).cast("timestamp")))


# --- snapshot catalogue ----------------------------------------------------------------------


@query
def backup_records(spark, folder):
    rows = B.records(V.snapshots(spark, folder))
    return rows.withColumn("etiqueta", X.key_label(F.col("key"))).withColumn("legible", X.readable_stamp(X.key_stamp(F.col("key"))))


@query
def backup_list(spark, folder):
    return B.listing(B.records(V.snapshots(spark, folder)), ["stanza"])


@query
def backup_list_all(spark, folder):
    return B.listing(B.records(V.snapshots(spark, folder)))


@query
def backup_type_counts(spark, folder):
    return B.type_counts(V.snapshots(spark, folder))


@query
def backup_type_counts_by_stanza(spark, folder):
    return B.type_counts(V.snapshots(spark, folder), group=["stanza"])


@query
def backup_latest(spark, folder):
    rows = B.records(V.snapshots(spark, folder))
    return B.latest(rows, ["key", "direccion_almacenamiento"], ["stanza"]).select("stanza", "key", "fecha", "hora", "tipo_backup")


@query
def backup_retention(spark, folder):
    kept = B.retention(V.snapshots(spark, folder))
    return kept.select("stanza", "event_id", "type", "keep")


@query
def backup_bases(spark, folder):
    return B.bases(V.snapshots(spark, folder)).select("stanza", "event_id", "type", "base")


@query
def backup_orphans(spark, folder):
    snaps = V.snapshots(spark, folder)
    records = B.records(snaps)
    return B.orphans(records, snaps.filter("type <> 'incr'").select("label")).select("key", "stanza", "tipo_backup")


def _field_pairs(spark, folder) -> DataFrame:
    rows = B.records(V.snapshots(spark, folder)).withColumn("key", F.col("direccion_almacenamiento"))
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in S.CATALOGUE_FIELDS])
    return rows.select("key", F.explode(pairs).alias("p")).select("key", "p.field", "p.value")


@query
def backup_register(spark, folder):
    """Fulls registered again by another host replace their records; the key is the record's location."""
    snaps = V.snapshots(spark, folder)
    rows = B.records(snaps).withColumn("stamp", F.col("key")).withColumn("key", F.col("direccion_almacenamiento"))
    again = B.records(snaps.filter("type = 'full'"), primary=F.lit("second")).withColumn("stamp", F.col("key")).withColumn(
        "key", F.col("direccion_almacenamiento"))
    out = B.register(rows, again)
    return out.withColumn("key", F.col("stamp")).drop("stamp")


@query
def backup_fields_pivot(spark, folder):
    return B.pivot_fields(_field_pairs(spark, folder))


@query
def backup_older_form(spark, folder):
    snaps = V.snapshots(spark, folder)
    pairs = snaps.select(
        F.concat(F.lit("backup:"), X.code_label(F.col("type")), F.lit(":"), X.stamp(F.col("ts"))).alias("key"),
        F.concat(F.lit("/backups/"), F.col("label")).alias("value"))
    return B.older_form(pairs)


@query
def log_durations(spark, folder):
    out = B.durations(V.log_lines(spark, folder))
    return out.select("file", "line_no", "type", "seconds")


@query
def report_snapshots(spark, folder):
    snaps = V.snapshots(spark, folder)
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    mb = F.floor(F.abs("value")).cast("bigint").cast("string")
    texts = F.array(
        F.concat(F.lit("        "), F.col("type"), F.lit(" backup: "), F.col("label")),
        F.concat(F.lit("            timestamp start/stop: "), at, F.lit(" / "), at),
        F.concat(F.lit("            database size: "), mb, F.lit("MB, database backup size: "), mb, F.lit("MB")),
        F.concat(F.lit("            repo1: backup set size: "), mb, F.lit("GB, backup size: "), mb, F.lit("kB")))
    lines = snaps.select("stanza", "event_id", F.posexplode(texts).alias("i", "value")).select(
        "stanza", (F.col("event_id") * 4 + F.col("i")).alias("line_no"), "value")
    out = B.report_snapshots(lines, ["line_no"], ["stanza"])
    return out.select("stanza", "label", "type", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"),
                      "database_bytes", "backup_bytes")


@query
def report_json_labels(spark, folder):
    snaps = V.snapshots(spark, folder)
    text = F.concat(F.lit('[{"name":"s'), F.col("stanza").cast("string"), F.lit('","backup":[{"label":"'), F.col("label"),
                    F.lit('","type":"'), F.col("type"), F.lit('","prior":null,"timestamp":{"start":'),
                    F.unix_timestamp("ts").cast("string"), F.lit(',"stop":'), (F.unix_timestamp("ts") + 5).cast("string"),
                    F.lit('}}]}]'))
    out = SC.labels_from_json(snaps.select(text.alias("value")))
    return out.select("stanza", "label", "type", (F.unix_timestamp("stop") - F.unix_timestamp("start")).alias("seconds"))


@query
def size_texts(spark, folder):
    n = F.floor(F.col("o_totalprice") * F.col("o_totalprice") / 4).cast("bigint")
    rows = V.table(spark, folder, "orders").select("o_orderkey", n.alias("n"))
    text = F.concat(F.floor(F.col("n") / 1_000_000).cast("bigint").cast("string"), F.lit("."), (F.col("n") % 10).cast("string"), F.lit("MB"))
    return rows.select("o_orderkey", X.readable_size(F.col("n")).alias("size"), X.size_to_bytes(text).alias("bytes"))
