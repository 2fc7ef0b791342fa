"""Physical layouts for the known access paths, and table profiles.

Where a row store would keep indexes, columnar files keep order: ranges of a sorted key give tight
min/max statistics, so a lookup or a range reads few row groups.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.columns import readable_size


def write_sorted(df: DataFrame, path: str, keys: list[str], partitions: int | None = None, mode: str = "overwrite") -> None:
    """Files hold ranges of ``keys``, sorted. Ranges are sampled, so a frequent leading value is
    spread over several files when further keys tell its rows apart."""
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode(mode).parquet(path)


def write_partitioned(
    df: DataFrame, path: str, by: list[str], keys: list[str], partitions: int | None = None, mode: str = "overwrite"
) -> None:
    """A folder per value of ``by``, sorted by ``keys`` inside. Range partitioning on both splits a
    value holding much of the table over many tasks."""
    ranged = df.repartitionByRange(partitions, *by, *keys) if partitions else df.repartitionByRange(*by, *keys)
    ranged.sortWithinPartitions(*by, *keys).write.mode(mode).partitionBy(*by).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """A catalog table bucketed and sorted by ``key``: joins of two such tables need no exchange."""
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def refresh_statistics(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """Row count, size and (optionally) column statistics for the optimiser."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if columns:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")


# Access paths of the published tables: (partition columns, sort keys). Tables that are looked up by another key than
# the one they are joined on are ranged; the others are sorted where their joins left them.
RANGED = {"people": ["primary_name", "nconst"], "akas": ["title", "titleid"]}
STAR_LAYOUT = {
    "titles": (["title_type"], ["tconst"]),
    "ratings": ([], ["tconst"]),
    "episodes": ([], ["parent_tconst", "season_number", "episode_number"]),
    "title_genres": ([], ["tconst", "genre_order"]),
    "title_principals": ([], ["tconst", "ordering"]),
    "title_crew": ([], ["nconst", "tconst"]),
    "genres": ([], ["genre_name"]),
    "categories": ([], ["category_name"]),
}


def write_star(df: DataFrame, table: str, save: Callable[..., None]) -> None:
    """Writer for ``publish``: each star table in its layout."""
    if table in RANGED:
        save(df.repartitionByRange(*RANGED[table]).sortWithinPartitions(*RANGED[table]))
        return
    by, keys = STAR_LAYOUT.get(table, ([], []))
    save(df.sortWithinPartitions(*by, *keys) if keys else df, tuple(by))


# Documents: titles by key, so that page lookups and the phrase scan read few row groups.
DOCUMENT_LAYOUT = {"titles": ["tconst", "page"], "people": ["nconst"], "akas": ["titleId", "ordering"]}


def write_documents(df: DataFrame, table: str, save: Callable[..., None]) -> None:
    """Writer for ``publish``: each collection sorted by its key within the partitions its joins left."""
    save(df.sortWithinPartitions(*DOCUMENT_LAYOUT[table]))


def profile(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows, columns, files and bytes of Parquet tables, largest first."""
    parts = []
    for name, path in paths.items():
        df = spark.read.parquet(path)
        per_file = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).groupBy(
            "f").agg(F.count(F.lit(1)).alias("n"), F.max("s").alias("s"))
        parts.append(
            per_file.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                F.count(F.lit(1)).alias("files"),
                F.coalesce(F.sum("s"), F.lit(0)).alias("bytes"),
            ).select(F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"), "files", "bytes")
        )
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.withColumn("size", readable_size(F.col("bytes"))).orderBy(F.desc("bytes"), "table")


NUMBERS = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def column_profile(spark: SparkSession, paths: dict[str, str], footers: bool = True) -> DataFrame:
    """(table, column, rows, nulls, low, high): each top-level column of Parquet tables, from the footers of their files.

    Counts, minima and maxima are pushed down to the file statistics, one footer a file read by tasks; no column is read.
    Bounds are those of numbers, as double (footers cut texts short), NULL for others; nested columns are left out.
    Writers leave bounds out where a row group holds only NULLs of a column, or a NaN; Spark then stops with an error, and
    ``footers=False`` scans the columns instead. The settings belong to a session of its own, the caller's stay as they are.
    """
    own = spark.newSession()
    if footers:
        own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
        own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    parts = []
    for name, path in paths.items():
        df = own.read.parquet(path)
        flat = [(c, kind in NUMBERS) for c, kind in df.dtypes if not kind.startswith(("array", "map", "struct", "variant"))]
        wanted = [F.count(F.lit(1)).alias("rows")]
        for i, (c, number) in enumerate(flat):
            q = F.col(f"`{c}`")
            wanted += [F.count(q).alias(f"n{i}")] + ([F.min(q).alias(f"a{i}"), F.max(q).alias(f"z{i}")] if number else [])
        facts = [F.struct(
            F.lit(c).alias("column"), (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
            *[(F.col(f"{end}{i}") if number else F.lit(None)).cast("double").alias(label) for end, label in (("a", "low"), ("z", "high"))],
        ) for i, (c, number) in enumerate(flat)]
        parts.append(df.agg(*wanted).select(F.lit(name).alias("table"), "rows", F.explode(F.array(*facts)).alias("f"))
                     .select("table", "f.column", "rows", "f.nulls", "f.low", "f.high"))
    return reduce(DataFrame.unionByName, parts)


def curve_position(df: DataFrame, keys: list[str], cells: int = 256, column: str = "curve") -> DataFrame:
    """``df`` with its place on a Z-order curve over the quantiles of ``keys`` (numbers).

    Each key is cut at its own quantiles, so that skewed values fill their cells evenly; NULL and NaN share a last
    cell. The bits of the cells are interleaved, the first key's highest. What reaches the driver are ``cells`` bounds a key.
    """
    from pyspark.ml.feature import Bucketizer

    bits = cells.bit_length()  # one more cell for NULL
    if cells < 2 or bits * len(keys) > 62:
        raise ValueError(f"{len(keys)} keys of {cells} cells do not fit a 62-bit curve")
    named = [(f"_{column}_key{i}", f"_{column}_cell{i}") for i in range(len(keys))]
    wide = df.select("*", *[F.col(k).cast("double").alias(key) for k, (key, _) in zip(keys, named)])
    steps = [i / cells for i in range(1, cells)]
    bounds = wide.approxQuantile([key for key, _ in named], steps, 1 / (4 * cells))
    splits = [[float("-inf"), *sorted({x for x in b if abs(x) != float("inf") and x == x} or {0.0}), float("inf")] for b in bounds]
    cut = Bucketizer(splitsArray=splits, inputCols=[key for key, _ in named], outputCols=[cell for _, cell in named],
                     handleInvalid="keep").transform(wide)
    place = F.lit(0).cast("long")
    for bit in range(bits):
        for i, (_, cell) in enumerate(named):
            one = F.shiftright(F.col(cell).cast("long"), bit).bitwiseAND(F.lit(1))
            place = place + F.shiftleft(one, bit * len(keys) + len(keys) - 1 - i)
    return cut.withColumn(column, place).drop(*[c for pair in named for c in pair])


def write_curve(
    df: DataFrame, path: str, keys: list[str], cells: int = 256, partitions: int | None = None, mode: str = "overwrite"
) -> None:
    """Files hold stretches of a Z-order curve over ``keys``: a range of any of the keys, or of several, reads few files.

    One sorted order serves its leading key alone; this one serves all keys about alike. Ranges go on with the keys
    and a hash of the row, so a cell that holds much of the table is spread over files.
    """
    placed = curve_position(df, keys, cells, "_curve")
    hashable = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    order = ["_curve", *keys, F.xxhash64(*hashable)]
    ranged = placed.repartitionByRange(partitions, *order) if partitions else placed.repartitionByRange(*order)
    ranged.sortWithinPartitions("_curve", *keys).drop("_curve").write.mode(mode).parquet(path)
