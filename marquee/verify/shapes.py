"""The seven staging tables, a snapshot catalogue, a log and two table versions, derived from the
driver tables. Every row of a driver table is used; defects (bad years, empty lists, blank names,
unknown people, dropped types) follow from the rows' own values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.functions import columns as X


# Schemas already read from file footers, by path.
_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _key(prefix: str, number: Column) -> Column:
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(7), F.length(text)), F.lit("0")))


def _tt(number: Column) -> Column:
    return _key("tt", number)


def _nm(number: Column) -> Column:
    return _key("nm", number)


def titles_raw(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "movie")
        .when(F.col("o_orderpriority") == "2-HIGH", "tvSeries")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "tvEpisode")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "tvMovie")
        .otherwise("videoGame")
    )
    month, day = F.date_format("o_orderdate", "MMMM"), F.date_format("o_orderdate", "EEEE")
    name = F.concat(month, F.lit(" "), F.lower(F.substring("o_orderpriority", 3, 20)), F.lit(" "), F.col("o_custkey").cast("string"))
    return table(spark, folder, "orders").select(
        _tt(k).alias("tconst"),
        kind.alias("titletype"),
        F.concat(F.lit("The "), name).alias("primarytitle"),
        name.alias("originaltitle"),
        F.when(F.col("o_totalprice") < 10000, "1").otherwise("0").alias("isadult"),
        F.when(k % 11 == 0, None).when(k % 13 == 0, "19x4").otherwise(F.year("o_orderdate").cast("string")).alias("startyear"),
        F.when(k % 4 == 1, (F.year("o_orderdate") + 2).cast("string")).when(k % 4 == 2, "20").alias("endyear"),
        F.when(k % 17 == 0, "n/a").otherwise((60 + k % 120).cast("string")).alias("runtimeminutes"),
        F.when(k % 19 == 0, None).when(k % 23 == 0, "").when(k % 3 == 0, F.concat_ws(",", month, day)).otherwise(month)
        .alias("genres"),
    )


def names_raw(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        _nm(k).alias("nconst"),
        F.when(F.col("c_acctbal") < 0, "  ").otherwise(
            F.concat(F.lit(" Person "), F.expr("c_custkey div 2").cast("string"))).alias("primaryname"),
        F.when(k % 7 == 0, None).otherwise((1900 + k % 100).cast("string")).alias("birthyear"),
        F.when(k % 5 == 0, (1980 + k % 40).cast("string")).alias("deathyear"),
        F.col("c_mktsegment").alias("primaryprofession"),
        F.when(k % 3 == 0, F.concat_ws(",", _tt(k), _tt(k + 1))).when(k % 3 == 1, _tt(k)).alias("knownfortitles"),
    )


def ratings_raw(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    rated = table(spark, folder, "orders").filter(F.col("o_orderstatus") != "P").select(
        _tt(k).alias("tconst"),
        F.concat((1 + (k * 7) % 9).cast("string"), F.lit("."), (k % 10).cast("string")).alias("averagerating"),
        F.floor("o_totalprice").cast("bigint").cast("string").alias("numvotes"),
    )
    unknown = table(spark, folder, "customer").select(
        _key("tx", F.col("c_custkey")).alias("tconst"), F.lit("5.0").alias("averagerating"), F.lit("10").alias("numvotes")
    )
    return rated.unionByName(unknown)


def crew_raw(spark: SparkSession, folder: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, folder, "orders").select(
        _tt(k).alias("tconst"),
        F.when(k % 9 == 0, None).when(k % 5 == 0, F.concat_ws(",", _nm(c), _nm(c + 1))).otherwise(_nm(c)).alias("directors"),
        F.when(k % 2 == 0, None).otherwise(_nm(c + 3)).alias("writers"),
    )


def principals_raw(spark: SparkSession, folder: str) -> DataFrame:
    flag, line = F.col("l_returnflag"), F.col("l_linenumber").cast("string")
    return table(spark, folder, "lineitem").select(
        _tt(F.col("l_orderkey")).alias("tconst"),
        line.alias("ordering"),
        _nm(F.col("l_partkey")).alias("nconst"),
        F.when(flag == "A", "actor").when(flag == "N", "actress").otherwise("producer").alias("category"),
        F.when(F.col("l_linestatus") == "O", "line").alias("job"),
        F.when(flag.isin("A", "N"), F.concat(F.lit('["Role '), line, F.lit('","Alt"]'))).alias("characters"),
    )


def episodes_raw(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, folder, "orders").filter(F.col("o_orderpriority") == "3-MEDIUM").select(
        _tt(k).alias("tconst"),
        _tt(F.expr("o_orderkey div 2")).alias("parenttconst"),
        F.when(k % 8 == 0, None).otherwise((1 + k % 9).cast("string")).alias("seasonnumber"),
        F.when(k % 10 == 0, "x1").otherwise((k % 40).cast("string")).alias("episodenumber"),
    )


def akas_raw(spark: SparkSession, folder: str) -> DataFrame:
    line = F.col("l_linenumber")
    return table(spark, folder, "lineitem").select(
        _tt(F.col("l_orderkey")).alias("titleid"),
        line.cast("string").alias("ordering"),
        F.concat(F.lit("Aka "), F.col("l_partkey").cast("string")).alias("title"),
        F.when(line % 4 == 0, "US").when(line % 4 == 1, "FR").when(line % 4 == 2, "NA").alias("region"),
        F.when(F.col("l_linestatus") == "O", "fr").alias("language"),
        F.when(line % 3 == 0, "working").when(line % 3 == 1, "festival,dvd").alias("types"),
        F.when((line % 2 == 0) & (F.col("l_linestatus") == "F"), "short title").alias("attributes"),
        F.when(line == 1, "1").otherwise("0").alias("isoriginaltitle"),
    )


STAGING = {
    "title_basics": titles_raw, "name_basics": names_raw, "title_ratings": ratings_raw, "title_crew": crew_raw,
    "title_principals": principals_raw, "title_episode": episodes_raw, "title_akas": akas_raw,
}


def staging(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: build(spark, folder) for name, build in STAGING.items()}


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """events as snapshots: a user is a stanza, purchases are fulls, sign-ups differentials."""
    kind = F.when(F.col("event_type") == "purchase", "full").when(F.col("event_type") == "signup", "diff").otherwise("incr")
    rows = table(spark, folder, "events").select("event_id", F.col("user_id").alias("stanza"), "ts", kind.alias("type"), "value")
    letter = F.when(F.col("type") == "full", "F").when(F.col("type") == "diff", "D").otherwise("I")
    label = F.concat(F.date_format("ts", X.LABEL_FORMAT), letter, F.lit("-"), F.col("event_id").cast("string"))
    return rows.withColumn("label", label)


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """events as log lines: a start line each, and a finish line ``value`` seconds later unless the
    event is an error; the line number follows the event number."""
    name = F.when(F.col("event_type") == "purchase", "completo").when(F.col("event_type") == "signup", "diferencial").otherwise(
        "incremental")
    at = F.col("ts")
    done = F.timestamp_seconds(F.unix_timestamp("ts") + F.floor(F.abs("value")).cast("bigint"))

    def line(ts: Column, text: Column) -> Column:
        return F.concat(F.lit("["), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("] "), text)

    start = line(at, F.concat(F.lit("Iniciando backup "), name, F.lit(" → /backups/"), F.col("event_id").cast("string")))
    end = line(done, F.concat(F.lit("Backup "), name, F.lit(" finalizado correctamente.")))
    two = F.array(
        F.struct((F.col("event_id") * 2).alias("line_no"), start.alias("value")),
        F.struct((F.col("event_id") * 2 + 1).alias("line_no"), F.when(F.col("event_type") != "error", end).alias("value")),
    )
    return (
        table(spark, folder, "events").select(F.col("user_id").alias("file"), F.explode(two).alias("l"))
        .select("file", "l.line_no", "l.value").filter("value is not null")
    )


VERSION_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def old_version(spark: SparkSession, folder: str) -> DataFrame:
    """orders as they stood before 2000."""
    return table(spark, folder, "orders").filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp")).select(*VERSION_COLUMNS)


def new_version(spark: SparkSession, folder: str) -> DataFrame:
    """All orders but cancelled ones; open orders repriced."""
    o = table(spark, folder, "orders")
    gone = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    price = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return o.filter(~gone).select("o_orderkey", "o_custkey", "o_orderstatus", price.alias("o_totalprice"))


def sparse_changes(spark: SparkSession, folder: str) -> DataFrame:
    """line items as sparse changes to orders: a customer from some lines, a price from others."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.when(F.col("l_returnflag") == "A", F.col("l_partkey")).alias("o_custkey"),
        F.when(F.col("l_returnflag") == "N", F.col("l_linestatus")).alias("o_orderstatus"),
        F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice")).alias("o_totalprice"),
        "l_linenumber", "l_partkey", "l_suppkey",
    )
