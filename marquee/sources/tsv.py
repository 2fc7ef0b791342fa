"""Reader for the tab-separated dumps: no quoting, ``\\N`` is NULL, an empty field stays empty.

Spark's CSV reader turns empty fields into NULL and lets a stray quote swallow tabs, so lines are
read as text (split across tasks) and cut with column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.functions.columns import NULL_MARK, decode_escapes
from marquee.operators.integrity import too_long
from marquee.schemas import STAGING_COLUMNS, STAGING_FILES, staging_names, staging_schema


# One field behind its tab: plain characters, and pairs of a backslash and any character (or the end).
FIELD = r"\t([^\t\\]*+(?:\\(?:[\s\S]|\z)[^\t\\]*+)*+)"
NO_SEPARATOR = "\u0001\u0002\u0001"


class BadRowsError(ValueError):
    """Strict reading met rows that do not fit the table."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob names something, on whatever file system it belongs to."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """What a glob names, on whatever file system it belongs to."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return [status.getPath().toString() for status in found or []]


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _decoded(encoding: str) -> Column:
    value = F.col("value")
    return value if encoding.upper() == "UTF-8" else F.decode(value.cast("binary"), encoding)


def _lines(spark: SparkSession, path: str, header: bool, encoding: str) -> DataFrame:
    """The lines behind the first one of each file, or all of them; blank lines are no rows."""
    if not header:
        return spark.read.option("lineSep", "\n").text(path).select(_decoded(encoding).alias("value")).filter("value <> ''")
    # Only the CSV source knows which line opens a file. With a separator that no line holds and
    # without quotes it hands over whole lines.
    whole = {"sep": NO_SEPARATOR, "quote": "", "escape": "", "header": "true", "enforceSchema": "true", "lineSep": "\n",
             "nullValue": NO_SEPARATOR, "emptyValue": "", "encoding": encoding}
    return spark.read.schema("value string").options(**whole).csv(path)


PIECE = "file string, block long, part int, closed boolean, value binary"


def _pieces(edges: bool, header: bool):
    """Records of lines (file, block, value, ends), whose splits lie behind one another, each in file order.

    A split's lines up to its first end of a record (part 0) and those it leaves open are its edges: they may go on in a
    neighbour and keep their place. Without ``edges`` the records between them are given, whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part, held, out = (None, None), 0, [], []

        def put(closed: bool) -> None:
            nonlocal part, held
            if edges == (part == 0 or not closed):
                out.append((*at, part, closed, b"\n".join(held)))
            part, held = 1, []

        def given() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
            columns = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["file", "block", "part", "closed", "value"])

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            files, blocks, values, ends = batch.columns
            moved = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1]))
            begins = [0, *(np.flatnonzero(moved.to_numpy(zero_copy_only=False)) + 1).tolist()]
            cuts = np.flatnonzero(ends.to_numpy(zero_copy_only=False)) + 1
            for low, high in zip(begins, [*begins[1:], n]):
                here = (files[low].as_py(), blocks[low].as_py())
                if here != at:
                    if held:
                        put(False)
                    at, part, held = here, 0, []
                    low += header and here[1] == 0  # the heading is the first line of a file
                own = cuts[(cuts > low) & (cuts <= high)].tolist()
                if edges and part:  # what lies between the edges is not put together
                    own = own[-1:]
                elif edges:
                    own = sorted({*own[:1], *own[-1:]})
                lines, base = ([], low) if edges else (values[low:high].to_pylist(), low)
                for end in own:
                    if not edges:
                        held += lines[low - base:end - base]
                    elif part == 0:
                        held += values[low:end].to_pylist()
                    put(True)
                    low = end
                held += values[low:high].to_pylist() if edges else lines[low - base:]
            if out:
                yield given()
        if held:
            put(False)
        if out:
            yield given()

    return run


def continued_lines(spark: SparkSession, path: str, header: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """Lines as ``_lines`` gives them, with records put together that go on behind a backslash at the end of a line.

    A line goes on if an odd number of backslashes ends it, which the line alone decides. Records are put together where
    their lines are read, one after another; only the first and the last one of a split, which may go on in the next, are
    dealt out and joined in the order of the splits. The heading is one line. The file is scanned twice.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        _decoded(encoding).alias("value"))
    goes_on = F.col("value").endswith("\\") & (F.length(F.regexp_extract("value", r"(\\+)\z", 1)) % 2 == 1)
    lines = lines.select("file", "block", F.col("value").cast("binary").alias("value"), (~goes_on).alias("ends"))
    whole = lines.mapInArrow(_pieces(False, header), PIECE).select(F.col("value").cast("string").alias("value"))
    before = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    # One or two rows a split: a record begins behind each that is closed.
    edges = lines.mapInArrow(_pieces(True, header), PIECE).withColumn(
        "_record", F.coalesce(F.sum(F.col("closed").cast("int")).over(before), F.lit(0)))
    place = F.struct("block", "part", F.col("value").cast("string").alias("value"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(place)), lambda x: x["value"]), "\n")
    joined = edges.groupBy("file", "_record").agg(text.alias("value")).select("value")
    return whole.unionByName(joined).filter("value <> ''")


def cut(lines: DataFrame, names: list[str], escapes: bool = False, extra_na: list[str] | None = None) -> DataFrame:
    """Lines (column ``value``) to named text columns plus ``_width``, the number of fields found."""
    fields = F.split(F.col("value"), "\t", -1)
    if escapes:
        # A backslash takes the character behind it along, so fields are read forwards; such lines are rare.
        escaped = F.contains(F.col("value"), F.lit("\\\t"))
        forward = F.regexp_extract_all(F.concat(F.lit("\t"), F.col("value")), F.lit(FIELD), F.lit(1))
        fields = F.when(escaped, forward).otherwise(fields)
    na = [NULL_MARK, *(extra_na or [])]

    def field(i: int) -> Column:
        text = F.get(F.col("_f"), F.lit(i))
        text = F.when(~text.isin(*na), text)
        return decode_escapes(text) if escapes else text

    return lines.select("value", fields.alias("_f")).select(
        *[field(i).alias(n) for i, n in enumerate(names)], F.size("_f").alias("_width"), "value"
    )


def read_tsv(
    spark: SparkSession, path: str, names: list[str], *, header: bool = True, escapes: bool = True,
    encoding: str = "UTF-8", extra_na: list[str] | None = None, continued: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Read a dump into ``(good, rejected)``.

    ``good`` has the named text columns, ``rejected`` the raw lines of another width. Both are lazy.
    ``extra_na`` lists further words to read as NULL, ``encoding`` the character set of the file, ``continued`` says that
    a backslash at the end of a line carries its record on to the next line.
    """
    lines = continued_lines(spark, path, header, encoding) if continued else _lines(spark, path, header, encoding)
    parsed = cut(lines, names, escapes, extra_na)
    good = parsed.filter(F.col("_width") == len(names)).select(*names)
    bad = parsed.filter(F.col("_width") != len(names)).select("value", F.col("_width").alias("fields"))
    return good, bad


def read_staging(
    spark: SparkSession, path: str, table: str, *, strict: bool = False, **options
) -> DataFrame:
    """One staging table. A missing file gives an empty frame. ``strict`` raises on rows of a wrong
    width or with over-long values, as a bulk load would; otherwise rows of a wrong width are left
    to ``read_tsv``'s second frame."""
    if not path_exists(spark, path):
        print(f"{path}: not found, skipped")
        return spark.createDataFrame([], staging_schema(table))
    good, bad = read_tsv(spark, path, staging_names(table), **options)
    if strict:
        wrong = bad.limit(5).collect()
        if wrong:
            raise BadRowsError(f"{table}: rows of a wrong width, such as {[r['value'] for r in wrong]}")
        long = too_long(good, STAGING_COLUMNS[table]).limit(5).collect()
        if long:
            raise BadRowsError(f"{table}: over-long values, such as {[tuple(r) for r in long]}")
    return good


def read_all_staging(spark: SparkSession, folder: str, **options) -> dict[str, DataFrame]:
    """The seven staging tables of a folder."""
    root = folder.rstrip("/")
    return {t: read_staging(spark, f"{root}/{name}", t, **options) for t, name in STAGING_FILES.items()}


def write_staging(df: DataFrame, path: str, append: bool = False) -> None:
    """Keep a staging frame as Parquet; the default replaces, so a rerun does not double it."""
    df.write.mode("append" if append else "overwrite").parquet(path)


def literal_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Inline rows as a source."""
    return spark.createDataFrame(rows, ddl)
