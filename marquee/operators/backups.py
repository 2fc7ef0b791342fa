"""Snapshot catalogue: records, listings, retention, bases, orphans, log durations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import columns as X
from marquee.operators.ordered import within
from marquee.operators.upsert import upsert_replace
from marquee.schemas import CATALOGUE_FIELDS


def records(
    snapshots: DataFrame, ts: str = "ts", kind: str = "type", label: str = "label", primary: Column | None = None,
    root: str = "/var/lib/backup",
) -> DataFrame:
    """Catalogue records of snapshots (stanza, ts, type, label): key and the seven text fields.

    The location ends in the snapshot's real label, whatever its type.
    """
    s = X.stamp(F.col(ts))
    return snapshots.select(
        F.concat(F.lit("backup:"), s).alias("key"),
        X.stamp_date(s).alias("fecha"),
        X.stamp_time(s).alias("hora"),
        X.code_label(F.col(kind)).alias("tipo_backup"),
        F.concat(F.lit(f"{root}/"), F.col("stanza"), F.lit("/"), F.col(label)).alias("direccion_almacenamiento"),
        (F.lit("primary") if primary is None else primary).alias("maestro_usado"),
        F.lit("snapshot").alias("metodo"),
        F.col("stanza").cast("string").alias("stanza"),
    )


def register(catalogue: DataFrame, record: DataFrame) -> DataFrame:
    """The catalogue with records added or replaced by key."""
    return upsert_replace(catalogue, record, ["key"])


def pivot_fields(pairs: DataFrame, key: str = "key", field: str = "field", value: str = "value") -> DataFrame:
    """(key, field, value) rows to one record per key; the field list is fixed, so one pass."""
    return pairs.groupBy(key).pivot(field, CATALOGUE_FIELDS).agg(F.max(value))


def older_form(pairs: DataFrame) -> DataFrame:
    """``backup:<type>:<stamp>`` -> path pairs as type, readable time and path."""
    s = X.key_stamp(F.col("key"))
    return pairs.select(
        X.key_type(F.col("key")).alias("tipo"), s.alias("stamp"), X.readable_stamp(s).alias("fecha_hora"),
        F.col("value").alias("archivo"),
    )


def listing(catalogue: DataFrame, group: list[str] | None = None, slices: int | None = None) -> DataFrame:
    """Numbered records in key order, the location cut to its last 17 characters."""
    dated = catalogue.withColumn("_at", X.stamp_to_timestamp(X.key_stamp(F.col("key"))))
    order = ["_at", "key", *[c for c in ("stanza", "direccion_almacenamiento") if c not in (group or [])]]
    numbered = within(dated, group or [], order, number="n", slices=slices)
    return numbered.select(
        *(group or []), "n", "fecha", "hora", F.col("tipo_backup").alias("tipo"),
        F.col("maestro_usado").alias("maestro"), X.tail(F.col("direccion_almacenamiento"), 17).alias("ubicacion"),
    )


def type_counts(snapshots: DataFrame, kind: str = "type", group: list[str] | None = None) -> DataFrame:
    """Total and count per snapshot type."""
    return snapshots.groupBy(*(group or [])).agg(
        F.count_if(F.col(kind).isin("full", "incr", "diff")).alias("total"),
        F.count_if(F.col(kind) == "full").alias("completos"),
        F.count_if(F.col(kind) == "incr").alias("incrementales"),
        F.count_if(F.col(kind) == "diff").alias("diferenciales"),
    )


def latest(catalogue: DataFrame, order: list[str], group: list[str] | None = None) -> DataFrame:
    """The newest record (per group), by ``order``."""
    group = group or []
    rest = [c for c in catalogue.columns if c not in (*group, *order)]
    top = catalogue.groupBy(*group).agg(F.max(F.struct(*order, *rest)).alias("_r"))
    return top.filter("_r is not null").select(
        *[F.col(c) if c in group else F.col(f"_r.{c}").alias(c) for c in catalogue.columns]
    )


def retention(
    snapshots: DataFrame, keep_full: int = 2, group: str = "stanza", kind: str = "type", ts: str = "ts"
) -> DataFrame:
    """Mark what stays when the newest ``keep_full`` fulls and all that depends on them are kept.

    The cut is the time of the oldest kept full. Finding it ranks fulls with a row limit, which Spark
    applies before the shuffle, so a task sends at most ``keep_full`` rows per group.
    """
    newest = Window.partitionBy(group).orderBy(F.desc(ts))
    fulls = (
        snapshots.filter(F.col(kind) == "full").select(group, ts)
        .withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= keep_full)
    )
    cut = fulls.groupBy(group).agg(F.min(ts).alias("_cut"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == keep_full)
    joined = snapshots.join(cut.select(group, "_cut"), group, "left")
    # With fewer fulls than asked for, nothing expires.
    return joined.withColumn("keep", F.coalesce(F.col(ts) >= F.col("_cut"), F.lit(True))).drop("_cut")


def bases(
    snapshots: DataFrame, group: str = "stanza", kind: str = "type", ts: str = "ts", label: str = "label",
    slices: int | None = None,
) -> DataFrame:
    """What each snapshot builds on: an incremental on the one before it, a differential on the
    latest full, a full on nothing."""
    seen = within(
        snapshots, [group], [ts, label],
        previous={"_any": F.col(label), "_full": F.when(F.col(kind) == "full", F.col(label))}, slices=slices,
    )
    base = F.when(F.col(kind) == "incr", F.col("_any")).when(F.col(kind) == "diff", F.col("_full"))
    return seen.withColumn("base", base).drop("_any", "_full")


def orphans(catalogue: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """Catalogue records whose stamp appears in no repository label.

    A label holds one 15-character stamp per snapshot of its chain; all of them count.
    """
    stamps = labels.select(F.explode(F.expr(rf"regexp_extract_all({label}, '([0-9]{{8}}-[0-9]{{6}})', 1)")).alias("_s"))
    return catalogue.withColumn("_s", X.key_label(F.col("key"))).join(stamps.distinct(), "_s", "left_anti").drop("_s")


def log_events(lines: DataFrame) -> DataFrame:
    """Adds ts, kind ('start' / 'end' / NULL) and snapshot type to log lines (column ``value``)."""
    message = F.regexp_extract("value", r"^\[[^\]]*\] (.*)$", 1)
    started = F.regexp_extract(message, r"^Iniciando backup (\w+)", 1)
    ended = F.regexp_extract(message, r"^Backup (\w+) finalizado correctamente", 1)
    stamp = F.regexp_extract("value", r"^\[(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\]", 1)
    return lines.select(
        *[c for c in lines.columns if c != "value"],
        F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
        message.alias("message"),
        F.when(started != "", "start").when(ended != "", "end").alias("kind"),
        F.when(started != "", started).when(ended != "", ended).alias("type"),
    )


def durations(lines: DataFrame, file: str = "file", order: list[str] | None = None, slices: int | None = None) -> DataFrame:
    """Seconds between each start line and the next line of its file and type, when that is an end.

    A start followed by another start has no duration.
    """
    order = order or ["line_no"]
    events = log_events(lines).filter("kind is not null")
    paired = within(
        events, [file, "type"], order,
        following={"_next": F.struct(F.col("kind").alias("kind"), F.col("ts").alias("ts"))}, slices=slices,
    )
    done = F.col("_next.kind") == "end"
    return paired.filter("kind = 'start'").select(
        file, *order, "type", F.col("ts").alias("started"),
        F.when(done, F.col("_next.ts")).alias("finished"),
        F.when(done, F.unix_timestamp("_next.ts") - F.unix_timestamp("ts")).alias("seconds"),
    )


def report_snapshots(lines: DataFrame, order: list[str], group: list[str] | None = None, slices: int | None = None) -> DataFrame:
    """Snapshots of a repository report (column ``value``): type, label, start, stop, sizes.

    Attribute lines belong to the last ``full|incr|diff backup:`` line above them.
    """
    group = group or []
    head = r"^\s*(full|incr|diff) backup:\s*(\S+)"
    label = F.nullif(F.regexp_extract("value", head, 2), F.lit(""))
    owned = within(lines, group, order, previous={"_above": label}, slices=slices)
    span = r"timestamp start/stop:\s*(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\s*/\s*(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"

    def taken(pattern: str, i: int) -> Column:
        return F.max(F.nullif(F.regexp_extract("value", pattern, i), F.lit("")))

    parts = owned.withColumn("label", F.coalesce(label, F.col("_above"))).filter("label is not null")
    return parts.groupBy(*group, "label").agg(
        taken(head, 1).alias("type"),
        taken(span, 1).cast("timestamp").alias("start"),
        taken(span, 2).cast("timestamp").alias("stop"),
        X.size_to_bytes(taken(r"database size:\s*([0-9.]+\s*[KkMGTP]?B)", 1)).alias("database_bytes"),
        X.size_to_bytes(taken(r"repo1:.*?backup size:\s*([0-9.]+\s*[KkMGTP]?B)", 1)).alias("backup_bytes"),
    )
