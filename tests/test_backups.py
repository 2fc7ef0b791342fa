from datetime import datetime, timedelta

from pyspark.sql import functions as F

from marquee.functions import columns as X
from marquee.operators import backups as B
from marquee.sources import catalogue as SC

# Snapshots of a made-up evening: (type, minutes after 20:00, seconds taken; None: it never finished).
RUNS = [("completo", 0, 75), ("incremental", 10, 0), ("incremental", 20, 2), ("diferencial", 31, 9), ("completo", 45, 610),
        ("diferencial", 46, 3), ("completo", 90, None)]


def log_text():
    """Each run starts with one line and ends with another; a heading and a stray line stand between."""
    begin = datetime(2024, 3, 1, 20, 0, 0)
    lines = [(begin, "--- a heading ---")]
    for n, (kind, minutes, took) in enumerate(RUNS):
        at = begin + timedelta(minutes=minutes)
        lines.append((at, f"Iniciando backup {kind} → /snapshots/{n}"))
        if took is not None:
            lines.append((at + timedelta(seconds=took), f"Backup {kind} finalizado correctamente."))
    lines.sort(key=lambda x: x[0])
    text = [f"[{at:%Y-%m-%d %H:%M:%S}] {message}" for at, message in lines]
    return "\n".join([*text[:3], "a stray line", *text[3:]]) + "\n"


def test_log_durations(spark, tmp_path):
    for name in ("a.log", "b.log"):
        (tmp_path / name).write_text(log_text())
    lines = SC.read_lines(spark, str(tmp_path / "*.log"))
    for slices in (None, 7):
        got = B.durations(lines, "file", SC.LINE_ORDER, slices=slices).orderBy("file", *SC.LINE_ORDER).collect()
        one = [r["seconds"] for r in got if r["file"].endswith("a.log")]
        assert one == [took for *_, took in RUNS]
        assert one == [r["seconds"] for r in got if r["file"].endswith("b.log")]


REPORT = """stanza: films
    status: ok

    db (current)
        full backup: 20240301-200000F
            timestamp start/stop: 2024-03-01 20:00:00 / 2024-03-01 20:01:15
            database size: 3.5GB, database backup size: 3.5GB
            repo1: backup set size: 1.2GB, backup size: 1.2GB

        incr backup: 20240301-200000F_20240301-201000I
            timestamp start/stop: 2024-03-01 20:10:00 / 2024-03-01 20:10:07
            database size: 3.5GB, database backup size: 6.5MB
            repo1: backup set size: 1.2GB, backup size: 640kB
"""


def test_report(spark, tmp_path):
    (tmp_path / "report.txt").write_text(REPORT)
    lines = SC.read_lines(spark, str(tmp_path / "report.txt"))
    snaps = B.report_snapshots(lines, SC.LINE_ORDER, ["file"])
    got = {r["label"]: r for r in snaps.collect()}
    assert {k: v["type"] for k, v in got.items()} == {"20240301-200000F": "full", "20240301-200000F_20240301-201000I": "incr"}
    incr = got["20240301-200000F_20240301-201000I"]
    assert incr["backup_bytes"] == 640 * 1024 and (incr["stop"] - incr["start"]).seconds == 7
    assert B.type_counts(snaps).first().asDict() == {"total": 2, "completos": 1, "incrementales": 1, "diferenciales": 0}


def test_json_report(spark, tmp_path):
    (tmp_path / "r.json").write_text(
        '[{"name":"main","backup":[\n {"label":"20240301-200000F","type":"full","prior":null,"timestamp":{"start":10,"stop":86}}]}]')
    got = SC.read_json_reports(spark, str(tmp_path / "r.json")).collect()
    assert [(r["stanza"], r["label"], r["type"]) for r in got] == [("main", "20240301-200000F", "full")]


def snapshots(spark):
    rows = [(s, t, d) for s, ts in {"main": ["incr", "full", "incr", "diff", "incr", "full", "diff", "full", "incr"], "side": ["full", "diff"]}.items()
            for d, t in enumerate(ts, 1)]
    df = spark.createDataFrame(rows, "stanza string, type string, d int")
    ts = F.timestamp_seconds(F.col("d") * 86400)
    return df.withColumn("ts", ts).withColumn("label", F.concat(F.date_format(ts, X.LABEL_FORMAT), F.upper(F.left("type", F.lit(1)))))


def test_retention(spark):
    kept = {(r["stanza"], r["d"]) for r in B.retention(snapshots(spark)).collect() if r["keep"]}
    assert kept == {("main", 6), ("main", 7), ("main", 8), ("main", 9), ("side", 1), ("side", 2)}
    kept = {(r["stanza"], r["d"]) for r in B.retention(snapshots(spark), 1).collect() if r["keep"]}
    assert kept == {("main", 8), ("main", 9), ("side", 1), ("side", 2)}


def test_bases(spark):
    for slices in (None, 5):
        got = {(r["stanza"], r["d"]): r["base"] for r in B.bases(snapshots(spark), slices=slices).collect()}
        day = lambda d, letter: f"1970010{d + 1}-000000{letter}"
        assert got == {("main", 1): None, ("main", 2): None, ("main", 3): day(2, "F"), ("main", 4): day(2, "F"),
                       ("main", 5): day(4, "D"), ("main", 6): None, ("main", 7): day(6, "F"), ("main", 8): None,
                       ("main", 9): day(8, "F"), ("side", 1): None, ("side", 2): day(1, "F")}


def test_catalogue(spark, as_rows):
    records = B.records(snapshots(spark).filter("stanza = 'main'"))
    listed = B.listing(records).collect()
    assert sorted(r["n"] for r in listed) == list(range(1, 10))
    first = min(listed, key=lambda r: r["n"])
    assert (first["fecha"], first["hora"], first["tipo"], first["ubicacion"]) == ("1970-01-02", "00:00:00", "incremental", "...19700102-000000I"[:3] + "/19700102-000000I")
    newest = B.latest(records, ["key"]).first()
    assert newest["fecha"] == "1970-01-10" and newest["tipo_backup"] == "incremental"
    again = B.register(records, records.filter("fecha = '1970-01-02'").withColumn("maestro_usado", F.lit("other")))
    assert again.count() == 9 and again.filter("maestro_usado = 'other'").count() == 1


def test_pivot_and_orphans(spark, as_rows, tmp_path):
    records = B.records(snapshots(spark).filter("stanza = 'main'"))
    fields = ["fecha", "hora", "tipo_backup", "direccion_almacenamiento", "maestro_usado", "metodo", "stanza"]
    text = [f"{r['key']}\t{f}\t{r[f]}" for r in records.collect() for f in fields]
    (tmp_path / "dump.txt").write_text("\n".join(text))
    back = B.pivot_fields(SC.read_pairs(spark, str(tmp_path / "dump.txt")))
    assert as_rows(back, *records.columns) == as_rows(records)
    labels = spark.createDataFrame([("19700103-000000F",), ("19700103-000000F_19700104-000000I",)], "label string")
    left = {r["fecha"] for r in B.orphans(records, labels).collect()}
    assert left == {f"1970-01-{d:02d}" for d in range(2, 11)} - {"1970-01-03", "1970-01-04"}


def test_older_form(spark, as_rows):
    pairs = spark.createDataFrame([("backup:completo:2024-03-01_20-00-00", "/s/1")], "key string, value string")
    assert as_rows(B.older_form(pairs)) == [("completo", "2024-03-01_20-00-00", "2024-03-01 20:00:00", "/s/1")]
