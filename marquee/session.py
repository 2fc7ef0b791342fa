"""Session construction, runtime settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job here relies on. Skewed join partitions are split at run time, also
# when the split costs one more exchange above the join. Small shuffle partitions are put together up to 8 MB: rows
# with keys and nested lists pack tightly in a shuffle file, and a task holds them unpacked. A shuffle of more than 8 MB
# times spark.sql.shuffle.partitions has larger ones.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "marquee", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the settings above; ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **RUNTIME_CONF,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return folder.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/marquee-{label}-{uuid.uuid4().hex}"


def ensure_shared_dir(spark: SparkSession) -> str:
    """The shared folder; a local session without one (tests, trials) gets a folder of its own."""
    try:
        return shared_dir(spark)
    except ValueError:
        if not spark.sparkContext.master.startswith("local"):
            raise
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="marquee-"))
        return shared_dir(spark)
