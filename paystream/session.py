"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# UTC instants; the last of several equal JSON keys counts; generated methods too long for the
# JVM to compile (8000 bytes) are not fused into one but evaluated in parts.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def builder(app_name: str = "paystream") -> SparkSession.Builder:
    out = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    # Python workers turn timestamps into local time and back; UTC has no ambiguous hours.
    out = out.config("spark.executorEnv.TZ", "UTC")
    for key, value in {**SQL_CONF, **STREAM_CONF}.items():
        out = out.config(key, value)
    return out


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session somebody else made."""
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A sibling session for one stateful stream.

    The number of state partitions is fixed for the life of a checkpoint and AQE does not
    coalesce them. It is what is given, else what the session's own setting says; the number of
    cores, which differs from start to start, plays no part.
    """
    sibling = configure(spark.newSession())
    for key, value in STREAM_CONF.items():
        sibling.conf.set(key, value)
    own = spark.conf.get("spark.sql.shuffle.partitions")
    sibling.conf.set("spark.sql.shuffle.partitions", str(partitions or own))
    return sibling


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path for intermediate tables and checkpoints.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``. Only where that
    is unset and the session is local (tests, a laptop) a temporary folder takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="paystream-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/paystream/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(work_dir(spark, "checkpoints"))
