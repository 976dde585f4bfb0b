"""How far a streaming query has come, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystream.sources.records import read_log

COMMITTED = "topic STRING, partition INT, committed_offset BIGINT"


def last_commit(spark: SparkSession, checkpoint: str) -> int | None:
    """The number of the last micro-batch that was finished, None before the first one.

    A batch that was planned and then failed has offsets, but no commit, and doesn't count.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    commits = hadoop.Path(f"{checkpoint}/commits")
    files = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(commits):
        return None
    # Spark keeps the last hundred batches or so.
    names = [status.getPath().getName() for status in files.listStatus(commits)]
    return max((int(name) for name in names if name.isdigit()), default=None)


def _source_offsets(spark: SparkSession, checkpoint: str, batch: int) -> list[str]:
    """The end of a micro-batch in each source, as its source writes it: after version and settings."""
    text = spark.read.text(f"{checkpoint}/offsets/{batch}", wholetext=True).first()[0]
    return text.rstrip("\n").split("\n")[2:]


def _file(column: str) -> Column:
    """A file's URI with one slash where it names no host, which Spark writes in both ways."""
    return F.regexp_replace(column, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/").alias("file")


def committed_offsets(
    spark: SparkSession, checkpoint: str, path: str | None = None, source: int = 0
) -> DataFrame:
    """The next offset of each partition after the last finished micro-batch, as ``COMMITTED``.

    Of a topic the checkpoint has the offsets themselves. Of a file log (at ``path``) it has the
    files of each batch; their last offsets are looked up, from the position columns only, on as
    many tasks as there are files. Before the first finished batch there are no rows.
    """
    batch = last_commit(spark, checkpoint)
    if batch is None:
        return spark.createDataFrame([], COMMITTED)
    end = spark.range(1).select(F.lit(_source_offsets(spark, checkpoint, batch)[source]).alias("end"))
    if path is None:
        ends = end.select(F.explode(F.from_json("end", "map<string,map<string,bigint>>")).alias("topic", "ends"))
        return ends.select("topic", F.explode("ends").alias("partition", "committed_offset")).select(
            "topic", F.col("partition").cast("int").alias("partition"), "committed_offset"
        )
    last = end.select(F.get_json_object("end", "$.logOffset").cast("bigint")).first()[0]
    entries = spark.read.text(f"{checkpoint}/sources/{source}").select(
        F.from_json("value", "path string, batchId bigint").alias("entry")
    )
    read = entries.where(F.col("entry.batchId") <= last).select(_file("entry.path")).distinct()
    per_file = (
        read_log(spark, path).groupBy(_file("_metadata.file_path"), "topic", "partition")
        .agg(F.max("offset").alias("last"))
    )
    return (
        per_file.join(read, "file", "left_semi").groupBy("topic", "partition")
        .agg((F.max("last") + 1).alias("committed_offset"))
    )
