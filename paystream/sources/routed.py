"""The routed log: both outputs of one parse, on their way to the sinks.

Payments and dead letters of a micro-batch are files of one batch of Spark's file sink, so either
both are there or none is, and a batch that runs again replaces itself. What reads them never
parses a record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from paystream.operators.contract import check_events
from paystream.operators.route import routed
from paystream.schemas import LETTERS, PAYMENTS, ROUTED, payment_columns


def route_writer(records: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Parse a raw log, once, into the routed log."""
    return (
        routed(check_events(records)).writeStream.format("parquet").partitionBy("route")
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def write_routed(records: DataFrame, path: str) -> None:
    """The same for a table."""
    routed(check_events(records)).write.partitionBy("route").parquet(path)


def _read(
    spark: SparkSession, path: str, stream: bool, bytes_per_batch: str | None
) -> DataFrame:
    if not stream:
        return spark.read.schema(ROUTED).parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)
    reader = spark.readStream.schema(ROUTED)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.parquet(path)


def read_payments(
    spark: SparkSession, path: str, stream: bool = False, bytes_per_batch: str | None = None
) -> DataFrame:
    """The confirmed payments; only their files are read."""
    rows = _read(spark, path, stream, bytes_per_batch)
    return rows.filter(f"route = '{PAYMENTS}'").select(*payment_columns())


def read_letters(
    spark: SparkSession, path: str, stream: bool = False, bytes_per_batch: str | None = None
) -> DataFrame:
    """The dead letters, key and value; only their files are read."""
    rows = _read(spark, path, stream, bytes_per_batch)
    return rows.filter(f"route = '{LETTERS}'").select("key", "value")
