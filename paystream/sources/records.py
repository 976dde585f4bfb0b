"""Reading and writing record logs: Kafka topics, or files with the same columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from paystream.schemas import RECORD


def kafka_source_options(
    servers: str, topic: str, group: str | None = None, per_batch: int | None = None
) -> dict[str, str]:
    """Options to read a topic from its start. Progress is kept in the query's checkpoint."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if group:
        # A prefix: queries of one job on one topic must not share a group.
        options["groupIdPrefix"] = group
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def read_topic(spark: SparkSession, options: dict[str, str], stream: bool = True) -> DataFrame:
    """A topic as records; needs the Kafka connector on the class path."""
    reader = spark.readStream if stream else spark.read
    if not stream:
        options = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    return reader.format("kafka").options(**options).load().select(*_columns())


def _columns() -> list[str]:
    return [part.split()[0] for part in RECORD.split(", ")]


def read_log(
    spark: SparkSession, path: str, stream: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Record files (Parquet) as a table or, as they arrive, as a stream."""
    if not stream:
        return spark.read.schema(RECORD).parquet(path)
    reader = spark.readStream.schema(RECORD)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


#: Ranges into which offsets are divided when one is looked for.
RANGES = 1024


def _last_offset(offsets: DataFrame, low: int, high: int, records: int) -> int:
    """The offset of the record number ``records`` between ``low`` and ``high``.

    Counts of equal ranges of offsets tell which range it is in, and so on within that one: each
    pass is one small aggregation on as many tasks as the log has, and nothing is sorted.
    """
    while low < high:
        width = -(-(high - low + 1) // RANGES)
        counts = (
            offsets.where(F.col("offset").between(low, high))
            .groupBy(F.expr(f"(offset - {low}) div {width}").alias("range")).count().orderBy("range")
        )
        for row in counts.collect():
            if records <= row["count"]:
                low, high = low + row["range"] * width, min(high, low + (row["range"] + 1) * width - 1)
                break
            records -= row["count"]
    return low


def end_of_run(log: DataFrame, records: int | None) -> list[tuple[str, int, int]]:
    """Where a bounded run ends: ``(topic, partition, next offset)`` of each partition it reads.

    The run has the first ``records`` records by topic, partition and offset, or all that are
    there now (None). Offsets of a partition must differ.
    """
    ends = []
    left = records
    place = ["topic", "partition"]
    sizes = log.groupBy(*place).agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("low"), F.max("offset").alias("high")
    )
    for row in sizes.orderBy(*place).collect():
        if left is None or row["n"] <= left:
            ends.append((row["topic"], row["partition"], row["high"] + 1))
        elif left:
            same = F.col("topic").eqNullSafe(row["topic"]) & (F.col("partition") == row["partition"])
            last = _last_offset(log.where(same).select("offset"), row["low"], row["high"], left)
            ends.append((row["topic"], row["partition"], last + 1))
        left = left if left is None else left - min(left, row["n"])
    return ends


def until(log: DataFrame, ends: Sequence[tuple[str, int, int]]) -> DataFrame:
    """The records before these ends, which stay the same when more come in.

    A join with a broadcast row for each partition, so whatever comes next runs on as many tasks
    as the log has.
    """
    ends = log.sparkSession.createDataFrame(list(ends), "topic STRING, partition INT, next BIGINT")
    end = F.broadcast(ends.select(F.col("topic").alias("_topic"), F.col("partition").alias("_partition"), "next"))
    same = log["topic"].eqNullSafe(F.col("_topic")) & (log["partition"] == F.col("_partition"))
    return log.join(end, same & (log["offset"] < F.col("next")), "left_semi")


def bounded(log: DataFrame, records: int | None) -> DataFrame:
    """The first ``records`` records by partition and offset, for a trial run; None for all."""
    return log if records is None else until(log, end_of_run(log, records))


def keyed_records(events: DataFrame, key: str = "key", beside: Sequence[str] = ()) -> DataFrame:
    """Event rows as record key (UTF-8) and JSON value. A key that is no string is refused.

    Columns ``beside`` the record stay what they are and don't enter the value.
    """
    if dict(events.dtypes)[key] != "string":
        raise TypeError(f"record key {key!r} must be a string column")
    return events.select(
        F.col(key).cast("binary").alias("key"),
        F.to_json(F.struct(*(c for c in events.columns if c not in beside))).cast("binary").alias("value"),
        *beside,
    )


def stamped(records: DataFrame, topic: str, partitions: int = 3) -> DataFrame:
    """Key and value as full records of a file log, where no broker numbers them.

    All versions of a key share a partition, and later ones have greater offsets: the time of the
    batch comes first, then, if there is one, the ``pane_index``.
    """
    place = F.col("pane_index") if "pane_index" in records.columns else F.lit(0)
    return records.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("partition"),
        (F.shiftleft(F.unix_millis(F.current_timestamp()), 22) + place).alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def write_topic(records: DataFrame, servers: str, topic: str | None = None) -> None:
    """Write records to a topic, or each to the one in its ``topic`` column."""
    writer = records.write.format("kafka").option("kafka.bootstrap.servers", servers)
    (writer.option("topic", topic) if topic else writer).save()


def topic_writer(
    records: DataFrame, servers: str, checkpoint: str, topic: str | None = None,
    mode: str = "append",
) -> DataStreamWriter:
    writer = (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
    )
    return writer.option("topic", topic) if topic else writer


def write_log(records: DataFrame, path: str) -> None:
    """Append records to a file log."""
    records.write.mode("append").parquet(path)


def log_writer(records: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Stream into a file log; Spark's commit log makes each batch appear once or not at all."""
    return (
        records.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
