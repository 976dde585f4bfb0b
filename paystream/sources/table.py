"""The stored aggregates: an upsert by key as appended versions, the latest of which counts.

Each batch writes only its own rows, under a name readers pass over, and gets its own folder by
one rename when it is complete. A folder that is there is never written again: a replay finds it
and changes nothing, a failed write leaves the table as it was. Where a table format with MERGE
INTO is at hand, use that.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystream.operators.aggregate_contract import check_aggregates
from paystream.operators.latest import latest_per_key
from paystream.schemas import AGGREGATE_COLUMNS, VERSIONS
from paystream.sources.records import end_of_run, until

TABLE_NAME = "merchant_window_aggregates"


def create_table(spark: SparkSession, path: str) -> None:
    """Make an empty table where there is none; an existing one is left alone."""
    empty = spark.createDataFrame([], VERSIONS).drop("run", "batch_id", "window_date")
    store_versions(empty, path, "created", 0)


def checked_rows(records: DataFrame) -> DataFrame:
    """Typed rows of aggregate records; the first broken contract fails the job that reads them.

    So does a number that the table's 64-bit columns cannot hold, though the contract allows it.
    """
    where = F.concat_ws("/", "topic", "partition", "offset")
    refused = F.raise_error(F.concat(F.lit("aggregate refused: "), "error", F.lit(" at "), where))
    fits = F.col("transaction_count_wide").isNull() & F.col("total_amount_wide").isNull()
    too_wide = F.raise_error(F.concat(F.lit("aggregate refused: number beyond 64 bits at "), where))
    key = (
        F.when(F.col("error").isNotNull(), refused)
        .when(~fits, too_wide)
        .otherwise(F.col("aggregate_key"))
    )
    return check_aggregates(records).select(
        key.alias("aggregate_key"), *AGGREGATE_COLUMNS[1:], F.col("offset").alias("version")
    )


def store_versions(rows: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Write one batch of rows ``(aggregate columns, version)``, unless it is there already.

    ``run`` names whatever numbers the batches: a checkpoint, or a single run. A window start
    that is no date, which the contract allows, goes into the folder without one.
    """
    spark = rows.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(f"{path}/run={run}/batch_id={batch_id}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target):
        return
    staged = f"{path}/_staged/{uuid.uuid4().hex}"
    (
        rows.withColumn("window_date", F.substring("window_start", 1, 10).try_cast("date"))
        .write.partitionBy("window_date").parquet(staged)
    )
    files.mkdirs(target.getParent())
    if not files.rename(hadoop.Path(staged), target):
        raise OSError(f"{target} could not be put in place")


def materialize(records: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Check a batch of aggregate records and store it, all or nothing."""
    store_versions(checked_rows(records), path, run, batch_id)


def materialize_next(records: DataFrame, path: str, most: int | None = None) -> None:
    """Store the first ``most`` records that no earlier run of this kind has stored.

    Where the run ends is settled before it starts, and both the rows and the progress that is
    noted follow from that; what comes in meanwhile waits for the next run. The rows come first, the offsets after them: a run that stops in between reads its records
    again, which changes nothing, and one that fails leaves both as they were.
    """
    spark = records.sparkSession
    log = f"{path}/_progress"
    place = spark._jvm.org.apache.hadoop.fs.Path(log)
    known = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    rest = records
    if known:
        done = spark.read.parquet(log).groupBy("topic", "partition").agg(F.max("next").alias("next"))
        rest = records.join(F.broadcast(done), ["topic", "partition"], "left").where(
            "offset >= coalesce(next, offset)"
        ).select(*records.columns)
    ends = end_of_run(rest, most)
    if not ends:
        return
    materialize(until(rest, ends), path, f"bounded-{uuid.uuid4().hex}", 0)
    progress = spark.createDataFrame(ends, "topic STRING, partition INT, next BIGINT")
    progress.coalesce(1).write.mode("append").parquet(log)


def stored_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VERSIONS).parquet(path)


def current_rows(spark: SparkSession, path: str) -> DataFrame:
    """The table as users see it: one row per key.

    Filter on ``window_date`` first via :func:`stored_versions` to read only some days.
    """
    return latest_rows(stored_versions(spark, path))


def latest_rows(versions: DataFrame) -> DataFrame:
    return latest_per_key(versions, "aggregate_key", ["version", "batch_id"]).select(
        *AGGREGATE_COLUMNS
    )


def compact(spark: SparkSession, source: str, target: str) -> None:
    """Copy a table to a new path: only the latest version of each key, in files of even size."""
    versions = stored_versions(spark, source)
    rows = latest_per_key(versions, "aggregate_key", ["version", "batch_id"])
    even = rows.select(*AGGREGATE_COLUMNS, "version", "window_date").hint(
        "rebalance", "window_date"
    )
    store_versions(even, target, "compacted", 0)
