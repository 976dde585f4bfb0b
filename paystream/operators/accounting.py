"""How many records each stage took in and let through, and how far readers are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystream.config import COUNTED_STATUS


def stage_counts(checked: DataFrame) -> DataFrame:
    """Records, dead letters, valid, confirmed and distinct confirmed events, in one pass.

    Rows are first counted per confirmed id (all others together), which combines in each task,
    and the few counters are then added up.
    """
    valid = F.size("errors") == 0
    counted = F.coalesce(valid & (F.col("status") == COUNTED_STATUS), F.lit(False))
    per_id = (
        checked.select(valid.alias("valid"), F.when(counted, F.col("event_id")).alias("id"))
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("valid").alias("n_valid"))
    )
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.coalesce(F.sum(F.col("n") - F.col("n_valid")), F.lit(0)).alias("dead_letters"),
        F.coalesce(F.sum("n_valid"), F.lit(0)).alias("valid"),
        F.coalesce(F.sum(F.when(F.col("id").isNotNull(), F.col("n"))), F.lit(0)).alias(
            "confirmed"
        ),
        F.count("id").alias("unique_confirmed"),
    )


def observe_stages(checked: DataFrame, name: str) -> DataFrame:
    """Count records, dead letters and confirmed events as they pass, without a pass of their own.

    The counts appear under ``name`` in the progress of each micro-batch of a stream, or in a
    :class:`pyspark.sql.Observation` of that name on a table.
    """
    valid = F.size("errors") == 0
    return checked.observe(
        name,
        F.count(F.lit(1)).alias("records"),
        F.count_if(~valid).alias("dead_letters"),
        F.count_if(valid).alias("valid"),
        F.count_if(valid & (F.col("status") == COUNTED_STATUS)).alias("confirmed"),
    )


def end_offsets(log: DataFrame) -> DataFrame:
    """Records and end offset (last offset + 1) of each partition."""
    return log.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), (F.max("offset") + 1).alias("end_offset")
    )


def consumer_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Records a reader still has to fetch per partition; nothing committed counts from 0."""
    done = committed.select("topic", "partition", "committed_offset")
    return ends.join(done, ["topic", "partition"], "left").select(
        "topic",
        "partition",
        "end_offset",
        F.coalesce("committed_offset", F.lit(0)).cast("bigint").alias("committed_offset"),
        (F.col("end_offset") - F.coalesce("committed_offset", F.lit(0))).alias("lag"),
    )
