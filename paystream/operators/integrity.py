"""Whether a log is what it should be: numbered without doubles, gaps or steps back, keys in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Offsets that are looked at together; a partition has many such blocks.
BLOCK = 65_536


def log_integrity(log: DataFrame, block: int = BLOCK) -> DataFrame:
    """What is wrong with the numbering of each partition.

    Per topic and partition: ``records``, first and end offset, ``repeats`` (records whose offset
    was there before), ``gaps`` (places where offsets are left out), ``missing`` (offsets left
    out) and ``inversions`` (offsets with an earlier time than the one before; of a repeated
    offset the earliest time counts, and a null time is no inversion).

    Records are first counted by offset, which combines in each task, so a much repeated offset
    is harmless. Then each block of offsets is put in order by itself, and only one row per block
    is put in order by partition: a hot partition is as many tasks as it has blocks.
    """
    place = ["topic", "partition"]
    offsets = log.groupBy(*place, "offset").agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("at"))
    offsets = offsets.withColumn("block", F.floor(F.col("offset") / block))
    inside = Window.partitionBy(*place, "block").orderBy("offset")
    steps = offsets.withColumn("skipped", F.col("offset") - F.lag("offset").over(inside) - 1).withColumn(
        "back", F.col("at") < F.lag("at").over(inside)
    )
    blocks = steps.groupBy(*place, "block").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("offsets"),
        F.min("offset").alias("low"), F.max("offset").alias("high"),
        F.min_by("at", "offset").alias("low_at"), F.max_by("at", "offset").alias("high_at"),
        F.count_if(F.col("skipped") > 0).alias("gaps"), F.count_if("back").alias("inversions"),
    )
    between = Window.partitionBy(*place).orderBy("block")
    edges = blocks.withColumn("skipped", F.col("low") - F.lag("high").over(between) - 1).withColumn(
        "back", F.col("low_at") < F.lag("high_at").over(between)
    )
    return edges.groupBy(*place).agg(
        F.sum("n").alias("records"), F.min("low").alias("first_offset"), (F.max("high") + 1).alias("end_offset"),
        F.sum(F.col("n") - F.col("offsets")).alias("repeats"),
        (F.sum("gaps") + F.count_if(F.col("skipped") > 0)).alias("gaps"),
        (F.max("high") + 1 - F.min("low") - F.sum("offsets")).alias("missing"),
        (F.sum("inversions") + F.count_if("back")).alias("inversions"),
    )


def strayed_keys(log: DataFrame) -> DataFrame:
    """Keys with records in more than one partition of a topic, whose order is therefore undefined.

    Counted by key and partition first, so a key with very many records is one row per task.
    """
    per_place = log.groupBy("topic", "key", "partition").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_place.groupBy("topic", "key")
        .agg(F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("records"))
        .where("partitions > 1")
    )
