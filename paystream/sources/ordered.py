"""A result that is stored in its order, and read in it without sorting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_ordered(rows: DataFrame, path: str, order: Sequence[str]) -> None:
    """Store rows by ranges of ``order``, a sorted file for each, and how many rows lie before it.

    Nulls come first; rows that are equal in ``order`` stand in any order. Rows have no columns
    ``part`` and ``position``, which reading adds. Beside the sort there is one pass over the
    footers of the files and a table with one row per file.
    """
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    # Sorted by part as well, which is the same, so that the writer doesn't sort again.
    ranged.sortWithinPartitions("part", *order).write.option("maxRecordsPerFile", 0).partitionBy("part").parquet(f"{path}/rows")
    # The columns, which a table without rows has no file to tell.
    ranged.limit(0).write.parquet(f"{path}/columns")
    sizes = spark.read.schema(ranged.schema).parquet(f"{path}/rows").groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    until = F.sum("n").over(Window.orderBy("part"))
    sizes.select("part", (until - F.col("n")).alias("first"), until.alias("end")).coalesce(1).write.parquet(f"{path}/parts")


def read_ordered(spark: SparkSession, path: str, first: int = 0, end: int | None = None) -> DataFrame:
    """Rows with their ``position`` in the order, from 0; those from ``first`` up to before ``end``.

    Where a row stands follows from its file and its place there. A page reads only the files
    that hold it: the small table of files is filtered and prunes the rest.
    """
    parts = spark.read.parquet(f"{path}/parts").where(F.col("end") > first)
    if end is not None:
        parts = parts.where(F.col("first") < end)
    columns = spark.read.parquet(f"{path}/columns").schema
    rows = spark.read.schema(columns).parquet(f"{path}/rows").select("*", F.col("_metadata.row_index").alias("_place"))
    placed = rows.join(F.broadcast(parts.withColumnRenamed("first", "_first").drop("end")), "part")
    placed = placed.withColumn("position", F.col("_first") + F.col("_place")).drop("part", "_first", "_place")
    return placed.where((F.col("position") >= first) & (F.lit(end is None) | (F.col("position") < (end or 0))))
