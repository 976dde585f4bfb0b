"""Versions of a key: the latest one, and comparing tables with logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from paystream.operators.dedup import first_per


def latest_per_key(
    versions: DataFrame, key: str = "aggregate_key", version: Sequence[str] = ("offset",)
) -> DataFrame:
    """The row with the greatest version of each key; the offset in the key's partition."""
    return first_per(versions, [key], [F.col(c).desc() for c in version])


def reconcile(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Compare two tables with one row per key: match, differs, only_left or only_right."""
    a = left.select(key, F.struct(*columns).alias("left"))
    b = right.select(key, F.struct(*columns).alias("right"))
    same = reduce(and_, (F.col(f"left.{c}").eqNullSafe(F.col(f"right.{c}")) for c in columns))
    outcome = (
        F.when(F.col("right").isNull(), "only_left")
        .when(F.col("left").isNull(), "only_right")
        .when(same, "match")
        .otherwise("differs")
    )
    return a.join(b, key, "full_outer").select(key, outcome.alias("outcome"), "left", "right")


def totals(rows: DataFrame) -> DataFrame:
    """Number of rows, payments and money in a table of aggregates."""
    return rows.agg(
        F.count(F.lit(1)).alias("aggregates"),
        F.coalesce(F.sum("transaction_count"), F.lit(0)).alias("transaction_count"),
        F.coalesce(
            F.sum(F.col("total_amount_pyg").cast("decimal(20,0)")), F.lit(0)
        ).cast("decimal(38,0)").alias("total_amount_pyg"),
    )


def column_audit(rows: DataFrame) -> DataFrame:
    """One row per column: its type, whether that is whole numbers, rows, nulls, least and greatest.

    One aggregation for all columns. Least and greatest are by the column's own order, as text.
    """
    counted = rows.agg(F.array(*(
        F.struct(
            F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("data_type"),
            F.lit(isinstance(field.dataType, IntegralType)).alias("whole"),
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col(field.name).isNull()).alias("nulls"),
            F.min(field.name).cast("string").alias("least"), F.max(field.name).cast("string").alias("greatest"),
        )
        for field in rows.schema
    )).alias("columns"))
    return counted.select(F.inline("columns"))


def column_types(rows: DataFrame) -> dict[str, str]:
    """Type of each column, to assert that money and counts are integers."""
    return {field.name: field.dataType.simpleString() for field in rows.schema}
