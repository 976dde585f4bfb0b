"""Event-time windows: count and total per merchant, on tables and on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystream.config import DEFAULT, SCHEMA_VERSION, StreamConfig
from paystream.functions.digits import LIMB, carried, limbs
from paystream.functions.iso_time import format_boundary
from paystream.schemas import AGGREGATE_COLUMNS

# Wide enough that no sum of limbs overflows.
_SUM = "decimal(38,0)"
#: Limbs of an amount in a stream, where update mode has room for one aggregation only.
STREAM_LIMBS = 6


def with_wide(payments: DataFrame) -> DataFrame:
    """Payments with a column for amounts beyond 64 bits, empty where they came without."""
    if "amount_wide" in payments.columns:
        return payments
    return payments.withColumn("amount_wide", F.lit(None).cast("string"))


def _by_places(payments: DataFrame, config: StreamConfig) -> DataFrame:
    """Count and sums by place. One row of a window for each place, then one for the window."""
    parts = with_wide(payments).selectExpr(
        "merchant_id", "event_ts", f"inline({limbs('amount', 'amount_wide')})"
    )
    by_place = parts.groupBy("merchant_id", F.window("event_ts", config.window), "place").agg(
        F.count(F.lit(1)).alias("n"), F.sum("part").cast(_SUM).alias("part")
    )
    return by_place.groupBy("merchant_id", "window").agg(
        # Every amount has a part at place 0.
        F.max("n").alias("transaction_count"),
        F.collect_list(F.struct("place", "part")).alias("parts"),
    )


def _in_columns(payments: DataFrame, config: StreamConfig) -> DataFrame:
    """The same in one aggregation, with a column for each of the first places."""
    size = f"size(_limbs) > {STREAM_LIMBS}"
    refused = f"raise_error('amount of more than {STREAM_LIMBS * LIMB} digits, use the exact stream')"
    split = with_wide(payments).selectExpr(
        "merchant_id", "event_ts", f"{limbs('amount', 'amount_wide')} AS _limbs"
    ).selectExpr("merchant_id", "event_ts", f"CASE WHEN {size} THEN {refused} ELSE _limbs END AS _limbs")
    places = range(STREAM_LIMBS)
    sums = split.groupBy("merchant_id", F.window("event_ts", config.window)).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        *(F.sum(F.expr(f"get(_limbs, {k}).part")).cast(_SUM).alias(f"_part{k}") for k in places),
    )
    parts = F.array(*(
        F.when(F.col(f"_part{k}").isNotNull(), F.struct(F.lit(k).alias("place"), F.col(f"_part{k}").alias("part")))
        for k in places
    ))
    return sums.withColumn("parts", F.array_compact(parts))


def aggregate_windows(payments: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Count and exact total per merchant and tumbling window ``[start, end)`` of event time.

    ``total_amount_pyg`` is text, the digits of an integer of any size. Amounts are summed within
    each task before the shuffle, by places of 18 digits, so a merchant with a third of all
    payments costs no more than any other, and a window has one row for each place. A JSON
    number has at most 1,000 digits, which are 56 places.

    On a stream the caller sets the watermark, and an amount of more than 108 digits stops the
    query; the exact stream takes any.
    """
    sums = _in_columns(payments, config) if payments.isStreaming else _by_places(payments, config)
    return sums.select(
        "merchant_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "transaction_count",
        F.expr(carried("parts")).alias("total_amount_pyg"),
    )


def label_windows(windows: DataFrame, *extra: str) -> DataFrame:
    """Window rows with text bounds and the key all versions of a window share.

    The total is still text; it may exceed 64 bits.
    """
    start, end = format_boundary("window_start"), format_boundary("window_end")
    labelled = {
        "aggregate_key": f"concat_ws('|', merchant_id, {start})",
        "window_start": start,
        "window_end": end,
    }
    columns = (f"{labelled.get(c, c)} AS {c}" for c in AGGREGATE_COLUMNS)
    return windows.selectExpr(*columns, *extra)


def to_table_types(labelled: DataFrame) -> DataFrame:
    """Totals as 64-bit integers; a larger one raises instead of being changed."""
    return labelled.withColumn("total_amount_pyg", F.col("total_amount_pyg").cast(_SUM).cast("bigint"))


def serialize_aggregates(labelled: DataFrame, *extra: str) -> DataFrame:
    """Window rows as key and JSON value of the aggregates log, keys in alphabetical order.

    Numbers are written digit by digit, so totals of any size come through.
    """
    def quoted(column: str) -> str:
        return f"to_json(cast({column} AS VARIANT))"

    value = f"""concat('{{"key":', {quoted('aggregate_key')},
        ',"payload":{{"merchant_id":', {quoted('merchant_id')},
        ',"total_amount_pyg":', cast(total_amount_pyg AS STRING),
        ',"transaction_count":', cast(transaction_count AS STRING),
        '}},"schema_version":{SCHEMA_VERSION},"window_end":', {quoted('window_end')},
        ',"window_start":', {quoted('window_start')}, '}}')"""
    return labelled.select(
        F.col("aggregate_key").cast("binary").alias("key"),
        F.expr(value).cast("binary").alias("value"),
        *extra,
    )
