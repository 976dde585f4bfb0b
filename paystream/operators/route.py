"""Routing of checked events: valid or dead letter, counted or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystream.config import COUNTED_STATUS
from paystream.functions.rules import BAD_ENCODING, BAD_JSON, NO_OBJECT
from paystream.functions.text import as_text, readable
from paystream.operators.contract import check_events
from paystream.schemas import LETTERS, PAYMENTS, payment_columns


def valid_events(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") == 0).drop("errors")


def invalid_events(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") > 0)


def confirmed(events: DataFrame) -> DataFrame:
    """The events that count."""
    return events.filter(F.col("status") == COUNTED_STATUS)


def split_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw records to (confirmed events, invalid records with their errors)."""
    checked = check_events(records)
    return confirmed(valid_events(checked)), invalid_events(checked)


def _letter_key() -> Column:
    """The event id if there is a usable one, else empty, never null."""
    return F.coalesce("event_id", F.lit("")).cast("binary")


def _letter_value() -> Column:
    """``errors`` and ``raw_data``: the event as an object, or readable text if it is none.

    An object that a variant would change (numbers of many digits, NaN) stands there as it was
    written, which it can: it is one whole JSON document.
    """
    undecoded = f"get(errors, 0) IN ('{BAD_ENCODING}', '{BAD_JSON}', '{NO_OBJECT}')"
    text = as_text("value")
    raw = (
        f"CASE WHEN {undecoded} THEN to_json(cast({readable('value')} AS VARIANT)) "
        f"WHEN {text} RLIKE '[0-9]{{19}}' THEN {text} "
        f"ELSE coalesce(to_json(try_parse_json({text})), {text}) END"
    )
    return F.expr(
        f"""cast(concat('{{"errors":', to_json(errors), ',"raw_data":', {raw}, '}}') AS BINARY)"""
    )


def dead_letters(invalid: DataFrame) -> DataFrame:
    """Invalid records as key and JSON value of the dead-letter log, plus their origin."""
    return invalid.select(
        _letter_key().alias("key"),
        _letter_value().alias("value"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
    )


def routed(checked: DataFrame) -> DataFrame:
    """Both outputs of one parse as rows of one table: ROUTED.

    A letter has ``key`` and ``value``, a payment the columns that are counted. Written by one
    writer, partitioned by ``route``, both come into being in one commit. Valid events that do
    not count are left out.
    """
    bad = F.size("errors") > 0
    counts = F.col("status") == COUNTED_STATUS
    return checked.filter(bad | counts).select(
        F.when(bad, LETTERS).otherwise(PAYMENTS).alias("route"),
        F.when(bad, _letter_key()).alias("key"),
        F.when(bad, _letter_value()).alias("value"),
        *(
            F.col(name) if name in ("partition", "offset") else F.when(~bad, F.col(name)).alias(name)
            for name in payment_columns()
        ),
    )


def routed_log(checked: DataFrame, confirmed_topic: str, dead_letter_topic: str) -> DataFrame:
    """Both outputs of one parse as records with a ``topic`` column, for one writer.

    The Kafka writer sends each row to the topic it names and the file writer can partition by
    it, so valid and invalid records part without reading or parsing anything twice. Valid
    events that do not count are left out.
    """
    bad = F.size("errors") > 0
    counts = F.col("status") == COUNTED_STATUS
    return checked.filter(bad | counts).select(
        F.when(bad, _letter_key()).otherwise(F.col("event_key").cast("binary")).alias("key"),
        F.when(bad, _letter_value()).otherwise(F.col("value")).alias("value"),
        F.when(bad, F.lit(dead_letter_topic)).otherwise(F.lit(confirmed_topic)).alias("topic"),
    )
