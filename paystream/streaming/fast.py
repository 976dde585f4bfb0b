"""Streaming with built-in operators: dead letters, deduplication, windows, materialization."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from paystream.config import DEFAULT, StreamConfig
from paystream.operators.contract import check_events
from paystream.operators.route import confirmed, dead_letters, invalid_events, valid_events
from paystream.operators.windows import aggregate_windows, label_windows, with_wide
from paystream.schemas import payment_columns
from paystream.sources.table import materialize

# Send the code below to the executors with each task; they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAYMENT_COLUMNS = payment_columns()


def first_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of copies with equal id and time, the first in each Arrow batch."""
    for batch in batches:
        keys = batch.select(["event_id", "event_us", "partition", "offset"]).to_pandas()
        ordered = keys.sort_values(["partition", "offset"], kind="stable")
        yield batch.take(pa.array(ordered.drop_duplicates(["event_id", "event_us"]).index))


def combine_copies(payments: DataFrame) -> DataFrame:
    """Thin out copies before the shuffle by id, which a much repeated id would otherwise clog.

    Copies of one event have the same time, so whatever is decided by time about the first one
    holds for all of them, and the result of any later deduplication is the same. Takes payments
    with ``event_us`` (microseconds) in place of ``event_ts``.
    """
    return payments.mapInArrow(first_copies, payments.schema)


def confirmed_payments(records: DataFrame) -> DataFrame:
    """The confirmed events of a raw log, reduced to what is counted."""
    return confirmed(valid_events(check_events(records))).select(*PAYMENT_COLUMNS)


def dead_letter_stream(records: DataFrame) -> DataFrame:
    """Invalid records of a log as dead letters."""
    return dead_letters(invalid_events(check_events(records)))


def deduplicate_stream(payments: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """At most one event per id while its window is open; the time becomes that of the window.

    The watermark lags by the lateness and no more, and rows carry the last instant of their
    window as event time. So a payment is accepted as long as its window is, which ends exactly
    the lateness after the window; with its own time it would be refused while that is open.
    """
    combined = combine_copies(
        with_wide(payments).select("event_id", F.unix_micros("event_ts").alias("event_us"),
                        "merchant_id", "amount", "amount_wide", "partition", "offset")
    )
    return (
        combined.withColumn("event_ts", F.timestamp_micros("event_us"))
        .withWatermark("event_ts", config.lateness)
        .withColumn("in_window", F.window("event_ts", config.window))
        .select("event_id", "merchant_id", "amount", "amount_wide", "partition", "offset",
                F.window_time("in_window").alias("event_ts"))
        .dropDuplicatesWithinWatermark(["event_id"])
    )


def aggregate_payments(payments: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Payments to labelled window rows.

    Written in append mode each window gives one final row; in update mode one row per
    micro-batch that changed it, each with the total so far.
    """
    return label_windows(aggregate_windows(deduplicate_stream(payments, config), config))


def aggregate_stream(records: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Raw log to labelled window rows."""
    return aggregate_payments(confirmed_payments(records), config)


def only_plausible(payments: DataFrame, log_time: str, max_ahead: str) -> DataFrame:
    """Drop payments dated further ahead of their log time than ``max_ahead``.

    One event from the far future moves the watermark past everything else.
    """
    return payments.filter(F.col("event_ts") <= F.col(log_time) + F.expr(f"INTERVAL {max_ahead}"))


def table_writer(aggregates: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Stream aggregate records into the stored table.

    A micro-batch is stored whole or not at all: a record that breaks the contract stops the
    query, and the batch is read again after a restart. Batches are named by the query's id,
    which belongs to its checkpoint, so a new checkpoint never meets the batches of an old one.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        materialize(batch, path, f"stream-{run}", batch_id)

    return aggregates.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
