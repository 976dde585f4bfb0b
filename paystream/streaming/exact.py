"""Streaming operators with exact expiry and panes: arbitrary state where Spark has no built-in.

Both take the watermark to be the greatest event time of all earlier micro-batches. It is set
ahead of a stateless step in Python, so late rows are not dropped on entry: these operators decide
themselves, by the rules of the horizon and of allowed lateness, what is too late.

Amounts travel as digits and are summed as Python integers, so they may have any size.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from paystream.config import DEFAULT, StreamConfig
from paystream.functions.digits import digits_of
from paystream.operators.windows import label_windows, with_wide
from paystream.streaming.fast import combine_copies, confirmed_payments

# Send the code below to the executors with each task; they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NO_DELAY = "0 seconds"
CLOCKED = (
    "event_id STRING, event_us BIGINT, merchant_id STRING, digits STRING, "
    "partition INT, offset BIGINT"
)
#: An accepted payment and the watermark at which it was accepted.
ACCEPTED = f"{CLOCKED}, clock_us BIGINT"
_PART = (
    "merchant_id STRING, window_us BIGINT, late BOOLEAN, partition INT, offset BIGINT, "
    "n BIGINT, digits STRING"
)
PANE = (
    "merchant_id STRING, window_us BIGINT, timing STRING, pane_index BIGINT, "
    "transaction_count BIGINT, total_amount_pyg STRING"
)
#: What is remembered of an id.
KNOWN = pa.schema([("event_id", pa.string()), ("deadline_us", pa.int64())])


class _OncePerHorizon(StatefulProcessor):
    """Remembers the ids of a bucket, each until the watermark has passed its first event by the horizon.

    The ids of a bucket are one value, a table in Arrow's stream format: it is read and written in
    one round trip and handled by columns, so an id that is remembered costs next to nothing when
    others of its bucket come. What has expired is left out whenever the value is written; a timer
    does that for buckets to which nothing comes any more.
    """

    def __init__(self, horizon_us: int) -> None:
        self.horizon_us = horizon_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "ids BINARY")

    def _live(self, watermark_us: int) -> pa.Table:
        known = self.known.get()
        if known is None:
            return KNOWN.empty_table()
        ids = pa.ipc.open_stream(bytes(known[0])).read_all()
        return ids.filter(pc.greater(ids["deadline_us"], watermark_us))

    def _keep(self, live: pa.Table) -> None:
        if live.num_rows:
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, KNOWN) as writer:
                writer.write_table(live.combine_chunks())
            self.known.update((out.getvalue().to_pybytes(),))
            # Whole horizons, so that a bucket has few timers at a time.
            latest = -(-pc.max(live["deadline_us"]).as_py() // self.horizon_us) * self.horizon_us
            self.handle.registerTimer(-(-latest // 1000))
        else:
            self.known.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark_us = timerValues.getCurrentWatermarkInMs() * 1000
        live = self._live(watermark_us)
        arrived = pd.concat(rows, ignore_index=True).sort_values(["partition", "offset"], kind="stable")
        first = arrived.drop_duplicates("event_id")
        known = pc.is_in(pa.array(first["event_id"], pa.string()), live["event_id"])
        new = first[~known.to_numpy(zero_copy_only=False)]
        added = pa.table([new["event_id"], new["event_us"] + self.horizon_us], schema=KNOWN)
        self._keep(pa.concat_tables([live, added.filter(pc.greater(added["deadline_us"], watermark_us))]))
        yield new.assign(clock_us=watermark_us)[[part.split()[0] for part in ACCEPTED.split(", ")]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._keep(self._live(timerValues.getCurrentWatermarkInMs() * 1000))
        return iter([])

    def close(self) -> None:
        pass


def with_event_clock(payments: DataFrame, delay: str = NO_DELAY) -> DataFrame:
    """Payments with event time as microseconds, after the watermark was set on it."""
    return with_wide(payments).withWatermark("event_ts", delay).select(
        "event_id", F.unix_micros("event_ts").alias("event_us"), "merchant_id",
        F.expr(digits_of("amount", "amount_wide")).alias("digits"), "partition", "offset",
    )


def deduplicate_exactly(clocked: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """First arrival per id; the id passes again once the watermark is a horizon past it.

    A duplicate does not prolong the horizon. Input as of :func:`with_event_clock`, output with
    the watermark at which each payment was accepted.
    """
    bucket = F.pmod(F.xxhash64("event_id"), F.lit(config.buckets))
    return (
        combine_copies(clocked)
        .withColumn("bucket", bucket)
        .groupBy("bucket")
        .transformWithStateInPandas(
            _OncePerHorizon(config.horizon_seconds * 1_000_000), ACCEPTED, "append", "EventTime"
        )
    )


def _parts(window_us: int, lateness_us: int):
    """Payments of a window within one Arrow batch: one row for all that came before its end.

    Those that came later stay rows of their own, those that came too late are left out. Where it
    is not known when they came, ``late`` is null.
    """
    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in _PART.split(", ")]
        for rows in batches:
            start = rows["event_us"] - rows["event_us"] % window_us
            sums: dict[tuple[str, int], tuple[int, int]] = {}
            out: list[tuple] = []
            clocks = rows["clock_us"] if "clock_us" in rows else pd.Series([None] * len(rows), dtype=object)
            columns = (rows["merchant_id"], start, rows["digits"], clocks, rows["partition"], rows["offset"])
            for merchant, at, digits, clock, partition, offset in zip(*(c.tolist() for c in columns)):
                if clock is None:
                    out.append((merchant, at, None, partition, offset, 1, digits))
                elif clock < at + window_us:
                    n, total = sums.get((merchant, at), (0, 0))
                    sums[merchant, at] = n + 1, total + int(digits)
                elif clock < at + window_us + lateness_us:
                    out.append((merchant, at, True, partition, offset, 1, digits))
            out += [(*key, False, 0, 0, n, str(total)) for key, (n, total) in sums.items()]
            yield pd.DataFrame(out, columns=names)

    return combine


class _Panes(StatefulProcessor):
    """One ON_TIME result when the watermark passes the window end, one LATE per later payment."""

    def __init__(self, window_us: int, lateness_us: int) -> None:
        self.window_us = window_us
        self.lateness_us = lateness_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "count BIGINT, total STRING, panes BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark_us = timerValues.getCurrentWatermarkInMs() * 1000
        end_us = key[1] + self.window_us
        if watermark_us >= end_us + self.lateness_us:
            for _ in rows:
                pass
            return
        known = self.sums.get()
        count, total, panes = (known[0], int(known[1]), known[2]) if known else (0, 0, 0)
        late = []
        for row in rows:
            if row.late or row.late is None and watermark_us >= end_us:
                late.append((row.partition, row.offset, int(row.digits)))
            else:
                count += row.n
                total += int(row.digits)
        if not late:
            if known is None:
                self.handle.registerTimer(-(-end_us // 1000))
        else:
            if known is not None and panes == 0:
                # The end has passed, but its timer only runs after these rows.
                yield self._pane(key, "ON_TIME", 0, count, total)
                panes = 1
            for _, _, amount in sorted(late):
                count += 1
                total += amount
                yield self._pane(key, "LATE", panes, count, total)
                panes += 1
            if known is None or known[2] == 0:
                self.handle.registerTimer(-(-(end_us + self.lateness_us) // 1000))
        self.sums.update((count, str(total), panes))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.sums.get()
        if known is None:
            return
        end_us = key[1] + self.window_us
        count, total, panes = known[0], int(known[1]), known[2]
        if panes == 0:
            yield self._pane(key, "ON_TIME", 0, count, total)
            self.sums.update((count, str(total), 1))
        if timerValues.getCurrentWatermarkInMs() * 1000 >= end_us + self.lateness_us:
            self.sums.clear()
        elif expiredTimerInfo.getExpiryTimeInMs() * 1000 < end_us + self.lateness_us:
            self.handle.registerTimer(-(-(end_us + self.lateness_us) // 1000))

    @staticmethod
    def _pane(key, timing: str, index: int, count: int, total: int) -> Row:
        return Row(
            merchant_id=key[0], window_us=key[1], timing=timing, pane_index=index,
            transaction_count=count, total_amount_pyg=str(total),
        )

    def close(self) -> None:
        pass


def panes(accepted: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Every result of every window, each with the total so far.

    Takes the output of :func:`deduplicate_exactly`, or of :func:`with_event_clock`. Columns
    ``merchant_id, window_start, window_end, timing, pane_index, transaction_count,
    total_amount_pyg`` (digits). A window that only gets late payments has no ON_TIME pane. The
    late payments of one window in one micro-batch, which ``--per-batch`` bounds, are counted by
    partition and offset, however Spark delivers them.

    What a deduplicated stream brings before the end of a window, however much, is added up in
    each task before it is sent to the window's state.
    """
    window_us, lateness_us = config.window_seconds * 1_000_000, config.lateness_seconds * 1_000_000
    results = (
        accepted.mapInPandas(_parts(window_us, lateness_us), _PART)
        .groupBy("merchant_id", "window_us")
        .transformWithState(_Panes(window_us, lateness_us), PANE, "append", "EventTime")
    )
    return results.select(
        "merchant_id",
        F.timestamp_micros("window_us").alias("window_start"),
        F.timestamp_micros(F.col("window_us") + window_us).alias("window_end"),
        "timing",
        "pane_index",
        "transaction_count",
        "total_amount_pyg",
    )


def pane_payments(payments: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Payments to the labelled rows of all panes, with ``timing, pane_index``: every version of a window."""
    accepted = deduplicate_exactly(with_event_clock(payments), config)
    return label_windows(panes(accepted, config), "timing", "pane_index")


def pane_stream(records: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Raw log to the labelled rows of all panes."""
    return pane_payments(confirmed_payments(records), config)
