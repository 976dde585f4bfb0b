"""Deduplication, windows and accounting on tables."""

from __future__ import annotations

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paystream.config import StreamConfig
from paystream.operators.accounting import consumer_lag, end_offsets, stage_counts
from paystream.operators.contract import check_events
from paystream.operators.dedup import deduplicate, deduplicate_within, first_per
from paystream.operators.latest import column_types, latest_per_key, reconcile, totals
from paystream.operators.route import confirmed, valid_events
from paystream.operators.windows import (
    aggregate_windows,
    label_windows,
    serialize_aggregates,
    to_table_types,
)
from tests.helpers import demo_events, event, payments, records


def windows(frame):
    return {
        (r.merchant_id, r.window_start, r.window_end): (r.transaction_count, r.total_amount_pyg)
        for r in to_table_types(label_windows(aggregate_windows(frame))).collect()
    }


def _minute(m):
    return f"2026-01-01T12:{m:02d}:00.000Z"


FIRST = ("merchant-001", _minute(0), _minute(1))
SECOND = ("merchant-001", _minute(1), _minute(2))
OTHER = ("merchant-002", _minute(0), _minute(1))

WINDOW_CASES = {
    "same window": (
        [("a", _minute(0), 10_000), ("b", "2026-01-01T12:00:30Z", 25_000)], {FIRST: (2, 35_000)}),
    "two merchants": (
        [("a", _minute(0), 10_000), ("b", "2026-01-01T12:00:10Z", 20_000, "merchant-002")],
        {FIRST: (1, 10_000), OTHER: (1, 20_000)}),
    "two windows": (
        [("a", _minute(0), 10_000), ("b", _minute(1), 20_000)],
        {FIRST: (1, 10_000), SECOND: (1, 20_000)}),
    "edge belongs to the next": ([("a", _minute(1), 10_000)], {SECOND: (1, 10_000)}),
    "just before the edge": (
        [("a", "2026-01-01T12:00:59.999999Z", 10_000)], {FIRST: (1, 10_000)}),
    "fraction of a second": ([("a", "2026-01-01T12:00:45.500Z", 1)], {FIRST: (1, 1)}),
    "exact sum": (
        [("a", _minute(0), 999_999_999), ("b", _minute(0), 1)], {FIRST: (2, 1_000_000_000)}),
    "any order": (
        [("a", "2026-01-01T12:01:10Z", 25_000), ("b", "2026-01-01T12:00:10Z", 10_000)],
        {FIRST: (1, 10_000), SECOND: (1, 25_000)}),
}


@pytest.mark.parametrize("name", WINDOW_CASES)
def test_windows(spark, name):
    rows, wanted = WINDOW_CASES[name]
    assert windows(payments(spark, rows)) == wanted


def test_total_beyond_64_bits_is_exact_and_not_stored_wrong(spark):
    most = 2**63 - 1
    rows = label_windows(aggregate_windows(
        payments(spark, [("a", _minute(0), most), ("b", _minute(0), most)])))
    assert int(rows.collect()[0].total_amount_pyg) == 2 * most
    assert json.loads(bytes(serialize_aggregates(rows).collect()[0].value))["payload"][
        "total_amount_pyg"] == 2 * most
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        to_table_types(rows).collect()


def test_windows_combine_before_the_shuffle(spark):
    plan = aggregate_windows(payments(spark, [("a", _minute(0), 1)]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in text and "partial_sum" in text


def test_serialized_aggregate(spark):
    row = serialize_aggregates(label_windows(aggregate_windows(
        payments(spark, [("a", _minute(0), 10_000, "señor")])))).collect()[0]
    text = bytes(row.value).decode()
    assert bytes(row.key).decode() == f"señor|{_minute(0)}"
    assert "señor" in text
    value = json.loads(text)
    assert value == {
        "schema_version": 1, "key": f"señor|{_minute(0)}", "window_start": _minute(0),
        "window_end": _minute(1),
        "payload": {"merchant_id": "señor", "transaction_count": 1, "total_amount_pyg": 10_000},
    }
    assert list(value) == sorted(value) and list(value["payload"]) == sorted(value["payload"])


def test_demo_stream(spark):
    log = records(spark, demo_events())
    checked = check_events(log)
    payments_ = deduplicate(confirmed(valid_events(checked)))
    assert windows(payments_) == {
        ("merchant-002", "2026-01-01T11:56:00.000Z", "2026-01-01T11:57:00.000Z"): (1, 240_682),
        OTHER: (2, 484_422),
        ("merchant-003",) + FIRST[1:]: (3, 802_668),
    }
    counts = stage_counts(checked).collect()[0]
    assert tuple(counts) == (10, 1, 9, 7, 6)
    sums = totals(label_windows(aggregate_windows(payments_))).collect()[0]
    assert tuple(int(v) for v in sums) == (3, 6, 1_527_772)


def test_batch_path_needs_no_python(spark):
    checked = check_events(records(spark, demo_events()))
    plan = aggregate_windows(deduplicate(confirmed(valid_events(checked))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text


def test_deduplicate_keeps_first_arrival(spark):
    frame = payments(spark, [("a", _minute(0), 1), ("a", _minute(0), 2), ("b", _minute(0), 3)])
    rows = deduplicate(frame).collect()
    assert sorted((r.event_id, r.amount) for r in rows) == [("a", 1), ("b", 3)]


def test_other_status_does_not_block_an_id(spark):
    log = records(spark, [event(status="DECLINED"), event(status="CONFIRMED", amount=5)])
    rows = deduplicate(confirmed(valid_events(check_events(log)))).collect()
    assert [r.amount for r in rows] == [5]


def test_copies_are_thinned_out_before_the_shuffle(spark):
    frame = spark.range(100_000).selectExpr(
        "if(id % 3 = 0, 'often', cast(id AS string)) AS event_id", "0 AS partition",
        "id AS offset")
    plan = first_per(frame, ["event_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    before, after = text.split("Exchange hashpartitioning", 1)
    assert "Final" in before and "WindowGroupLimit" in after and "Partial" in after
    assert plan.count() == 100_000 - 33_334 + 1


def _greedy(rows, horizon_us):
    kept, last = set(), {}
    for key, t, offset in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if key not in last or t >= last[key] + horizon_us:
            last[key] = t
            kept.add((key, t, offset))
    return kept


def _within(spark, rows, horizon):
    frame = spark.createDataFrame(rows, "event_id STRING, us BIGINT, offset BIGINT").selectExpr(
        "event_id", "timestamp_micros(us) AS event_ts", "0 AS partition", "offset")
    kept = deduplicate_within(frame, horizon).selectExpr(
        "event_id", "unix_micros(event_ts) AS us", "offset").collect()
    out = [tuple(r) for r in kept]
    assert len(out) == len(set(out))
    return set(out)


def test_horizon_is_counted_from_the_kept_event(spark):
    second = 1_000_000
    rows = [("a", t * second, n) for n, t in enumerate([0, 10, 10, 179, 180, 181, 360, 600])]
    assert {r[1] // second for r in _within(spark, rows, 180)} == {0, 180, 360, 600}


def test_horizon_against_brute_force(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice(["often", "often", "a", "b", "c"]),
         rng.choice([rng.randrange(3_000_000_000), rng.randrange(3000) * 1_000_000,
                     -rng.randrange(400_000_000)]), n)
        for n in range(4000)
    ]
    assert _within(spark, rows, 7) == _greedy(rows, 7_000_000)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 12_000_000)), min_size=1))
def test_any_times(spark, rows):
    numbered = [(key, t, n) for n, (key, t) in enumerate(rows)]
    assert _within(spark, numbered, 2) == _greedy(numbered, 2_000_000)


def test_latest_per_key(spark):
    frame = spark.createDataFrame(
        [("k1", 1, 10), ("k1", 3, 30), ("k1", 2, 20), ("k2", 0, 5)],
        "aggregate_key STRING, offset BIGINT, v INT")
    assert {(r.aggregate_key, r.v) for r in latest_per_key(frame).collect()} == {
        ("k1", 30), ("k2", 5)}


def test_reconcile(spark):
    schema = "k STRING, a INT, b INT"
    left = spark.createDataFrame([("x", 1, None), ("y", 1, 1), ("z", 1, 1)], schema)
    right = spark.createDataFrame([("x", 1, None), ("y", 1, 2), ("w", 1, 1)], schema)
    rows = reconcile(left, right, "k", ["a", "b"]).collect()
    assert {r.k: r.outcome for r in rows} == {
        "x": "match", "y": "differs", "z": "only_left", "w": "only_right"}


def test_offsets_and_lag(spark):
    log = spark.createDataFrame(
        [("t", 0, 0), ("t", 0, 5), ("t", 1, 3)], "topic STRING, partition INT, offset BIGINT")
    ends = end_offsets(log)
    assert {tuple(r) for r in ends.collect()} == {("t", 0, 2, 6), ("t", 1, 1, 4)}
    done = spark.createDataFrame(
        [("t", 0, 6)], "topic STRING, partition INT, committed_offset BIGINT")
    assert {(r.partition, r.lag) for r in consumer_lag(ends, done).collect()} == {(0, 0), (1, 4)}


def test_money_stays_integer(spark):
    rows = to_table_types(label_windows(aggregate_windows(payments(spark, [("a", _minute(0), 1)]))))
    types = column_types(rows)
    assert types["transaction_count"] == types["total_amount_pyg"] == "bigint"
    assert set(types.values()) == {"string", "bigint"}


def test_other_durations(spark):
    config = StreamConfig(window_seconds=10, lateness_seconds=5)
    assert (config.window, config.horizon_seconds) == ("10 seconds", 15)
    frame = payments(spark, [("a", _minute(0), 1), ("b", "2026-01-01T12:00:10Z", 1)])
    assert aggregate_windows(frame, config).count() == 2
    assert aggregate_windows(frame).select(F.sum("transaction_count")).collect()[0][0] == 2
