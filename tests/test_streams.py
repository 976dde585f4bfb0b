"""Streams fed step by step: watermark, lateness, panes, horizon, materialization."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from paystream.operators.accounting import observe_stages
from paystream.operators.contract import check_events
from paystream.operators.dedup import deduplicate
from paystream.operators.route import confirmed, valid_events
from paystream.operators.windows import (
    aggregate_windows,
    label_windows,
    serialize_aggregates,
    to_table_types,
)
from paystream.plans import payments as payments_plan
from paystream.plans import queries
from paystream.plans.oracles import ORACLES
from paystream.plans.payments import payment_log
from paystream.session import work_dir
from paystream.sources.records import log_writer, read_log, stamped, write_log
from paystream.sources.table import create_table, current_rows, store_versions
from paystream.streaming.exact import deduplicate_exactly, panes, with_event_clock
from paystream.streaming.fast import (
    aggregate_stream,
    combine_copies,
    dead_letter_stream,
    only_plausible,
    table_writer,
)
from paystream.streaming.replay import Replay, arriving
from tests.compare import difference, expected
from tests.helpers import aggregate, changed, demo_events, event, payments, records, steps


def _at(clock):
    return f"2026-01-01T{clock}Z"


def _panes(spark, arrivals, dedup=False):
    """All panes as merchant -> [(window, pane index, timing, count, total)]."""
    def build(stream, out, checkpoint):
        clocked = with_event_clock(stream)
        clocked = deduplicate_exactly(clocked) if dedup else clocked
        return log_writer(panes(clocked), out, checkpoint)

    replay = Replay(spark, "test-panes", partitions=1)
    replay.run(steps(spark, arrivals), build)
    out = {}
    for r in spark.read.parquet(replay.output).orderBy("window_start", "pane_index").collect():
        out.setdefault(r.merchant_id, []).append(
            (r.window_start.strftime("%H:%M"), r.pane_index, r.timing, r.transaction_count,
             int(r.total_amount_pyg)))
    return out


def _tick(clock):
    return [(f"tick-{clock}", _at(clock), 1, "tick")]


@pytest.fixture(scope="module")
def all_panes(spark):
    """One stream of several merchants, a case each."""
    return _panes(spark, [
        [("a1", _at("12:00:10"), 10_000, "late"), ("b1", _at("12:00:10"), 10_000, "too late"),
         ("c1", _at("12:00:40"), 25_000, "order"), ("c2", _at("12:00:10"), 10_000, "order")],
        _tick("12:01:01"),
        [("a2", _at("12:00:40"), 25_000, "late"), ("d1", _at("12:00:41"), 5, "only late"),
         ("c3", _at("12:00:20"), 1, "order"), ("c4", _at("12:00:21"), 2, "order")],
        [("d2", _at("12:00:42"), 6, "only late")],
        _tick("12:03:00"),
        [("a3", _at("12:00:05"), 99_999, "late"), ("b2", _at("12:00:05"), 99_999, "too late")],
    ])


def test_late_payment_adds_a_pane_and_too_late_one_does_not(all_panes):
    assert all_panes["late"] == [
        ("12:00", 0, "ON_TIME", 1, 10_000), ("12:00", 1, "LATE", 2, 35_000)]
    assert all_panes["too late"] == [("12:00", 0, "ON_TIME", 1, 10_000)]


def test_every_late_payment_has_a_pane_also_several_in_one_batch(all_panes):
    on_time, *late = all_panes["order"]
    assert on_time == ("12:00", 0, "ON_TIME", 2, 35_000)
    assert [row[:4] for row in late] == [("12:00", 1, "LATE", 3), ("12:00", 2, "LATE", 4)]
    assert late[0][4] in (35_001, 35_002) and late[1][4] == 35_003


def test_window_with_late_payments_only(all_panes):
    assert all_panes["only late"] == [("12:00", 0, "LATE", 1, 5), ("12:00", 1, "LATE", 2, 11)]


def test_duplicates_do_not_reach_the_panes(spark):
    assert _panes(spark, [
        [("a", _at("12:00:10"), 10_000), ("a", _at("12:00:10"), 10_000)],
        [("a", _at("12:00:10"), 10_000)],
        _tick("12:01:01"),
    ], dedup=True)["merchant-001"] == [("12:00", 0, "ON_TIME", 1, 10_000)]


def test_query_of_the_panes_gets_all_copies(spark, monkeypatch):
    """The raw log with every copy goes through the whole chain, and each event counts once."""
    fed = []

    class Kept(Replay):
        def run(self, steps, start):
            fed.extend(steps)
            super().run(fed, start)

    monkeypatch.setattr(queries, "Replay", Kept)
    folder = "/root/testdata/sf0.001"
    actual = queries.panes_exact(spark, folder).toPandas()
    assert not difference(actual, expected(ORACLES["panes_exact"], folder))
    place = ["partition", "offset"]
    log = payment_log(spark, folder).select(*place)
    assert log.exceptAll(fed[0].union(fed[2]).union(fed[5]).select(*place)).isEmpty()
    # Payments and copies that were counted come once more while late ones are accepted.
    again = fed[3].select(*place)
    for n, odd in ((0, 0), (2, 1)):
        assert not again.where(F.col("offset") % 2 == odd).intersect(fed[n].select(*place)).isEmpty()


def test_numbered_steps_arrive_in_turn(spark):
    """All steps are written at once; a row may come in several, in none, and a step may be empty."""
    rows = spark.createDataFrame([(0,), (1,), (2,), (None,)], "n BIGINT")
    n = F.col("n")
    replay = Replay(spark, "test-steps", partitions=1)
    replay.run_numbered(
        arriving(rows, {0: n == 0, 1: n > 5, 2: n >= 0, 3: n == 1}), 4,
        lambda stream, out, checkpoint: log_writer(stream, out, checkpoint),
    )
    assert [sum(p["numInputRows"] for p in step) for step in replay.progress] == [1, 0, 3, 1]
    assert sorted(r.n for r in spark.read.parquet(replay.output).collect()) == [0, 0, 1, 1, 2]


@pytest.mark.parametrize("name, read", [("lateness_default", 240), ("window_agg_stream_update", 240)])
def test_steps_are_worked_out_once(spark, monkeypatch, name, read):
    """rows are made, and where the stream takes payments parsed, once for all steps."""
    folder, counted = work_dir(spark, "tables"), spark.sparkContext.accumulator(0)
    spark.range(240).selectExpr(
        "id AS event_id", "cast(timestamp_seconds(1704067200 + id * 97) AS timestamp_ntz) AS ts", "id % 7 AS user_id",
        "'purchase' AS event_type", "cast(id % 11 + 1 AS DOUBLE) AS value", "'' AS props",
    ).write.parquet(f"{folder}/events.parquet")

    def load(spark_, folder, table, load=payments_plan.load):
        def count(batches):
            for batch in batches:
                counted.add(batch.num_rows)
                yield batch

        rows = load(spark_, folder, table)
        return rows.mapInArrow(count, rows.schema)

    monkeypatch.setattr(payments_plan, "load", load)
    actual = queries.QUERIES[name](spark, folder).toPandas()
    assert counted.value == read
    assert not difference(actual, expected(ORACLES[name], folder))


def _passed(spark, arrivals):
    replay = Replay(spark, "test-dedup", partitions=1)
    replay.run(steps(spark, arrivals), lambda stream, out, checkpoint: log_writer(
        deduplicate_exactly(with_event_clock(stream)), out, checkpoint))
    rows = spark.read.parquet(replay.output).filter("merchant_id <> 'tick'")
    rows = rows.withColumn("ts", F.timestamp_micros("event_us"))
    return sorted((r.event_id, r.offset, r.ts) for r in rows.collect())


def test_horizon(spark):
    """a: a duplicate does not prolong it; b: passes once; c: the same event passes again."""
    rows = _passed(spark, [
        [("a", _at("12:00:00"), 1), ("b", _at("12:00:20"), 1), ("a", _at("12:00:00"), 1),
         ("c", "2026-01-01T12:00:00.123456Z", 1)],
        [("a", _at("12:00:10"), 1), ("c", "2026-01-01T12:00:00.123456Z", 1)],
        _tick("12:03:01"),
        [("a", _at("12:03:01"), 1), ("b", _at("12:00:20"), 1),
         ("c", "2026-01-01T12:00:00.123456Z", 1)],
        [("a", _at("12:05:00"), 1)],
    ])
    assert [(e, n) for e, n, _ in rows] == [("a", 0), ("a", 7), ("b", 1), ("c", 3), ("c", 9)]
    assert rows[-1][2].isoformat() == "2026-01-01T12:00:00.123456"


def test_many_copies_are_combined_in_each_task(spark):
    copies = spark.range(0, 50_000, 1, 2).selectExpr(
        "if(id % 3 = 0, 'often', concat('e', id)) AS event_id", "cast(0 AS BIGINT) AS event_us",
        "'m' AS merchant_id", "id AS amount", "0 AS partition", "id AS offset")
    rows = combine_copies(copies)
    assert rows.filter("event_id <> 'often'").count() == 50_000 - 16_667
    often = rows.filter("event_id = 'often'").agg(F.count("*"), F.min("offset")).collect()[0]
    assert often[0] < 20 and often[1] == 0


def _fast(spark, arrivals, mode):
    replay = Replay(spark, "test-fast", partitions=1)

    def start(stream, out, checkpoint):
        rows = to_table_types(aggregate_stream(stream))
        if mode == "append":
            return log_writer(rows, out, checkpoint)

        def store(batch, batch_id):
            store_versions(batch.withColumn("version", F.lit(batch_id).cast("bigint")), out, "t",
                           batch_id)

        return rows.writeStream.outputMode("update").foreachBatch(store).option(
            "checkpointLocation", checkpoint)

    offset, logs = 0, []
    for values in arrivals:
        frame = records(spark, values)
        logs.append(frame.withColumn("offset", F.col("offset") + offset))
        offset += len(values)
    replay.run(logs, start)
    table = (spark.read.parquet(replay.output) if mode == "append"
             else current_rows(spark, replay.output))
    return sorted(
        (r.window_start[11:16], r.transaction_count, r.total_amount_pyg)
        for r in table.filter("merchant_id <> 'tick'").collect()), replay


ARRIVALS = [
    [event("a", at=_at("12:00:40"), amount=25_000), event("b", at=_at("12:00:10")),
     event("a", at=_at("12:00:40"), amount=25_000), event("x", status="DECLINED"), "broken"],
    [event("c", at=_at("12:01:00"), amount=7), event("b", at=_at("12:00:10"))],
    [event("tick", "tick", at=_at("12:10:00"))],
    [event("d", at=_at("12:00:50"), amount=99_999)],
]
RESULT = [("12:00", 2, 35_000), ("12:01", 1, 7)]


def test_final_rows(spark):
    rows, replay = _fast(spark, ARRIVALS, "append")
    assert rows == RESULT
    assert replay.dropped_by_watermark(3) == 1


def test_accumulating_rows(spark):
    rows, _ = _fast(spark, ARRIVALS, "update")
    assert rows == RESULT


def test_late_within_lateness_is_counted(spark):
    rows, _ = _fast(spark, [
        [event("a", at=_at("12:00:10"))],
        [event("tick", "tick", at=_at("12:02:59"))],
        [event("b", at=_at("12:00:05"), amount=1)],
        [event("tick2", "tick", at=_at("12:10:00"))],
    ], "append")
    assert rows == [("12:00", 2, 10_001)]


@pytest.mark.parametrize("clock, counted", [
    ("12:02:59", 2), ("12:03:00", 1), ("12:03:01", 1), ("12:03:30", 1)])
def test_limit_of_lateness(spark, clock, counted):
    """A window that ends at 12:01:00 takes late payments while the clock is before 12:03:00."""
    rows, _ = _fast(spark, [
        [event("a", at=_at("12:00:10"))],
        [event("tick", "tick", at=_at(clock))],
        [event("b", at=_at("12:00:50"), amount=1), event("a", at=_at("12:00:10"))],
        [event("tick2", "tick", at=_at("12:10:00"))],
    ], "append")
    assert rows == [("12:00", counted, 10_000 + counted - 1)]


def test_dead_letters_of_a_stream(spark):
    path = work_dir(spark, "test-dlq")
    write_log(records(spark, demo_events()), f"{path}/in")
    stream = dead_letter_stream(read_log(spark, f"{path}/in", stream=True))
    log_writer(stream, f"{path}/out", f"{path}/cp").trigger(
        availableNow=True).start().awaitTermination()
    letters = spark.read.parquet(f"{path}/out").collect()
    assert [json.loads(bytes(r.value))["errors"] for r in letters] == [["missing:event_id"]]


def test_stages_are_counted_as_records_pass(spark):
    def start(stream, out, checkpoint):
        return log_writer(observe_stages(check_events(stream), "stages"), out, checkpoint)

    replay = Replay(spark, "test-observe", partitions=1)
    replay.run([records(spark, demo_events())], start)
    seen = [b["observedMetrics"]["stages"] for b in replay.progress[0] if b["numInputRows"]]
    counts = seen[0].asDict()
    assert counts == {"records": 10, "dead_letters": 1, "valid": 9, "confirmed": 7}


def test_any_arrival_within_lateness_gives_the_result_of_the_table(spark):
    rng = random.Random(11)
    arrivals, everything = [], []
    for step in range(4):
        batch = []
        for n in range(30):
            second = max(0, step * 40 + rng.randrange(-110, 10))
            name = f"e{step}-{n}"
            batch.append(event(
                name, f"merchant-{rng.randrange(2)}", _at(f"12:{second // 60:02d}:{second % 60:02d}"),
                rng.randrange(1, 1000)))
        batch += rng.sample(everything, min(len(everything), 10))
        everything += batch
        rng.shuffle(batch)
        arrivals.append(batch)
    streamed, _ = _fast(spark, arrivals, "update")
    checked = check_events(records(spark, everything))
    table = aggregate_windows(deduplicate(confirmed(valid_events(checked))))
    assert streamed == sorted(
        (r.window_start[11:16], r.transaction_count, r.total_amount_pyg)
        for r in to_table_types(label_windows(table)).collect())


def _aggregates(spark, *values, first=0):
    frame = records(spark, values, [v["key"].encode() for v in values])
    return frame.withColumn("offset", F.col("offset") + first)


def test_table_from_a_stream_stops_at_a_bad_record_and_resumes(spark):
    path = work_dir(spark, "test-materialize")
    source, table, checkpoint = f"{path}/in", f"{path}/table", f"{path}/cp"
    create_table(spark, table)

    def run():
        stream = read_log(spark, source, stream=True)
        table_writer(stream, table, checkpoint).trigger(
            availableNow=True).start().awaitTermination()

    def rows():
        return sorted((r.merchant_id, r.transaction_count)
                      for r in current_rows(spark, table).collect())

    write_log(_aggregates(spark, aggregate(), aggregate("merchant-002")), source)
    run()
    assert rows() == [("merchant-001", 1), ("merchant-002", 1)]
    bad = changed(aggregate(count=5), "payload.total_amount_pyg", False)
    write_log(_aggregates(spark, aggregate(count=9, total=1), bad, first=2), source)
    for _ in range(2):
        with pytest.raises(Exception, match="aggregate refused"):
            run()
        assert rows() == [("merchant-001", 1), ("merchant-002", 1)]


def test_stream_and_batch_meet_in_the_table(spark):
    """Aggregates written to a file log, stamped, and materialized from there."""
    path = work_dir(spark, "test-chain")
    rows = label_windows(
        payments(spark, [("a", _at("12:00:10"), 5)]).selectExpr(
            "merchant_id", "timestamp '2026-01-01 12:00:00' AS window_start",
            "timestamp '2026-01-01 12:01:00' AS window_end", "1L AS transaction_count",
            "amount AS total_amount_pyg"))
    write_log(stamped(serialize_aggregates(rows), "t"), f"{path}/log")
    create_table(spark, f"{path}/table")
    table_writer(read_log(spark, f"{path}/log", stream=True), f"{path}/table", f"{path}/cp"
                 ).trigger(availableNow=True).start().awaitTermination()
    assert current_rows(spark, f"{path}/table").count() == 1


def test_far_future_events_can_be_kept_out(spark):
    frame = payments(spark, [("a", _at("12:00:00"), 1), ("b", "2126-01-01T12:00:00Z", 1)])
    logged = frame.withColumn("timestamp", F.lit("2026-01-01 12:00:00").cast("timestamp"))
    assert [r.event_id for r in only_plausible(logged, "timestamp", "1 hour").collect()] == ["a"]

