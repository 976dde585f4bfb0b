"""Generator, record writers, settings and the three jobs on file logs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from paystream.config import AGGREGATES_TOPIC, BOOTSTRAP_SERVERS, DEFAULT, bootstrap_servers
from paystream.jobs import generate, materialize, run_stream
from paystream.operators.contract import check_events
from paystream.operators.datagen import (
    AMOUNT_MAX,
    AMOUNT_MIN,
    EVENT_FIELDS,
    generate_stream,
    sow_faults,
)
from paystream.plans import payments, queries
from paystream.session import stream_session, work_dir
from paystream.sources.records import (
    bounded,
    kafka_source_options,
    keyed_records,
    read_log,
    write_log,
)
from paystream.sources.routed import read_letters
from paystream.sources.table import current_rows
from tests.helpers import aggregate, demo_events, event, records


def _events(frame):
    return [r.asDict(recursive=True) for r in frame.orderBy("id").collect()]


def test_same_seed_same_events(spark):
    assert _events(generate_stream(spark, 10, 42)) == _events(generate_stream(spark, 10, 42))


def test_other_seed_other_events(spark):
    a, b = (_events(generate_stream(spark, 10, seed)) for seed in (1, 2))
    assert all(x["event_id"] != y["event_id"] for x, y in zip(a, b, strict=True))


def test_generated_events_do_not_depend_on_partitions(spark):
    whole = generate_stream(spark, 100, 3)
    assert _events(whole) == _events(generate_stream(spark, 100, 3).repartition(7))


def test_generated_events_are_valid(spark):
    frame = generate_stream(spark, 300, 7)
    log = keyed_records(frame.select(*EVENT_FIELDS)).selectExpr(
        "*", "'t' AS topic", "0 AS partition", "0L AS offset")
    checked = check_events(log)
    assert checked.filter(F.size("errors") > 0).count() == 0
    assert checked.filter(F.col("event_key") != F.col("key").cast("string")).count() == 0
    ranges = checked.agg(
        F.min("amount"), F.max("amount"), F.countDistinct("merchant_id"),
        F.countDistinct("account_id"), F.countDistinct("status"), F.countDistinct("event_id"),
    ).collect()[0]
    assert AMOUNT_MIN <= ranges[0] and ranges[1] <= AMOUNT_MAX
    assert tuple(ranges)[2:] == (3, 10, 3, 300)


def test_generated_times(spark):
    times = [e["event_time"] for e in _events(generate_stream(spark, 3, 0))]
    assert times == [f"2026-01-01T12:00:0{s}.000Z" for s in (0, 2, 4)]
    custom = _events(generate_stream(spark, 1, 0, "2030-05-01 00:00:00"))
    assert custom[0]["event_time"] == "2030-05-01T00:00:00.000Z"


def test_sown_faults(spark):
    rows = sow_faults(generate_stream(spark, 10, 5)).orderBy("arrival").collect()
    tags = [r.scenario_tag for r in rows]
    assert sorted(set(tags)) == ["duplicate", "invalid", "late", "normal", "out_of_order"]
    assert len(rows) == 11
    by_tag = {r.scenario_tag: n for n, r in enumerate(rows)}
    twin = next(r for r in rows if r.id == 2 and r.scenario_tag == "normal")
    copy = rows[by_tag["duplicate"]]
    assert (copy.event_id, copy.payload) == (twin.event_id, twin.payload)
    assert copy.arrival > twin.arrival
    moved = by_tag["out_of_order"]
    assert rows[moved].event_time < rows[moved - 1].event_time
    late = rows[by_tag["late"]]
    assert late.event_time <= "2026-01-01T11:57:00.000Z"
    assert rows[by_tag["invalid"]].event_id is None


def test_control_columns_never_enter_a_record(spark):
    events = sow_faults(generate_stream(spark, 10, 5))
    values = [json.loads(bytes(r.value)) for r in keyed_records(events.select(*EVENT_FIELDS))
              .collect()]
    assert all(set(v) <= set(EVENT_FIELDS) for v in values)
    assert sum("event_id" not in v for v in values) == 1


def test_record_key_must_be_text(spark):
    with pytest.raises(TypeError, match="string"):
        keyed_records(spark.createDataFrame([(1,)], "key INT"))


def test_bounded(spark):
    log = records(spark, demo_events())
    assert [r.offset for r in bounded(log, 3).collect()] == [0, 1, 2]
    assert bounded(log, None).count() == 10


def test_source_options():
    options = kafka_source_options("host:1", "topic", "group", 500)
    assert options == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "topic", "startingOffsets": "earliest",
        "groupIdPrefix": "group", "maxOffsetsPerTrigger": "500",
    }


def test_address_precedence():
    env = {"KAFKA_BOOTSTRAP_SERVERS": "env:9092"}
    assert bootstrap_servers("flag:9092", env) == "flag:9092"
    assert bootstrap_servers(None, env) == "env:9092"
    assert bootstrap_servers(None, {}) == BOOTSTRAP_SERVERS


def test_settings():
    assert (DEFAULT.window_seconds, DEFAULT.lateness_seconds, DEFAULT.horizon_seconds) == (
        60, 120, 180)


def test_arguments():
    args = run_stream.parse_args([])
    assert (args.max_num_records, args.input_topic) == (None, DEFAULT.events_topic)
    assert run_stream.parse_args(["--max-num-records", "10"]).max_num_records == 10
    assert materialize.parse_args(["--max-messages", "3"]).max_messages == 3
    assert generate.parse_args(["--scenario", "demo", "--dry-run"]).dry_run


def test_chain_of_jobs_on_the_demo_records(spark):
    """Ten records to one dead letter and three rows, 6 payments and 1527772 in all."""
    path = work_dir(spark, "test-jobs")
    write_log(records(spark, demo_events()), f"{path}/{DEFAULT.events_topic}")
    assert run_stream.main(["--path", path, "--max-num-records", "10"]) == 0
    table = f"{path}/table"
    assert materialize.main(["--path", path, "--table-path", table, "--max-messages", "3"]) == 0
    rows = current_rows(spark, table).orderBy("aggregate_key").collect()
    assert [(r.aggregate_key, r.transaction_count, r.total_amount_pyg) for r in rows] == [
        ("merchant-002|2026-01-01T11:56:00.000Z", 1, 240_682),
        ("merchant-002|2026-01-01T12:00:00.000Z", 2, 484_422),
        ("merchant-003|2026-01-01T12:00:00.000Z", 3, 802_668),
    ]
    letters = read_log(spark, f"{path}/{DEFAULT.dead_letter_topic}").collect()
    assert [bytes(r.key) for r in letters] == [b""]


@pytest.mark.parametrize("mode", [[], ["--exact"]])
def test_streaming_job(spark, mode):
    """Events in three steps, among them a late one; the table ends up with the full count."""
    path = work_dir(spark, "test-stream-job")
    args = run_stream.parse_args(["--path", path, "--checkpoint", f"{path}/checkpoint", *mode])
    session = stream_session(spark, 1)
    steps = [
        [event("a", at="2026-01-01T12:00:10Z"), "broken"],
        [event("tick", "tick", at="2026-01-01T12:01:01Z")],
        [event("b", at="2026-01-01T12:00:20Z"), event("c", at="2026-01-01T12:00:30Z")],
        [event("tick2", "tick", at="2026-01-01T12:10:01Z")],
    ]
    write_log(records(spark, steps[0]), f"{path}/{DEFAULT.events_topic}")
    queries = run_stream.start_streams(run_stream.Logs(session, args), args)
    for n, step in enumerate(steps):
        if n:
            log = records(spark, step).withColumn("offset", F.col("offset") + 10 * n)
            write_log(log, f"{path}/{DEFAULT.events_topic}")
        for query in queries:
            query.processAllAvailable()
    for query in queries:
        query.stop()
    letters = read_log(spark, f"{path}/{DEFAULT.dead_letter_topic}").collect()
    assert [json.loads(bytes(r.value))["errors"] for r in letters] == [["syntax:value"]]
    versions = read_log(spark, f"{path}/{AGGREGATES_TOPIC}").filter("key LIKE 'merchant-001%'")
    assert versions.count() == (3 if mode else 1)
    table = f"{path}/table"
    assert materialize.main(["--path", path, "--table-path", table, "--max-messages", "99"]) == 0
    rows = current_rows(spark, table).filter("merchant_id <> 'tick'").collect()
    assert [(r.transaction_count, r.total_amount_pyg) for r in rows] == [(3, 30_000)]


def _events_folder(spark, n=240):
    """A small ``events`` table of the test's own."""
    folder = work_dir(spark, "tables")
    spark.range(n).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 97).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("purchase").alias("event_type"),
        (F.col("id") % 11 + 1).cast("double").alias("value"), F.lit("").alias("props"),
    ).write.parquet(f"{folder}/events.parquet")
    return folder


def test_sinks_start_after_the_routing_was_stopped(spark, monkeypatch):
    """in its first phase the job runs nothing but the query that parses, so no sink is broken off."""
    parsed = []

    def start(logs, args, start=run_stream.start_streams):
        parsed.append(read_letters(logs.spark, f"{args.checkpoint}/routed").count())
        parsed.append(len(logs.spark.streams.active))
        return start(logs, args)

    monkeypatch.setattr(run_stream, "start_streams", start)
    rows = queries.job_outputs(spark, _events_folder(spark)).groupBy("topic").count().collect()
    assert len(parsed) == 2 and parsed[0] > 0 and parsed[1] == 0
    assert dict(rows)["payments.events.dlq.v1"] == parsed[0]


@pytest.mark.parametrize("name", ["upsert_stream", "upsert_resume", "upsert_table", "reconcile"])
def test_the_aggregates_are_worked_out_once(spark, monkeypatch, name):
    """however many batches are taken from the log, its payments are parsed and counted once."""
    counted = spark.sparkContext.accumulator(0)

    def watched(spark_, folder, load=payments.load):
        def count(batches):
            for batch in batches:
                counted.add(batch.num_rows)
                yield batch

        rows = load(spark_, folder, "events")
        return rows.mapInArrow(count, rows.schema)

    monkeypatch.setattr(payments, "load", lambda s, folder, table: watched(s, folder))
    assert queries.QUERIES[name](spark, _events_folder(spark)).count() > 0
    assert counted.value == 240


def test_amounts_are_parsed_once(spark, monkeypatch):
    """the errors and the letters of a record come from one parse; repeated offsets meet each other."""
    counted = spark.sparkContext.accumulator(0)

    def twice(spark_, folder, log=payments.big_log):
        def count(batches):
            for batch in batches:
                counted.add(batch.num_rows)
                yield batch

        rows = log(spark_, folder)
        rows = rows.union(rows.where("offset % 8 = 4"))
        return rows.mapInArrow(count, rows.schema)

    monkeypatch.setattr(queries, "big_log", twice)
    rows = queries.big_amount_errors(spark, _events_folder(spark)).collect()
    assert counted.value == 270
    assert len(rows) == 240 + 3 * 30
    for row in rows:
        assert (row.letter_amount is None) == (row.errors == "")
        assert row["offset"] % 8 != 4 or row.letter_amount.startswith("-1")


def test_bounded_runs_go_on_where_the_last_one_ended(spark, capsys):
    path = work_dir(spark, "test-resume")
    values = [aggregate(f"merchant-00{n}") for n in range(1, 8)]
    log = records(spark, values, [v["key"].encode() for v in values])
    write_log(log, f"{path}/{AGGREGATES_TOPIC}")
    args = ["--path", path, "--table-path", f"{path}/table", "--max-messages"]

    def stored():
        return sorted(r.merchant_id[-1] for r in current_rows(spark, f"{path}/table").collect())

    assert materialize.main([*args, "5"]) == 0 and stored() == list("12345")
    assert materialize.main([*args, "1"]) == 0 and stored() == list("123456")
    write_log(records(spark, ["{broken"]).withColumn("offset", F.lit(7).cast("long")), f"{path}/{AGGREGATES_TOPIC}")
    assert materialize.main([*args, "9"]) == 1 and stored() == list("123456")
    assert materialize.main([*args, "1"]) == 0 and stored() == list("1234567")
    assert "syntax:value" in capsys.readouterr().err


def test_generated_logs_have_sound_positions(spark):
    path = work_dir(spark, "test-positions")
    for _ in range(2):
        assert generate.main(["--scenario", "demo", "--count", "100", "--path", path]) == 0
    log = read_log(spark, f"{path}/{DEFAULT.events_topic}")
    assert log.count() == 220
    assert log.select("partition", "offset").distinct().count() == 220
    assert log.groupBy("key").agg(F.count_distinct("partition").alias("n")).where("n > 1").count() == 0


def test_bad_aggregate_ends_the_job_with_an_error(spark, capsys):
    path = work_dir(spark, "test-poison")
    write_log(records(spark, ["{not valid json"]), f"{path}/{AGGREGATES_TOPIC}")
    args = ["--path", path, "--table-path", f"{path}/table", "--max-messages", "1"]
    assert materialize.main(args) == 1
    assert "syntax:value" in capsys.readouterr().err
    assert current_rows(spark, f"{path}/table").count() == 0


def test_generate_job(spark, capsys):
    assert generate.main(["--scenario", "demo", "--count", "10", "--seed", "1", "--dry-run"]) == 0
    assert capsys.readouterr().out.count("schema_version") == 11
    path = work_dir(spark, "test-generate")
    assert generate.main(["--count", "5", "--path", path, "--start-now"]) == 0
    log = read_log(spark, f"{path}/{DEFAULT.events_topic}")
    assert log.count() == 5
    assert check_events(log).filter("event_time < '2026-01-02'").count() == 0


def test_streaming_job_needs_a_checkpoint(spark):
    with pytest.raises(SystemExit, match="checkpoint"):
        run_stream.main([])
    with pytest.raises(SystemExit, match="checkpoint"):
        materialize.main([])
