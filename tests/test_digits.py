"""Integers of any size: parse, sums, JSON, streams; and bounded runs."""

from __future__ import annotations

import json
import random

import pytest

from paystream.operators.aggregate_contract import check_aggregates
from paystream.operators.contract import check_events
from paystream.operators.dedup import deduplicate
from paystream.operators.route import confirmed, dead_letters, invalid_events, valid_events
from paystream.operators.windows import aggregate_windows, label_windows, serialize_aggregates
from paystream.session import work_dir
from paystream.sources import records as source
from paystream.sources.records import end_of_run, log_writer, until
from paystream.sources.table import materialize
from paystream.streaming.exact import pane_stream
from paystream.streaming.fast import aggregate_stream
from paystream.streaming.replay import Replay
from tests.helpers import event, records

AMOUNTS = [
    1, 2**63 - 1, 2**63, 10**18, 10**18 - 1, 10**36, 10**36 - 1, 10**37 + 10**18, 10**59 + 7, 7 * 10**200, 10**800 - 1,
]


def _events(amounts, at="2026-01-01T12:00:10Z"):
    return [event(f"e{k}", at=at, amount=a) for k, a in enumerate(amounts)]


def _json_rows(windows):
    return {json.loads(bytes(r.value))["payload"]["merchant_id"]: json.loads(bytes(r.value))["payload"]
            for r in serialize_aggregates(label_windows(windows)).collect()}


def test_sums_of_any_size(spark):
    random.seed(5)
    for amounts in (AMOUNTS, [a for a in AMOUNTS for _ in range(50)],
                    [random.randrange(1, 10 ** random.randint(1, 300)) for _ in range(200)]):
        checked = check_events(records(spark, _events(amounts)))
        assert checked.where("size(errors) > 0").isEmpty()
        made = _json_rows(aggregate_windows(deduplicate(confirmed(valid_events(checked)))))["merchant-001"]
        assert (made["transaction_count"], made["total_amount_pyg"]) == (len(amounts), sum(amounts))


def test_contract_of_wide_numbers(spark):
    values = {
        f'{10**40}': [], f'-{10**40}': ["range:payload.amount"], f'{10**40}.0': ["type:payload.amount"],
        f'"{10**40}"': ["type:payload.amount"], f'0{10**40}': ["syntax:value"], '1e40': ["type:payload.amount"],
        f'{10**1000}': ["syntax:value"],
    }
    texts = [json.dumps(event(amount=0)).replace('"amount": 0', f'"amount": {v}') for v in values]
    texts.append(json.dumps({**event(), "schema_version": 2**64}))
    checked = check_events(records(spark, texts))
    wanted = [*values.values(), ["unsupported:schema_version"]]
    assert [r.errors for r in checked.orderBy("offset").collect()] == wanted
    letters = {r.source_offset: json.loads(bytes(r.value)) for r in dead_letters(invalid_events(checked)).collect()}
    assert letters[1]["raw_data"] == event(amount=-10**40)


def test_wide_totals_pass_the_contract_but_not_the_table(spark):
    rows = label_windows(aggregate_windows(confirmed(valid_events(check_events(records(spark, _events([10**50])))))))
    log = serialize_aggregates(rows).selectExpr("*", "'t' AS topic", "0 AS partition", "0L AS offset")
    row = check_aggregates(log).first()
    assert (row.error, row.total_amount_pyg, row.total_amount_wide) == (None, None, str(10**50))
    with pytest.raises(Exception, match="beyond 64 bits"):
        materialize(log, work_dir(spark, "test-wide"), "t", 0)


def _stream(spark, build, steps):
    replay = Replay(spark, "test-wide-stream", partitions=2)
    replay.run((records(spark, s) for s in steps), lambda stream, out, checkpoint: log_writer(build(stream), out, checkpoint))
    return spark.read.parquet(replay.output).filter("merchant_id <> 'tick'").collect()


def _tick(clock):
    return [event(f"tick-{clock}", "tick", at=f"2026-01-01T{clock}Z")]


def test_wide_amounts_in_streams(spark):
    few = [2**63 - 1, 2**63, 10**59 + 7, 10**107]
    rows = _stream(spark, aggregate_stream, [_events(few), _tick("12:10:00")])
    assert [(r.transaction_count, int(r.total_amount_pyg)) for r in rows] == [(4, sum(few))]
    with pytest.raises(Exception, match="108 digits"):
        _stream(spark, aggregate_stream, [_events([10**108]), _tick("12:10:00")])


def test_panes_do_not_depend_on_arrow_batches(spark):
    """Late payments of one micro-batch count by offset, with amounts of any size; a restart changes nothing."""
    late = [event(f"late{k}", at="2026-01-01T12:00:20Z", amount=10 ** (20 * k)) for k in range(1, 8)]
    steps = [_events([5, 10**70]), _tick("12:01:01"), late]
    total, want = 5 + 10**70, [("ON_TIME", 0, 2, 5 + 10**70)]
    for k in range(1, 8):
        total += 10 ** (20 * k)
        want.append(("LATE", k, 2 + k, total))
    for batch, restarts in (("1", False), ("10000", True)):
        replay = Replay(spark, "test-arrow", partitions=2, restarts=restarts)
        replay.session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        replay.run(
            (records(spark, s).withColumnRenamed("offset", "n").selectExpr(
                "key", "value", "topic", "partition", f"n + {100 * i} AS offset", "timestamp") for i, s in enumerate(steps)),
            lambda stream, out, checkpoint: log_writer(pane_stream(stream), out, checkpoint),
        )
        rows = spark.read.parquet(replay.output).filter("merchant_id <> 'tick'").orderBy("pane_index").collect()
        assert [(r.timing, r.pane_index, r.transaction_count, int(r.total_amount_pyg)) for r in rows] == want


def test_end_of_a_bounded_run(spark, monkeypatch):
    """Counts of ranges, refined, instead of a sort; offsets with large gaps."""
    monkeypatch.setattr(source, "RANGES", 4)
    random.seed(6)
    rows = sorted((p, o) for p in range(3) for o in random.sample(range(10**12), 200))
    log = spark.createDataFrame([("t", *r) for r in rows], "topic string, partition int, offset bigint")
    for n in (0, 1, 199, 200, 201, 437, 600, 700, None):
        ends = end_of_run(log, n)
        found = sorted((r.partition, r.offset) for r in until(log, ends).collect())
        assert found == rows[:n]
    plan = until(log, ends)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Sort" not in plan and "TakeOrdered" not in plan
