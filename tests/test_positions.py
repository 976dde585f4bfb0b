"""Progress from checkpoints, stored order, numbering of logs, audit of columns."""

from __future__ import annotations

import pytest

from paystream.operators.integrity import log_integrity, strayed_keys
from paystream.operators.latest import column_audit
from paystream.session import work_dir
from paystream.sources.ordered import read_ordered, write_ordered
from paystream.sources.progress import committed_offsets, last_commit
from paystream.sources.records import log_writer, read_log, write_log
from tests.helpers import records


def checkpoint_of(tmp_path, commits, offsets):
    for name in ("commits", "offsets"):
        (tmp_path / name).mkdir()
    for n in commits:
        (tmp_path / "commits" / str(n)).write_text('v1\n{"nextBatchWatermarkMs":0}')
    for n, lines in offsets.items():
        (tmp_path / "offsets" / str(n)).write_text("\n".join(["v1", '{"batchWatermarkMs":0}', *lines]))
    return str(tmp_path)


def test_offsets_of_topics(spark, tmp_path):
    """Only finished batches count, by number and not by name; each source has a line of its own."""
    path = checkpoint_of(tmp_path, [8, 9, 10], {
        9: ['{"a":{"0":5}}', '{"b":{"0":1}}'], 10: ['{"a":{"0":7,"2":3}}', '{"b":{"0":9000000000}}'], 11: ['{"a":{"0":99}}', "-"],
    })
    assert last_commit(spark, path) == 10
    assert sorted(map(tuple, committed_offsets(spark, path).collect())) == [("a", 0, 7), ("a", 2, 3)]
    assert list(map(tuple, committed_offsets(spark, path, source=1).collect())) == [("b", 0, 9000000000)]


def test_nothing_committed(spark, tmp_path):
    assert committed_offsets(spark, str(tmp_path / "none")).count() == 0
    path = checkpoint_of(tmp_path, [], {0: ['{"a":{"0":5}}']})
    assert last_commit(spark, path) is None and committed_offsets(spark, path).collect() == []


def test_offsets_of_a_file_log(spark):
    """What comes after the last batch is left out, over more batches than one file of the checkpoint holds."""
    base = work_dir(spark, "progress")
    log = records(spark, [{}] * 30).selectExpr(
        "key", "value", "topic", "cast(offset % 2 as int) AS partition", "offset", "cast(timestamp as timestamp) AS timestamp"
    ).coalesce(1)
    reached = 0
    for step in range(13):
        write_log(log.where(f"offset div 2 = {step}"), f"{base}/log")
        if step % 12 < 11:
            stream = read_log(spark, f"{base}/log", stream=True)
            query = log_writer(stream, f"{base}/out", f"{base}/checkpoint").trigger(availableNow=True).start()
            query.awaitTermination()
            reached = step
        done = committed_offsets(spark, f"{base}/checkpoint", f"{base}/log").collect()
        assert {(r.partition, r.committed_offset) for r in done} == {(0, 2 * reached + 1), (1, 2 * reached + 2)}


def test_stored_order(spark):
    """Positions follow the order, nulls first; a page reads only its files; nothing is sorted or shuffled."""
    path = work_dir(spark, "ordered")
    rows = spark.range(5000).selectExpr("if(id = 77, null, id * 7919 % 5000) AS a", "id % 3 AS b", "cast(id as string) AS c")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_ordered(rows, path, ["a", "b"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = read_ordered(spark, path)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and "Exchange hash" not in plan and "Exchange range" not in plan and "Exchange Single" not in plan
    found = sorted(whole.collect(), key=lambda r: r.position)
    wanted = sorted(rows.collect(), key=lambda r: (r.a is not None, r.a or 0, r.b))
    assert [r.position for r in found] == list(range(5000))
    assert [(r.a, r.b, r.c) for r in found] == [tuple(r) for r in wanted]
    page = read_ordered(spark, path, 1990, 2010)
    assert sorted(r.position for r in page.collect()) == list(range(1990, 2010))
    assert page.select("position").where("position >= 0").distinct().count() == 20
    assert spark.read.parquet(f"{path}/parts").count() > 4
    assert read_ordered(spark, path, 4990).count() == 10 and read_ordered(spark, path, 5000).count() == 0


def test_stored_order_of_nothing_and_of_equal_rows(spark):
    path = work_dir(spark, "ordered")
    write_ordered(spark.range(0).selectExpr("id AS a"), path, ["a"])
    assert read_ordered(spark, path).collect() == []
    path = work_dir(spark, "ordered")
    write_ordered(spark.range(3000).selectExpr("1 AS a"), path, ["a"])
    assert sorted(r.position for r in read_ordered(spark, path).collect()) == list(range(3000))


@pytest.mark.parametrize("block", [1, 2, 3, 7, 65_536])
def test_numbering(spark, block):
    """Faults inside blocks, between them, and over blocks without any record."""
    times = {0: 10, 1: 11, 2: 9, 3: 9, 6: 12, 7: None, 8: 5, 21: 4, 40: 50}
    rows = [("t", 0, o, t) for o, t in times.items()] + [("t", 0, 3, 30)] * 5 + [("t", 1, 4, 1), ("u", 1, 5, 1), ("u", 1, 6, 2)]
    log = spark.createDataFrame(rows, "topic string, partition int, offset long, t long").selectExpr(
        "topic", "partition", "offset", "timestamp_seconds(t) AS timestamp", "'x' AS block", "1 AS n"
    )
    found = {(r.topic, r.partition): tuple(r)[2:] for r in log_integrity(log, block).collect()}
    assert found == {
        ("t", 0): (14, 0, 41, 5, 3, 32, 2), ("t", 1): (1, 4, 5, 0, 0, 0, 0), ("u", 1): (2, 5, 7, 0, 0, 0, 0),
    }
    assert log_integrity(log.where("false"), block).count() == 0


def test_keys_that_stray(spark):
    rows = [("t", "a", 0), ("t", "a", 0), ("t", "b", 0), ("t", "b", 2), ("t", "b", 2), ("u", "a", 1), ("t", None, 0), ("t", None, 1)]
    found = strayed_keys(spark.createDataFrame(rows, "topic string, key string, partition int")).collect()
    assert {tuple(r) for r in found} == {("t", "b", 2, 3), ("t", None, 2, 2)}


def test_columns(spark):
    rows = spark.createDataFrame([(1, "b", None), (3, None, None)], "n long, name string, money decimal(9,2)")
    assert [tuple(r) for r in column_audit(rows).collect()] == [
        ("n", "bigint", True, 2, 0, "1", "3"), ("name", "string", False, 2, 1, "b", "b"),
        ("money", "decimal(9,2)", False, 2, 2, None, None),
    ]
    assert [r.rows for r in column_audit(rows.where("false")).collect()] == [0, 0, 0]
