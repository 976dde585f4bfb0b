"""Aggregate contract and the stored table."""

from __future__ import annotations

import json

import pytest

from paystream.operators.aggregate_contract import check_aggregates
from paystream.session import work_dir
from paystream.sources.table import (
    compact,
    create_table,
    current_rows,
    materialize,
    stored_versions,
)
from tests.helpers import aggregate, changed, raw, records

BASE = aggregate()
KEY = BASE["key"].encode()

CASES = {
    "valid": (KEY, BASE, None),
    "zero": (KEY, aggregate(count=0, total=0), None),
    "version true": (KEY, changed(BASE, "schema_version", True), None),
    "version 1.0": (KEY, changed(BASE, "schema_version", 1.0), None),
    "version 1e0": (KEY, json.dumps(BASE).replace('version": 1', 'version": 1e0'), None),
    "version text": (KEY, changed(BASE, "schema_version", "1"), "unsupported:schema_version"),
    "version 2": (KEY, changed(BASE, "schema_version", 2), "unsupported:schema_version"),
    "version false": (KEY, changed(BASE, "schema_version", False), "unsupported:schema_version"),
    "no version": (KEY, changed(BASE, "schema_version", drop=True), "missing:schema_version"),
    "not utf-8": (KEY, b"\xff\xfe\xfd", "encoding:value"),
    "not json": (KEY, "{not valid json", "syntax:value"),
    "list": (KEY, "[]", "type:value"),
    "no key": (KEY, changed(BASE, "key", drop=True), "invalid:key"),
    "empty start": (KEY, changed(BASE, "window_start", ""), "invalid:window_start"),
    "number end": (KEY, changed(BASE, "window_end", 5), "invalid:window_end"),
    "no payload": (KEY, changed(BASE, "payload", drop=True), "invalid:payload"),
    "payload list": (KEY, changed(BASE, "payload", [1]), "invalid:payload"),
    "no merchant": (
        KEY, changed(BASE, "payload.merchant_id", ""), "invalid:payload.merchant_id"),
    "count true": (
        KEY, changed(BASE, "payload.transaction_count", True),
        "invalid:payload.transaction_count"),
    "count negative": (
        KEY, changed(BASE, "payload.transaction_count", -1), "invalid:payload.transaction_count"),
    "total false": (
        KEY, changed(BASE, "payload.total_amount_pyg", False),
        "invalid:payload.total_amount_pyg"),
    "total 1.0": (
        KEY, changed(BASE, "payload.total_amount_pyg", 1.0), "invalid:payload.total_amount_pyg"),
    "key of another": (
        KEY, changed(BASE, "key", "merchant-999|2026-01-01T12:00:00.000Z"), "mismatch:key"),
    "record key differs": (b"merchant-999|x", BASE, "mismatch:record_key"),
    "record key null": (None, BASE, "missing:record_key"),
    "record key not utf-8": (b"\xff", BASE, "mismatch:record_key"),
    "first error counts": (
        None, changed(changed(BASE, "key", ""), "schema_version", 2),
        "unsupported:schema_version"),
}


@pytest.fixture(scope="module")
def checked(spark):
    frame = check_aggregates(
        records(spark, [v for _, v, _ in CASES.values()], [k for k, _, _ in CASES.values()]))
    return dict(zip(CASES, frame.orderBy("offset").collect(), strict=True))


@pytest.mark.parametrize("name", CASES)
def test_first_error(checked, name):
    assert checked[name].error == CASES[name][2]


def test_typed_columns(checked):
    row = checked["valid"]
    assert (row.aggregate_key, row.merchant_id, row.transaction_count, row.total_amount_pyg) == (
        BASE["key"], "merchant-001", 1, 10_000)


def _log(spark, *aggregates, first=0):
    frame = records(
        spark, [raw(a) for a in aggregates], [a["key"].encode() for a in aggregates])
    return frame.selectExpr(
        "key", "value", "topic", "partition", f"offset + {first} AS offset", "timestamp")


def _rows(spark, path):
    return sorted(
        (r.merchant_id, r.window_start[11:16], r.transaction_count, r.total_amount_pyg)
        for r in current_rows(spark, path).collect())


@pytest.fixture
def table(spark):
    path = work_dir(spark, "test-table")
    create_table(spark, path)
    return path


def test_new_table_is_empty_and_creating_again_keeps_rows(spark, table):
    assert _rows(spark, table) == []
    materialize(_log(spark, BASE), table, "r", 0)
    create_table(spark, table)
    assert _rows(spark, table) == [("merchant-001", "12:00", 1, 10_000)]


def test_upsert(spark, table):
    later = aggregate(count=2, total=35_000)
    other = aggregate("merchant-002", count=1, total=5_000)
    materialize(_log(spark, BASE, later, other), table, "r", 0)
    wanted = [("merchant-001", "12:00", 2, 35_000), ("merchant-002", "12:00", 1, 5_000)]
    assert _rows(spark, table) == wanted


def test_later_batch_replaces(spark, table):
    materialize(_log(spark, BASE), table, "r", 0)
    materialize(_log(spark, aggregate(count=2, total=35_000), first=1), table, "r", 1)
    assert _rows(spark, table) == [("merchant-001", "12:00", 2, 35_000)]


def test_older_version_does_not_replace(spark, table):
    materialize(_log(spark, aggregate(count=2, total=35_000), first=9), table, "r", 0)
    materialize(_log(spark, BASE, first=3), table, "r", 1)
    assert _rows(spark, table) == [("merchant-001", "12:00", 2, 35_000)]


def test_replayed_batch_changes_nothing(spark, table):
    for _ in range(2):
        materialize(_log(spark, BASE), table, "r", 0)
    assert _rows(spark, table) == [("merchant-001", "12:00", 1, 10_000)]
    assert stored_versions(spark, table).count() == 1


def test_redelivered_record_changes_nothing(spark, table):
    materialize(_log(spark, BASE), table, "r", 0)
    materialize(_log(spark, BASE, first=1), table, "r", 1)
    assert _rows(spark, table) == [("merchant-001", "12:00", 1, 10_000)]


def test_bad_record_leaves_the_table_unchanged(spark, table):
    materialize(_log(spark, BASE), table, "r", 0)
    bad = changed(aggregate("merchant-002"), "payload.transaction_count", True)
    with pytest.raises(Exception, match="invalid:payload.transaction_count at topic/0/6"):
        materialize(_log(spark, aggregate(count=7), bad, first=5), table, "r", 1)
    assert _rows(spark, table) == [("merchant-001", "12:00", 1, 10_000)]


def test_new_run_does_not_overwrite_the_old_one(spark, table):
    materialize(_log(spark, BASE), table, "first", 0)
    materialize(_log(spark, aggregate("merchant-002")), table, "second", 0)
    assert len(_rows(spark, table)) == 2


def test_window_start_may_be_any_text(spark, table):
    materialize(_log(spark, BASE, aggregate(start="some time")), table, "r", 0)
    assert len(_rows(spark, table)) == 2


def test_compact(spark, table):
    materialize(_log(spark, BASE, aggregate(count=2, total=35_000)), table, "r", 0)
    target = work_dir(spark, "test-compact")
    compact(spark, table, target)
    assert _rows(spark, target) == _rows(spark, table)
    assert stored_versions(spark, target).count() == 1


def test_days_are_pruned(spark, table):
    materialize(_log(spark, BASE), table, "r", 0)
    plan = stored_versions(spark, table).filter("window_date = DATE'2026-01-01'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "window_date" in text.split("PartitionFilters:")[1].split("]")[0]
    assert plan.count() == 1
