"""Decoding and every rule of the event contract."""

from __future__ import annotations

import json

import pytest
from paystream.operators.contract import check_events
from paystream.operators.route import (
    confirmed,
    dead_letters,
    invalid_events,
    routed_log,
    split_records,
    valid_events,
)
from tests.helpers import changed, event, records

BASE = event()
PAYLOAD = ["transaction_id", "merchant_id", "account_id", "amount", "currency", "status"]

CASES = {
    "valid": (BASE, []),
    "compact": (json.dumps(BASE, separators=(",", ":")), []),
    "padded": ("\n  " + json.dumps(BASE, indent=2) + " \t", []),
    "extra fields": ({**BASE, "note": [1, {"a": "]"}], "more": None}, []),
    "no number in an extra field": (json.dumps({**BASE, "note": float("nan"), "x": float("-inf")}), []),
    "numeric id text": (changed(BASE, "event_id", "123"), []),
    "literal id text": (changed(BASE, "event_id", "true"), []),
    "blank id": (changed(BASE, "event_id", " "), []),
    "braces in id": (changed(BASE, "event_id", "{x]"), []),
    "escapes": (changed(BASE, "event_id", 'a"\\é\n'), []),
    "repeated key, last counts": (
        json.dumps(BASE).replace('"event_id"', '"event_id": 5, "event_id"', 1), []),
    "not utf-8": (b"\xff\xfe\xfd", ["encoding:value"]),
    "cut utf-8": (json.dumps(BASE).encode() + b"\xe2\x82", ["encoding:value"]),
    "not json": ("{not valid json", ["syntax:value"]),
    "null value": (None, ["syntax:value"]),
    "empty": (b"", ["syntax:value"]),
    "blank": ("  ", ["syntax:value"]),
    "trailing text": (json.dumps(BASE) + " x", ["syntax:value"]),
    "trailing bracket": (json.dumps(BASE) + "]", ["syntax:value"]),
    "trailing bracket and text": (json.dumps(BASE) + "] x", ["syntax:value"]),
    "trailing brace": (json.dumps(BASE) + "}", ["syntax:value"]),
    "two values": (json.dumps(BASE) + "," + json.dumps(BASE), ["syntax:value"]),
    "trailing comma": (json.dumps(BASE) + ",", ["syntax:value"]),
    "byte order mark": ("﻿" + json.dumps(BASE), ["syntax:value"]),
    "single quotes": ("{'a': 1}", ["syntax:value"]),
    "array": ("[1, 2, 3]", ["type:value"]),
    "array of event": (json.dumps([BASE]), ["type:value"]),
    "text": ('"x"', ["type:value"]),
    "json null": ("null", ["type:value"]),
    "number": ("7", ["type:value"]),
    "no version": (changed(BASE, "schema_version", drop=True), ["missing:schema_version"]),
    "version 2": (changed(BASE, "schema_version", 2), ["unsupported:schema_version"]),
    "version true": (changed(BASE, "schema_version", True), ["type:schema_version"]),
    "version 1.0": (changed(BASE, "schema_version", 1.0), ["type:schema_version"]),
    "version text": (changed(BASE, "schema_version", "1"), ["type:schema_version"]),
    "version null": (changed(BASE, "schema_version", None), ["type:schema_version"]),
    "no id": (changed(BASE, "event_id", drop=True), ["missing:event_id"]),
    "empty id": (changed(BASE, "event_id", ""), ["invalid:event_id"]),
    "number id": (changed(BASE, "event_id", 123), ["invalid:event_id"]),
    "true id": (changed(BASE, "event_id", True), ["invalid:event_id"]),
    "null id": (changed(BASE, "event_id", None), ["invalid:event_id"]),
    "object id": (changed(BASE, "event_id", {"a": 1}), ["invalid:event_id"]),
    "object id with a line separator": (
        json.dumps(changed(BASE, "event_id", {"a": "\u2028"}), ensure_ascii=False),
        ["invalid:event_id"]),
    "other case": (
        json.dumps(BASE).replace("event_id", "Event_id"), ["missing:event_id"]),
    "control character": (json.dumps(BASE).replace("evt-1", "evt\n1"), ["syntax:value"]),
    "no key": (changed(BASE, "key", drop=True), ["missing:key"]),
    "empty key": (changed(BASE, "key", ""), ["invalid:key"]),
    "other key": (changed(BASE, "key", "merchant-999"), ["mismatch:key"]),
    "no time": (changed(BASE, "event_time", drop=True), ["missing:event_time"]),
    "number time": (changed(BASE, "event_time", 20260101), ["type:event_time"]),
    "no such time": (changed(BASE, "event_time", "not-a-timestamp"), ["unparseable:event_time"]),
    "empty time": (changed(BASE, "event_time", ""), ["unparseable:event_time"]),
    "naive time": (changed(BASE, "event_time", "2026-01-01T12:00:00"), ["naive:event_time"]),
    "offset time": (changed(BASE, "event_time", "2026-08-21T19:00:00-03:00"), []),
    "no payload": (changed(BASE, "payload", drop=True), ["missing:payload"]),
    "payload text": (changed(BASE, "payload", "x"), ["type:payload"]),
    "payload null": (changed(BASE, "payload", None), ["type:payload"]),
    "payload list": (changed(BASE, "payload", []), ["type:payload"]),
    "payload empty": (
        changed(BASE, "payload", {}), [f"missing:payload.{name}" for name in PAYLOAD]),
    "amount float": (changed(BASE, "payload.amount", 1000.5), ["type:payload.amount"]),
    "amount 1.0": (changed(BASE, "payload.amount", 1.0), ["type:payload.amount"]),
    "amount 1e3": (json.dumps(BASE).replace("10000", "1e3"), ["type:payload.amount"]),
    "amount true": (changed(BASE, "payload.amount", True), ["type:payload.amount"]),
    "amount text": (changed(BASE, "payload.amount", "10"), ["type:payload.amount"]),
    "amount 0": (changed(BASE, "payload.amount", 0), ["range:payload.amount"]),
    "amount -1": (changed(BASE, "payload.amount", -1), ["range:payload.amount"]),
    "amount max": (changed(BASE, "payload.amount", 2**63 - 1), []),
    "currency": (changed(BASE, "payload.currency", "USD"), ["invalid:payload.currency"]),
    "status": (changed(BASE, "payload.status", "REFUNDED"), ["invalid:payload.status"]),
    "declined": (changed(BASE, "payload.status", "DECLINED"), []),
    "two errors": (
        changed(changed(BASE, "payload.currency", "USD"), "payload.status", "REFUNDED"),
        ["invalid:payload.currency", "invalid:payload.status"]),
    "key and merchant missing": (
        changed(changed(BASE, "payload.merchant_id", ""), "key", drop=True),
        ["missing:key", "invalid:payload.merchant_id"]),
    "everything missing": ({}, [
        "missing:schema_version", "missing:event_id", "missing:key", "missing:event_time",
        "missing:payload"]),
    **{
        f"no {name}": (changed(BASE, f"payload.{name}", drop=True), [f"missing:payload.{name}"])
        for name in PAYLOAD
    },
    **{
        f"number {name}": (changed(BASE, f"payload.{name}", 5), [f"invalid:payload.{name}"])
        for name in PAYLOAD if name not in ("amount",)
    },
}


@pytest.fixture(scope="module")
def checked(spark):
    frame = check_events(records(spark, [value for value, _ in CASES.values()]))
    return dict(zip(CASES, frame.orderBy("offset").collect(), strict=True))


@pytest.mark.parametrize("name", CASES)
def test_errors(checked, name):
    assert checked[name].errors == CASES[name][1]


def test_typed_columns(checked):
    row = checked["valid"]
    assert (row.event_id, row.event_key, row.merchant_id) == ("evt-1",) + ("merchant-001",) * 2
    assert (row.transaction_id, row.account_id, row.amount) == ("txn-1", "account-001", 10_000)
    assert (row.currency, row.status) == ("PYG", "CONFIRMED")
    assert checked["escapes"].event_id == 'a"\\é\n'
    assert checked["number id"].event_id is None
    assert checked["amount max"].amount == 2**63 - 1


def test_same_instant_for_any_offset(spark):
    times = ["2026-08-21T19:00:00-03:00", "2026-08-21T22:00:00Z", "2026-08-22T03:30:00+05:30"]
    frame = check_events(records(spark, [event(at=t) for t in times]))
    assert frame.select("event_ts").distinct().count() == 1


def test_dead_letters(spark):
    values = [
        changed(BASE, "event_id", drop=True), changed(BASE, "currency", 1), b"\xff\xfe\xfd",
        changed(BASE, "payload.amount", 0), None, changed(BASE, "event_id", 7),
        changed(BASE, "payload.status", "año\"\\x"),
    ]
    letters = dead_letters(invalid_events(check_events(records(spark, values))))
    rows = {r.source_offset: r for r in letters.collect()}
    assert set(rows) == {0, 2, 3, 4, 5, 6}
    assert [bytes(rows[i].key) for i in (0, 2, 3, 4, 5)] == [b"", b"", b"evt-1", b"", b""]
    letter = {i: json.loads(bytes(r.value)) for i, r in rows.items()}
    assert letter[0] == {"errors": ["missing:event_id"], "raw_data": values[0]}
    assert letter[2] == {"errors": ["encoding:value"], "raw_data": "�" * 3}
    assert letter[4] == {"errors": ["syntax:value"], "raw_data": ""}
    assert letter[6]["raw_data"] == values[6]
    assert "año" in bytes(rows[6].value).decode()


def test_routing(spark):
    values = [BASE, changed(BASE, "payload.status", "DECLINED"), "x", changed(BASE, "key", "")]
    counted, invalid = split_records(records(spark, values))
    assert [r.offset for r in counted.collect()] == [0]
    assert sorted(r.offset for r in invalid.collect()) == [2, 3]
    checked = check_events(records(spark, values))
    assert valid_events(checked).count() == 2
    assert confirmed(valid_events(checked)).count() == 1
    routed = routed_log(checked, "good", "bad").collect()
    assert sorted(r.topic for r in routed) == ["bad", "bad", "good"]
    good = next(r for r in routed if r.topic == "good")
    assert json.loads(bytes(good.value)) == BASE and bytes(good.key) == b"merchant-001"


def test_records_are_parsed_once(spark):
    """Filters on typed columns must not make Catalyst repeat the parse."""
    plan = confirmed(valid_events(check_events(records(spark, [BASE])))).select("amount")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1
    assert text.count("parseJson(") == 1
