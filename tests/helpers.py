"""Events, aggregates and arrival steps for the tests."""

from __future__ import annotations

import copy
import json

from pyspark.sql import DataFrame, SparkSession

RECORD = "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp STRING"
PAYMENT = (
    "event_id STRING, ts STRING, merchant_id STRING, amount BIGINT, partition INT, offset BIGINT"
)


def event(event_id="evt-1", merchant="merchant-001", at="2026-01-01T12:00:00.000Z",
          amount=10_000, status="CONFIRMED"):
    return {
        "schema_version": 1, "event_id": event_id, "key": merchant, "event_time": at,
        "payload": {
            "transaction_id": "txn-1", "merchant_id": merchant, "account_id": "account-001",
            "amount": amount, "currency": "PYG", "status": status,
        },
    }


def changed(base: dict, path: str, value=None, drop: bool = False) -> dict:
    out = copy.deepcopy(base)
    *parents, last = path.split(".")
    node = out
    for parent in parents:
        node = node[parent]
    if drop:
        del node[last]
    else:
        node[last] = value
    return out


def aggregate(merchant="merchant-001", start="2026-01-01T12:00:00.000Z",
              end="2026-01-01T12:01:00.000Z", count=1, total=10_000):
    return {
        "schema_version": 1, "key": f"{merchant}|{start}", "window_start": start,
        "window_end": end,
        "payload": {
            "merchant_id": merchant, "transaction_count": count, "total_amount_pyg": total,
        },
    }


def raw(value) -> bytes | None:
    if value is None or isinstance(value, bytes):
        return value
    return (value if isinstance(value, str) else json.dumps(value)).encode()


def records(spark: SparkSession, values, keys=None) -> DataFrame:
    keys = keys if keys is not None else [b"merchant-001"] * len(values)
    rows = [
        (key, raw(value), "topic", 0, offset, "2026-01-01 12:00:00")
        for offset, (key, value) in enumerate(zip(keys, values, strict=True))
    ]
    return spark.createDataFrame(rows, RECORD).selectExpr(
        "key", "value", "topic", "partition", "offset", "cast(timestamp AS timestamp) timestamp"
    )


def payments(spark: SparkSession, rows, first_offset=0) -> DataFrame:
    """Rows of (event_id, time, amount[, merchant])."""
    data = [
        (row[0], row[1], row[3] if len(row) > 3 else "merchant-001", row[2], 0, first_offset + n)
        for n, row in enumerate(rows)
    ]
    return spark.createDataFrame(data, PAYMENT).selectExpr(
        "event_id", "cast(ts AS timestamp) AS event_ts", "merchant_id", "amount", "partition",
        "offset",
    )


def steps(spark: SparkSession, arrivals) -> list[DataFrame]:
    """One table of payments per arrival step, offsets running on."""
    out, offset = [], 0
    for rows in arrivals:
        out.append(payments(spark, rows, offset))
        offset += len(rows)
    return out


def demo_events() -> list[dict]:
    """Ten records in arrival order: out of order, duplicate, late and without id among them."""
    rows = [
        ("c6737b8b-2a6a-4b5f-bb5d-75b895f628f2", 3, "12:00:00", 373181, "CONFIRMED"),
        ("643cb56d-4ec1-4fc6-bee2-9f53ebf644bb", 2, "12:00:02", 333856, "DECLINED"),
        ("6cecc258-1bfa-430d-9d68-5155e98cd7d9", 3, "12:00:04", 400264, "CONFIRMED"),
        ("e369ab3d-591d-4569-ab0a-0d83b2ff5134", 3, "12:00:06", 472925, "PENDING"),
        ("d51f25e6-0490-492a-a9eb-72624f93de30", 2, "12:00:08", 421275, "CONFIRMED"),
        ("da1298c4-cbb4-42ae-abd4-e7abf522dfdc", 2, "12:00:03", 63147, "CONFIRMED"),
        ("6cecc258-1bfa-430d-9d68-5155e98cd7d9", 3, "12:00:04", 400264, "CONFIRMED"),
        ("113a972f-8c39-46bb-b373-85edcdd25aa1", 2, "11:56:30", 240682, "CONFIRMED"),
        (None, 3, "12:00:09", 325362, "CONFIRMED"),
        ("1ac66dea-3270-4980-b262-c798a28f38bd", 3, "12:00:10", 29223, "CONFIRMED"),
    ]
    out = []
    for event_id, merchant, clock, amount, status in rows:
        made = event(event_id, f"merchant-00{merchant}", f"2026-01-01T{clock}.000Z", amount,
                     status)
        out.append(made if event_id else changed(made, "event_id", drop=True))
    return out
