"""Schemas of the data at rest and on the wire."""

from __future__ import annotations

# One record of a log, as the Kafka source delivers it. Files use the same columns.
RECORD = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

# One counted payment: what deduplication and windows work on.
PAYMENT = (
    "event_id STRING, event_ts TIMESTAMP, merchant_id STRING, amount BIGINT, amount_wide STRING, "
    "partition INT, offset BIGINT"
)


def payment_columns() -> list[str]:
    return [part.split()[0] for part in PAYMENT.split(", ")]


# Both outputs of one parse, by route, which is a folder.
PAYMENTS, LETTERS = "payments", "letters"
ROUTED = f"key BINARY, value BINARY, {PAYMENT}, route STRING"

# The rows a user queries.
AGGREGATE = (
    "aggregate_key STRING, merchant_id STRING, window_start STRING, window_end STRING, "
    "transaction_count BIGINT, total_amount_pyg BIGINT"
)
AGGREGATE_COLUMNS = [part.split()[0] for part in AGGREGATE.split(", ")]

# The stored versions of those rows; run, batch_id and window_date are folders.
VERSIONS = AGGREGATE + ", version BIGINT, run STRING, batch_id BIGINT, window_date DATE"
