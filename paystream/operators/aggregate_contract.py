"""The contract of aggregate records, checked before they are stored."""

from __future__ import annotations

from pyspark.sql import DataFrame

from paystream.config import SCHEMA_VERSION
from paystream.functions.rules import Fields, all_hold, decoding_error, settle

AGGREGATE_FIELDS = Fields({
    "schema_version": "integer",
    "key": "text",
    "window_start": "text",
    "window_end": "text",
    "payload.merchant_id": "text",
    "payload.transaction_count": "integer",
    "payload.total_amount_pyg": "integer",
})

_OUT = {
    "aggregate_key": "key",
    "merchant_id": "payload.merchant_id",
    "window_start": "window_start",
    "window_end": "window_end",
    "transaction_count": "payload.transaction_count",
    "total_amount_pyg": "payload.total_amount_pyg",
}
# The same for the digits of integers beyond 64 bits.
_OUT_WIDE = {
    "transaction_count_wide": "payload.transaction_count",
    "total_amount_wide": "payload.total_amount_pyg",
}


def _equals_one() -> str:
    """Whether schema_version is 1 as a number: 1.0 and true pass here, text does not."""
    kind = AGGREGATE_FIELDS.kind("schema_version")
    return (
        f"coalesce({AGGREGATE_FIELDS.value('schema_version')} = {SCHEMA_VERSION}, "
        f"CASE WHEN {kind} IN ('BOOLEAN', 'DOUBLE', 'FLOAT') OR {kind} LIKE 'DECIMAL%' "
        "THEN try_variant_get(_object.schema_version, '$', 'double') = 1 END, false)"
    )


def _expected_key() -> str:
    get = AGGREGATE_FIELDS.value
    return f"concat_ws('|', {get('payload.merchant_id')}, {get('window_start')})"


def _error() -> str:
    """The first broken rule, NULL if all hold."""
    fields, get = AGGREGATE_FIELDS, AGGREGATE_FIELDS.value

    def negative(name: str) -> str:
        return f"coalesce({fields.is_negative(name)}, true)"

    checks = {
        "missing:schema_version": fields.is_missing("schema_version"),
        "unsupported:schema_version": f"NOT {_equals_one()}",
        "invalid:key": fields.is_empty("key"),
        "invalid:window_start": fields.is_empty("window_start"),
        "invalid:window_end": fields.is_empty("window_end"),
        "invalid:payload": f"NOT {fields.is_object('payload')}",
        "invalid:payload.merchant_id": fields.is_empty("payload.merchant_id"),
        "invalid:payload.transaction_count": negative("payload.transaction_count"),
        "invalid:payload.total_amount_pyg": negative("payload.total_amount_pyg"),
        "mismatch:key": f"{get('key')} <> {_expected_key()}",
        "missing:record_key": "key IS NULL",
        "mismatch:record_key": f"key <> cast({get('key')} AS BINARY)",
    }
    whens = " ".join(f"WHEN {broken} THEN '{code}'" for code, broken in checks.items())
    return f"CASE WHEN _undecoded IS NOT NULL THEN _undecoded {whens} END"


def check_aggregates(records: DataFrame) -> DataFrame:
    """Add the typed aggregate columns and ``error``, the first broken rule or NULL.

    Numbers beyond 64 bits keep the contract; their digits are in ``transaction_count_wide`` and
    ``total_amount_wide``.
    """
    get = AGGREGATE_FIELDS.value
    texts = ("key", "window_start", "window_end", "payload.merchant_id")
    valid = all_hold(
        f"{get('schema_version')} = {SCHEMA_VERSION}",
        *(f"{get(name)} <> ''" for name in texts),
        f"NOT {AGGREGATE_FIELDS.is_negative('payload.transaction_count')}",
        f"NOT {AGGREGATE_FIELDS.is_negative('payload.total_amount_pyg')}",
        f"{get('key')} = {_expected_key()}",
        f"key = cast({get('key')} AS BINARY)",
    )
    parsed = AGGREGATE_FIELDS.read(records).selectExpr(
        "*", f"{valid} AS _valid", f"{decoding_error()} AS _undecoded"
    )
    columns = {out: get(name) for out, name in _OUT.items()}
    columns |= {out: AGGREGATE_FIELDS.wide(name) for out, name in _OUT_WIDE.items()}
    columns["error"] = f"CASE WHEN NOT _valid THEN {_error()} END"
    return settle(parsed, columns, keep=records.columns)
