"""The payment event contract: parse, check every rule, give typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from paystream.config import CURRENCY, SCHEMA_VERSION, STATUSES
from paystream.functions.iso_time import has_zone, is_common_iso8601, parse_iso8601
from paystream.functions.rules import Fields, all_hold, collect_errors, decoding_error, settle

EVENT = Fields({
    "schema_version": "integer",
    "event_id": "text",
    "key": "text",
    "event_time": "text",
    "payload.transaction_id": "text",
    "payload.merchant_id": "text",
    "payload.account_id": "text",
    "payload.amount": "integer",
    "payload.currency": "text",
    "payload.status": "text",
})

# Output name of each field.
EVENT_COLUMNS = {
    "event_id": "event_id",
    "event_key": "key",
    "event_time": "event_time",
    "transaction_id": "payload.transaction_id",
    "merchant_id": "payload.merchant_id",
    "account_id": "payload.account_id",
    "amount": "payload.amount",
    "currency": "payload.currency",
    "status": "payload.status",
}


def _is_valid() -> str:
    get = EVENT.value
    statuses = ", ".join(f"'{status}'" for status in STATUSES)
    return all_hold(
        f"{get('schema_version')} = {SCHEMA_VERSION}",
        f"{get('event_id')} <> ''",
        f"{get('key')} <> ''",
        "_event_ts IS NOT NULL",
        "_zoned",
        f"{get('payload.transaction_id')} <> ''",
        f"{get('payload.account_id')} <> ''",
        EVENT.is_positive("payload.amount"),
        f"{get('payload.currency')} = '{CURRENCY}'",
        f"{get('payload.status')} IN ({statuses})",
        f"{get('key')} = {get('payload.merchant_id')}",
    )


def _errors() -> str:
    """Every broken rule of a JSON object, in contract order."""
    get = EVENT.value

    def text_error(name: str) -> str:
        return EVENT.error(name, ("invalid", EVENT.is_empty(name)))

    version, at = get("schema_version"), get("event_time")
    key, merchant = get("key"), get("payload.merchant_id")
    inside = [
        text_error("payload.transaction_id"),
        text_error("payload.merchant_id"),
        text_error("payload.account_id"),
        EVENT.error(
            "payload.amount",
            ("type", f"NOT {EVENT.is_integer('payload.amount')}"),
            ("range", f"NOT {EVENT.is_positive('payload.amount')}"),
        ),
        EVENT.error("payload.currency", (
            "invalid", EVENT.is_none_of("payload.currency", [CURRENCY]))),
        EVENT.error("payload.status", (
            "invalid", EVENT.is_none_of("payload.status", STATUSES))),
    ]
    return collect_errors(
        EVENT.error(
            "schema_version",
            ("type", f"NOT {EVENT.is_integer('schema_version')}"),
            ("unsupported", f"NOT coalesce({version} = {SCHEMA_VERSION}, false)"),
        ),
        text_error("event_id"),
        text_error("key"),
        EVENT.error(
            "event_time",
            ("type", f"{at} IS NULL"),
            ("unparseable", "_event_ts IS NULL"),
            ("naive", "NOT _zoned"),
        ),
        EVENT.object_error("payload"),
        *(f"CASE WHEN {EVENT.is_object('payload')} THEN {error} END" for error in inside),
        f"CASE WHEN {key} <> '' AND {merchant} <> '' AND {key} <> {merchant} "
        "THEN 'mismatch:key' END",
    )


def check_events(records: DataFrame, value: str = "value") -> DataFrame:
    """Add the typed event columns and ``errors``; an event is valid iff ``errors`` is empty.

    Added columns: ``event_id, event_key, event_time, transaction_id, merchant_id, account_id,
    amount, currency, status, event_ts`` (NULL where missing or of a wrong type),
    ``amount_wide`` (the digits of an amount beyond 64 bits, whose ``amount`` is NULL) and
    ``errors ARRAY<STRING>`` with every broken rule in contract order. A value that is no JSON
    object has one error and no fields. Fields outside the contract are ignored; the record's
    ``value`` still holds them.

    The list of errors is only worked out for rows that fail the short check.
    """
    written = EVENT.value("event_time")
    parsed = (
        EVENT.read(records, value)
        .selectExpr("*", f"{is_common_iso8601(written)} AS _common")
        .selectExpr(
            "*",
            f"{parse_iso8601(written, '_common')} AS _event_ts",
            f"{has_zone(written, '_common')} AS _zoned",
        )
        .selectExpr("*", f"{_is_valid()} AS _valid", f"{decoding_error()} AS _undecoded")
    )
    errors = (
        "CASE WHEN _valid THEN cast(array() AS ARRAY<STRING>) "
        f"WHEN _undecoded IS NOT NULL THEN array(_undecoded) ELSE {_errors()} END"
    )
    columns = {out: EVENT.value(name) for out, name in EVENT_COLUMNS.items()}
    columns |= {
        "amount_wide": EVENT.wide("payload.amount"), "event_ts": "_event_ts", "errors": errors,
    }
    return settle(parsed, columns, keep=records.columns)
