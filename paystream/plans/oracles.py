"""Expected results in SQL, worked out from the ``events`` table without building any JSON value.

Only lengths of dead letters and the event times need the written text.
"""

from __future__ import annotations

from paystream.plans.payments import (
    BIG,
    BIG_ERRORS,
    BIG_EVERY,
    COPY_DELAY,
    COPY_EVERY,
    FAULTS,
    ORIGIN,
    TAMPER_EVERY,
    TAMPERED,
    ZONES,
)

_FAULT = "CASE " + " ".join(
    f"WHEN event_id % {divisor} = 0 THEN '{name}'" for divisor, name in FAULTS.items()
) + " END"

_BASE = f"""
base AS (
  SELECT event_id AS i,
    'evt-' || event_id AS event_id,
    make_timestamp(epoch_us(TIMESTAMP '{ORIGIN}')
      + (epoch_us(ts) - epoch_us(TIMESTAMP '{ORIGIN}')) // 60) AS event_ts,
    'merchant-' || lpad((user_id % 3 + 1)::VARCHAR, 3, '0') AS merchant_id,
    'account-' || lpad((user_id % 10 + 1)::VARCHAR, 3, '0') AS account_id,
    round(value * 100)::BIGINT AS amount,
    CASE event_type WHEN 'view' THEN 'PENDING' WHEN 'error' THEN 'DECLINED'
      ELSE 'CONFIRMED' END AS status,
    {_FAULT} AS fault,
    (user_id % 3)::INTEGER AS "partition"
  FROM events)"""

_CLOCK = "'%Y-%m-%dT%H:%M:%S.%f'"
_TIME = (
    f"CASE WHEN fault = 'naive_time' THEN strftime(event_ts, {_CLOCK}) "
    + " ".join(
        f"WHEN i % 4 = {rest} THEN strftime(event_ts + INTERVAL ({minutes}) MINUTE, {_CLOCK})"
        f" || '{zone}'"
        for rest, (zone, minutes) in ZONES.items()
    )
    + " END"
)

_UNDECODED = "fault IN ('bad_utf8', 'no_object', 'trailing_text', 'broken_json', 'null_value')"

_LOG = _BASE + f""",
log AS (
  SELECT *, 2 * i AS "offset", 0 AS copy FROM base
  UNION ALL
  SELECT *, 2 * (i + {COPY_DELAY}) + 1, 1 FROM base WHERE i % {COPY_EVERY} = 0),
checked AS (
  SELECT *, {_TIME} AS event_time,
    fault IN ({{undecoded}}) IS TRUE AS undecoded,
    CASE WHEN fault = 'bad_utf8' THEN ['encoding:value']
      WHEN fault = 'no_object' THEN ['type:value']
      WHEN fault IN ('trailing_text', 'broken_json', 'null_value') THEN ['syntax:value']
      ELSE list_filter([
        CASE WHEN fault = 'missing_id' THEN 'missing:event_id' END,
        CASE WHEN fault = 'naive_time' THEN 'naive:event_time' END,
        CASE WHEN fault IN ('float_amount', 'bool_amount') THEN 'type:payload.amount'
          WHEN amount <= 0 THEN 'range:payload.amount' END,
        CASE WHEN fault IN ('wrong_currency', 'two_errors') THEN 'invalid:payload.currency' END,
        CASE WHEN fault = 'two_errors' THEN 'invalid:payload.status' END,
        CASE WHEN fault = 'key_mismatch' THEN 'mismatch:key' END
      ], lambda e: e IS NOT NULL) END AS errors
  FROM log),
confirmed AS (SELECT * FROM checked WHERE len(errors) = 0 AND status = 'CONFIRMED')""".replace(
    "fault IN ({undecoded})", _UNDECODED
)

_START = "strftime(date_trunc('minute', event_ts), '%Y-%m-%dT%H:%M:%S.000Z')"
_END = (
    "strftime(date_trunc('minute', event_ts) + INTERVAL 1 MINUTE, '%Y-%m-%dT%H:%M:%S.000Z')"
)


def _windows(condition: str = "copy = 0") -> str:
    return f"""
windows AS (
  SELECT merchant_id || '|' || {_START} AS aggregate_key, merchant_id,
    {_START} AS window_start, {_END} AS window_end,
    count(*) AS transaction_count, sum(amount)::BIGINT AS total_amount_pyg
  FROM confirmed WHERE {condition} GROUP BY ALL)"""


_VERSIONS = _windows() + """,
versions AS (
  SELECT aggregate_key, merchant_id, window_start, window_end,
    transaction_count * n AS transaction_count, total_amount_pyg * n AS total_amount_pyg,
    epoch(window_start::TIMESTAMP)::BIGINT // 60 AS minute, n,
    (right(merchant_id, 1)::INTEGER - 1)::INTEGER AS "partition"
  FROM windows, (VALUES (1), (2), (3)) AS v(n)),
numbered AS (SELECT *, minute * 10 + n * 2 AS "offset" FROM versions)"""

_COLUMNS = (
    "aggregate_key, merchant_id, window_start, window_end, transaction_count, total_amount_pyg"
)

_JSON = """'{"key":"' || aggregate_key || '","payload":{"merchant_id":"' || merchant_id
    || '","total_amount_pyg":' || total_amount_pyg || ',"transaction_count":'
    || transaction_count || '},"schema_version":1,"window_end":"' || window_end
    || '","window_start":"' || window_start || '"}'"""

# Length of the written event, field by field.
_TEXT_LENGTH = """(length('{"schema_version":1,"key":"","event_time":"",'
      || '"payload":{"transaction_id":"txn-","merchant_id":"","account_id":"","amount":,'
      || '"currency":"PYG","status":""}}')
    + CASE WHEN fault = 'missing_id' THEN 0 ELSE length(',"event_id":""') + length(event_id) END
    + length('merchant-001') + length(event_time) + length(i::VARCHAR) + length(merchant_id)
    + length(account_id)
    + CASE fault WHEN 'float_amount' THEN length(amount::VARCHAR) + 2
        WHEN 'bool_amount' THEN 4 ELSE length(amount::VARCHAR) END
    + CASE WHEN fault = 'two_errors' THEN length('REFUNDED') ELSE length(status) END)"""

# The written event, and what a dead letter holds of it: an object with its keys in order, or text.
_TEXT = """('{"schema_version":1' || CASE WHEN fault IS DISTINCT FROM 'missing_id' THEN ',"event_id":"' || event_id || '"' ELSE '' END
    || ',"key":"' || CASE WHEN fault = 'key_mismatch' THEN 'merchant-999' ELSE merchant_id END
    || '","event_time":"' || event_time || '","payload":{"transaction_id":"txn-' || i || '","merchant_id":"' || merchant_id
    || '","account_id":"' || account_id || '","amount":' || written_amount
    || ',"currency":"' || CASE WHEN fault IN ('wrong_currency', 'two_errors') THEN 'USD' ELSE 'PYG' END
    || '","status":"' || CASE WHEN fault = 'two_errors' THEN 'REFUNDED' ELSE status END || '"}}')"""
_SORTED = """('{' || CASE WHEN fault IS DISTINCT FROM 'missing_id' THEN '"event_id":"' || event_id || '",' ELSE '' END
    || '"event_time":"' || event_time || '","key":"' || CASE WHEN fault = 'key_mismatch' THEN 'merchant-999' ELSE merchant_id END
    || '","payload":{"account_id":"' || account_id || '","amount":' || written_amount
    || ',"currency":"' || CASE WHEN fault IN ('wrong_currency', 'two_errors') THEN 'USD' ELSE 'PYG' END
    || '","merchant_id":"' || merchant_id
    || '","status":"' || CASE WHEN fault = 'two_errors' THEN 'REFUNDED' ELSE status END
    || '","transaction_id":"txn-' || i || '"},"schema_version":1}')"""
_WRITTEN = "CASE fault WHEN 'float_amount' THEN amount || '.5' WHEN 'bool_amount' THEN 'true' ELSE amount::VARCHAR END"
_RAW = f"""CASE WHEN NOT undecoded THEN {_SORTED} ELSE '"' || replace(CASE fault WHEN 'null_value' THEN ''
    WHEN 'no_object' THEN '[1, 2, 3]' WHEN 'bad_utf8' THEN {_TEXT} || chr(65533) WHEN 'trailing_text' THEN {_TEXT} || ' x'
    ELSE left({_TEXT}, length({_TEXT}) - 1) END, '"', '\\"') || '"' END""".replace("written_amount", f"({_WRITTEN})")

_LETTERS = f"""
SELECT "offset" AS source_offset,
  CASE WHEN undecoded OR fault = 'missing_id' THEN '' ELSE event_id END AS letter_key,
  '["' || array_to_string(errors, '","') || '"]' AS errors,
  CASE WHEN NOT undecoded THEN merchant_id END AS raw_merchant,
  CASE fault WHEN 'null_value' THEN 0 WHEN 'no_object' THEN 9
    WHEN 'bad_utf8' THEN {_TEXT_LENGTH} + 1
    WHEN 'trailing_text' THEN {_TEXT_LENGTH} + 2
    WHEN 'broken_json' THEN {_TEXT_LENGTH} - 1
    ELSE {_TEXT_LENGTH} END AS raw_length
FROM checked WHERE len(errors) > 0"""


def _draw(what: str, choices: int) -> str:
    return f"(('0x' || substr(md5('7|{what}|' || event_id), 1, 12))::BIGINT % {choices})"


_GENERATED = f"""
generated AS (
  SELECT event_id AS id, md5('7|event|' || event_id) AS digest,
    'merchant-' || lpad(({_draw('merchant', 3)} + 1)::VARCHAR, 3, '0') AS key,
    make_timestamp(epoch_us(TIMESTAMP '2026-01-01 12:00:00') + event_id * 2000000) AS moment,
    'txn-' || substr(md5('7|transaction|' || event_id), 1, 16) AS transaction_id,
    'account-' || lpad(({_draw('account', 10)} + 1)::VARCHAR, 3, '0') AS account_id,
    {_draw('amount', 499001)} + 1000 AS amount,
    ['CONFIRMED', 'DECLINED', 'PENDING'][{_draw('status', 3)} + 1] AS status
  FROM events),
uuids AS (
  SELECT *, substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-4' || substr(digest, 14, 3)
    || '-8' || substr(digest, 18, 3) || '-' || substr(digest, 21, 12) AS event_id
  FROM generated),
tagged AS (
  SELECT *, unnest(CASE id % 10 WHEN 5 THEN ['out_of_order'] WHEN 2 THEN ['normal', 'duplicate']
    WHEN 6 THEN ['late'] WHEN 7 THEN ['invalid'] ELSE ['normal'] END) AS scenario_tag
  FROM uuids),
sown AS (
  SELECT * REPLACE (CASE WHEN scenario_tag <> 'invalid' THEN event_id END AS event_id),
    strftime(moment - CASE scenario_tag WHEN 'out_of_order' THEN INTERVAL 5 SECOND
      WHEN 'late' THEN INTERVAL 210 SECOND ELSE INTERVAL 0 SECOND END,
      '%Y-%m-%dT%H:%M:%S.000Z') AS event_time,
    id * 2 + CASE WHEN scenario_tag = 'duplicate' THEN 9 ELSE 0 END AS arrival
  FROM tagged)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _tampered(part: int) -> str:
    """The errors before (1) or after (2) those of the amount, by case."""
    cases = " ".join(
        f"WHEN {rest} THEN {list(case[part])}" for rest, case in TAMPERED.items() if case[part]
    )
    return f"CASE i % {TAMPER_EVERY} {cases} ELSE []::VARCHAR[] END"


_NO_AMOUNT = ", ".join(str(rest) for rest, case in TAMPERED.items() if case[2] is None)

def _big(pattern: str) -> str:
    """The amount written by a pattern of ``BIG``."""
    before, mark, after = pattern.partition("#")
    if not mark:
        return f"'{pattern}'"
    length = "".join(c for c in after[2:].partition(".")[0] if c.isdigit())
    return f"'{before}' || lpad(i::VARCHAR, {length}, '{after[0]}') || '{after[2 + len(length):]}'"


_BIG = f"(CASE i % {BIG_EVERY} " + " ".join(f"WHEN {k} THEN {_big(p)}" for k, p in BIG.items()) + " ELSE amount::VARCHAR END)"

ORACLES: dict[str, str] = {
    "window_agg_60s": _with(_LOG, _windows()) + f" SELECT {_COLUMNS} FROM windows",
    "parse_outcome_counts": _with(_LOG) + """
        SELECT CASE WHEN undecoded THEN errors[1] ELSE 'object' END AS outcome,
          count(*) AS records FROM checked GROUP BY ALL""",
    "validation_errors": _with(_LOG) + """
        SELECT "offset", (p - 1)::INTEGER AS position, errors[p] AS error
        FROM (SELECT "offset", errors, unnest(range(1, len(errors) + 1)) AS p FROM checked)""",
    "validation_rules": _with(_BASE) + f"""
        SELECT i AS "offset", (p - 1)::INTEGER AS position, errors[p] AS error
        FROM (SELECT i, errors, unnest(range(1, len(errors) + 1)) AS p FROM (
          SELECT i, {_tampered(1)} || CASE WHEN amount <= 0 AND i % {TAMPER_EVERY} NOT IN ({_NO_AMOUNT})
            THEN ['range:payload.amount'] ELSE []::VARCHAR[] END || {_tampered(2)} AS errors FROM base))""",
    "dlq_records": _with(_LOG) + _LETTERS,
    "confirmed_events": _with(_LOG) + f"""
        SELECT event_id, 'txn-' || i AS transaction_id, merchant_id, account_id, amount,
          strftime(event_ts, {_CLOCK}) || 'Z' AS event_ts, "offset" FROM confirmed""",
    "event_time_offsets": _with(_LOG) + f"""
        SELECT "offset", event_time, strftime(event_ts, {_CLOCK}) || 'Z' AS instant
        FROM checked WHERE len(errors) = 0""",
    "routed_topics": _with(_LOG) + """
        SELECT CASE WHEN len(errors) = 0 THEN 'payments.events.v1'
            ELSE 'payments.events.dlq.v1' END AS topic,
          CASE WHEN len(errors) = 0 THEN merchant_id
            WHEN undecoded OR fault = 'missing_id' THEN '' ELSE event_id END AS record_key,
          count(*) AS records
        FROM checked WHERE len(errors) > 0 OR status = 'CONFIRMED' GROUP BY ALL""",
    "dedup_global": _with(_LOG) + """
        SELECT event_id, "partition", "offset" FROM (
          SELECT *, row_number() OVER (
            PARTITION BY event_id ORDER BY "partition", "offset") AS rank FROM confirmed)
        WHERE rank = 1""",
    "dedup_horizon": "WITH RECURSIVE " + _BASE + f""",
        points AS (
          SELECT CASE WHEN i % 3 = 0 THEN 'often' ELSE account_id END AS event_id,
            epoch_us(event_ts) AS t, min(struct_pack(p := "partition", o := i)) AS head
          FROM base GROUP BY 1, 2),
        chain AS (
          SELECT event_id, min(t) AS t FROM points GROUP BY event_id
          UNION ALL
          SELECT c.event_id, min(p.t) FROM chain c
          JOIN points p ON p.event_id = c.event_id AND p.t >= c.t + 180000000
          GROUP BY c.event_id)
        SELECT event_id, strftime(make_timestamp(t), {_CLOCK}) || 'Z' AS event_ts,
          head.o AS "offset"
        FROM chain JOIN points USING (event_id, t)""",
    "big_amounts": _with(_BASE) + f""",
        amounts AS (
          SELECT merchant_id || '|' || {_START} AS aggregate_key, merchant_id, {_START} AS window_start,
            {_END} AS window_end, lpad({_BIG}, 60, '0') AS digits FROM base
          WHERE status = 'CONFIRMED' AND i % {BIG_EVERY} < 4 AND (i % {BIG_EVERY} > 0 OR amount > 0)),
        sums AS (
          SELECT aggregate_key, merchant_id, window_start, window_end, count(*) AS transaction_count,
            sum(substr(digits, 1, 20)::HUGEINT) AS a, sum(substr(digits, 21, 20)::HUGEINT) AS b,
            sum(substr(digits, 41, 20)::HUGEINT) AS c FROM amounts GROUP BY ALL),
        carried AS (
          SELECT *, 100000000000000000000::HUGEINT AS limb, b + c // limb AS over_b, a + over_b // limb AS over_a,
            ltrim(over_a::HUGEINT::VARCHAR || lpad((over_b % limb)::HUGEINT::VARCHAR, 20, '0')
              || lpad((c % limb)::HUGEINT::VARCHAR, 20, '0'), '0') AS total_amount_pyg
          FROM sums)
        SELECT aggregate_key, transaction_count, NULL::VARCHAR AS error, total_amount_pyg AS total_digits,
          {_JSON} AS record_value FROM carried""",
    "big_amount_errors": _with(_BASE) + f"""
        SELECT i AS "offset", CASE i % {BIG_EVERY} {" ".join(f"WHEN {k} THEN '{e}'" for k, e in BIG_ERRORS.items())}
            WHEN 0 THEN CASE WHEN amount > 0 THEN '' ELSE 'range:payload.amount' END ELSE '' END AS errors,
          CASE WHEN i % {BIG_EVERY} < 5 THEN {_BIG} END AS digits,
          CASE WHEN i % {BIG_EVERY} = 7 THEN {_BIG}
            WHEN i % {BIG_EVERY} > 3 OR i % {BIG_EVERY} = 0 AND amount <= 0 THEN {_BIG} END AS letter_amount
        FROM base""",
    "aggregate_json": _with(_LOG, _windows()) + f"""
        SELECT aggregate_key AS record_key, {_JSON} AS record_value FROM windows""",
    "aggregate_validation": _with(_LOG, _VERSIONS) + """
        SELECT "partition", "offset", CASE minute % 16
            WHEN 1 THEN 'unsupported:schema_version' WHEN 2 THEN 'missing:schema_version'
            WHEN 3 THEN 'invalid:payload.transaction_count'
            WHEN 4 THEN 'invalid:payload.total_amount_pyg' WHEN 5 THEN 'mismatch:key'
            WHEN 6 THEN 'invalid:window_end' WHEN 7 THEN 'invalid:payload'
            WHEN 9 THEN 'encoding:value' WHEN 10 THEN 'syntax:value'
            WHEN 11 THEN 'invalid:payload.merchant_id' WHEN 12 THEN 'missing:record_key'
            WHEN 13 THEN 'mismatch:record_key' WHEN 15 THEN 'type:value' END AS error,
          CASE WHEN minute % 16 IN (0, 8) THEN transaction_count
            WHEN minute % 16 = 14 THEN 0 END AS transaction_count
        FROM numbered""",
    "latest_per_key": _with(_LOG, _VERSIONS) + f"""
        SELECT {_COLUMNS}, "offset" FROM numbered
        QUALIFY row_number() OVER (PARTITION BY aggregate_key ORDER BY "offset" DESC) = 1""",
    "upsert_table": _with(_LOG, _VERSIONS) + f"""
        SELECT {_COLUMNS} FROM numbered
        QUALIFY row_number() OVER (PARTITION BY aggregate_key ORDER BY "offset" DESC) = 1""",
    "reconcile": _with(_LOG, _VERSIONS) + f""",
        stored AS (
          SELECT {_COLUMNS} FROM numbered
          WHERE minute % 5 <> 1 AND (minute % 5 <> 2 OR n < 3)
          QUALIFY row_number() OVER (PARTITION BY aggregate_key ORDER BY "offset" DESC) = 1),
        logged AS (
          SELECT {_COLUMNS} FROM numbered WHERE minute % 5 <> 3
          QUALIFY row_number() OVER (PARTITION BY aggregate_key ORDER BY "offset" DESC) = 1)
        SELECT coalesce(s.aggregate_key, l.aggregate_key) AS aggregate_key,
          CASE WHEN l.aggregate_key IS NULL THEN 'only_left'
            WHEN s.aggregate_key IS NULL THEN 'only_right'
            WHEN s.merchant_id = l.merchant_id AND s.window_start = l.window_start
              AND s.window_end = l.window_end AND s.transaction_count = l.transaction_count
              AND s.total_amount_pyg = l.total_amount_pyg THEN 'match'
            ELSE 'differs' END AS outcome
        FROM stored s FULL JOIN logged l ON s.aggregate_key = l.aggregate_key""",
    "reconcile_totals": _with(_LOG, _windows()) + """
        SELECT count(*) AS aggregates, sum(transaction_count)::BIGINT AS transaction_count,
          sum(total_amount_pyg)::BIGINT AS total_amount_pyg FROM windows""",
    "stage_accounting": _with(_LOG) + """
        SELECT count(*) AS records, count(*) FILTER (len(errors) > 0) AS dead_letters,
          count(*) FILTER (len(errors) = 0) AS valid,
          count(*) FILTER (len(errors) = 0 AND status = 'CONFIRMED') AS confirmed,
          count(DISTINCT CASE WHEN len(errors) = 0 AND status = 'CONFIRMED' THEN event_id END)
            AS unique_confirmed
        FROM checked""",
    "partition_offsets": _with(_LOG) + """
        SELECT 'payments.events.v1' AS topic, "partition", count(*) AS records,
          max("offset") + 1 AS end_offset FROM log GROUP BY ALL""",
    "consumer_lag": _with(_LOG) + """
        SELECT 'payments.events.v1' AS topic, l."partition", max(l."offset") + 1 AS end_offset,
          coalesce(max(c.done), 0) AS committed_offset,
          max(l."offset") + 1 - coalesce(max(c.done), 0) AS lag
        FROM log l LEFT JOIN (
          SELECT "partition", max("offset") + 1 AS done FROM confirmed GROUP BY "partition") c
          ON l."partition" = c."partition" GROUP BY ALL""",
    "stream_lag": _with(_LOG) + """,
        stop AS (SELECT max("offset") // 3 * 2 AS stopped FROM log),
        ends AS (
          SELECT "partition", max("offset") + 1 AS end_offset,
            coalesce(max("offset") FILTER ("offset" < stopped) + 1, 0) AS committed_offset FROM log, stop GROUP BY ALL)
        SELECT 'payments.events.v1' AS topic, *, end_offset - committed_offset AS lag FROM ends""",
    "log_integrity": _with(_LOG) + """,
        copied AS (
          SELECT *, event_ts - CASE WHEN "offset" % 37 = 0 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS moment,
            unnest(CASE WHEN "offset" % 31 = 0 THEN [1, 2] ELSE [1] END) AS k FROM log),
        offsets AS (SELECT "partition", "offset", count(*) AS n, min(moment) AS moment FROM copied GROUP BY ALL),
        steps AS (
          SELECT *, "offset" - lag("offset") OVER w - 1 AS skipped, moment < lag(moment) OVER w AS back
          FROM offsets WINDOW w AS (PARTITION BY "partition" ORDER BY "offset"))
        SELECT 'payments.events.v1' AS topic, "partition", sum(n)::BIGINT AS records, min("offset") AS first_offset,
          max("offset") + 1 AS end_offset, sum(n - 1)::BIGINT AS repeats, count(*) FILTER (skipped > 0) AS gaps,
          coalesce(sum(skipped), 0)::BIGINT AS missing, count(*) FILTER (back) AS inversions
        FROM steps GROUP BY ALL""",
    "strayed_keys": _with(_LOG) + """
        SELECT 'payments.events.v1' AS topic, merchant_id || '/' || "offset" % 1000 AS record_key,
          count(DISTINCT ("partition" + CASE WHEN "offset" % 3000 = 7 OR "offset" % 5000 = 1008 THEN 1 ELSE 0 END) % 3)
            AS partitions, count(*) AS records
        FROM log GROUP BY ALL HAVING partitions > 1""",
    "ordered_result": _with(_LOG, _windows()) + f"""
        SELECT row_number() OVER (ORDER BY window_start, merchant_id) - 1 AS position, {_COLUMNS} FROM windows""",
    "column_audit": _with(_LOG, _VERSIONS) + ",stored AS (SELECT * FROM numbered WHERE n = 3) " + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{t}' AS data_type, {t == 'bigint'} AS whole, count(*) AS rows,
          count(*) - count({v}) AS nulls, min({v})::VARCHAR AS least, max({v})::VARCHAR AS greatest FROM stored"""
        for c, t, v in [
            *((c, "string", c) for c in ("aggregate_key", "merchant_id", "window_start", "window_end")),
            ("transaction_count", "bigint", "transaction_count::BIGINT"),
            ("total_amount_pyg", "bigint", "total_amount_pyg::BIGINT"), ("version", "bigint", '"offset"'),
        ]
    ),
    "bounded_read": _with(_LOG) + """
        SELECT "partition", "offset", merchant_id AS record_key FROM log
        ORDER BY "partition", "offset" LIMIT 1000""",
    "record_log": _with(_LOG) + f"""
        SELECT 'payments.events.v1' AS topic, "partition", "offset",
          CASE fault WHEN 'null_value' THEN NULL WHEN 'no_object' THEN 9
            WHEN 'bad_utf8' THEN {_TEXT_LENGTH} + 1
            WHEN 'trailing_text' THEN {_TEXT_LENGTH} + 2
            WHEN 'broken_json' THEN {_TEXT_LENGTH} - 1
            ELSE {_TEXT_LENGTH} END AS value_bytes,
          merchant_id AS record_key FROM checked""",
    "generated_events": _with(_GENERATED) + """
        SELECT id, event_id, key, strftime(moment, '%Y-%m-%dT%H:%M:%S.000Z') AS event_time,
          transaction_id, account_id, amount, status FROM uuids""",
    "sown_faults": _with(_GENERATED) + """
        SELECT arrival, scenario_tag, event_id, event_time FROM sown""",
    "published_events": _with(_GENERATED) + """
        SELECT key AS record_key, '{"schema_version":1,'
            || coalesce('"event_id":"' || event_id || '",', '')
            || '"key":"' || key || '","event_time":"' || event_time
            || '","payload":{"transaction_id":"' || transaction_id || '","merchant_id":"' || key
            || '","account_id":"' || account_id || '","amount":' || amount
            || ',"currency":"PYG","status":"' || status || '"}}' AS record_value FROM sown""",
    "dlq_stream": _with(_LOG) + _LETTERS,
    "upsert_stream": _with(_LOG, _VERSIONS) + f"""
        SELECT {_COLUMNS} FROM numbered
        QUALIFY row_number() OVER (PARTITION BY aggregate_key ORDER BY "offset" DESC) = 1""",
    "upsert_resume": _with(_LOG, _VERSIONS) + f"""
        SELECT {_COLUMNS} FROM numbered
        QUALIFY row_number() OVER (PARTITION BY aggregate_key ORDER BY "offset" DESC) = 1""",
    "lateness_default": _with(_LOG) + """,
        accepted AS (
          SELECT DISTINCT event_id, merchant_id, amount, i % 180 // 60 AS minute FROM confirmed
          WHERE "offset" % 11 NOT IN (1, 2, 3, 4) OR ("offset" % 11 = 1 AND i % 180 >= 120))
        SELECT merchant_id, '2026-01-01T12:0' || minute || ':00.000Z' AS window_start,
          count(*) AS transaction_count, sum(amount)::BIGINT AS total_amount_pyg
        FROM accepted GROUP BY ALL""",
    "window_agg_stream_final": _with(_LOG, _windows("copy = 0 AND i % 53 <> 0")) + f"""
        SELECT {_COLUMNS} FROM windows""",
    "window_agg_stream_update": _with(_LOG, f"""
        parts AS (
          SELECT merchant_id || '|' || {_START} AS aggregate_key,
            count(DISTINCT i % 2) AS versions FROM confirmed WHERE copy = 0 GROUP BY ALL)""",
        _windows()) + f"""
        SELECT {_COLUMNS}, versions FROM windows JOIN parts USING (aggregate_key)""",
    "late_dropped": _with(_LOG) + """
        SELECT count(*) AS dropped FROM confirmed WHERE copy = 0 AND i % 53 = 0""",
    "job_outputs": _with(_LOG, _windows()) + f"""
        SELECT 'payments.aggregates.v1' AS topic, aggregate_key AS record_key, {_JSON} AS record_value FROM windows
        UNION ALL
        SELECT 'payments.events.dlq.v1', CASE WHEN undecoded OR fault = 'missing_id' THEN '' ELSE event_id END,
          '{{"errors":["' || array_to_string(errors, '","') || '"],"raw_data":' || {_RAW} || '}}'
        FROM checked WHERE len(errors) > 0""",
    "panes_exact": _with(_LOG) + f""",
        counted AS (
          SELECT merchant_id || '|' || {_START} AS aggregate_key, {_END} AS window_end, i % 5 = 0 AS late,
            "partition" AS p, "offset" AS o, amount FROM confirmed WHERE copy = 0 AND i % 7 <> 0),
        punctual AS (
          SELECT aggregate_key, window_end, count(*) AS n, sum(amount)::BIGINT AS total
          FROM counted WHERE NOT late GROUP BY ALL),
        in_order AS (
          SELECT aggregate_key, window_end, row_number() OVER w AS r, sum(amount) OVER w AS total
          FROM counted WHERE late WINDOW w AS (PARTITION BY aggregate_key, window_end ORDER BY p, o
            ROWS UNBOUNDED PRECEDING))
        SELECT aggregate_key, window_end, 'ON_TIME' AS timing, 0::BIGINT AS pane_index, n AS transaction_count,
          total AS total_amount_pyg FROM punctual
        UNION ALL
        SELECT aggregate_key, window_end, 'LATE', r - CASE WHEN n IS NULL THEN 1 ELSE 0 END, r + coalesce(n, 0),
          (l.total + coalesce(p.total, 0))::BIGINT
        FROM in_order AS l LEFT JOIN punctual AS p USING (aggregate_key, window_end)""",
    "dedup_stream_exact": _with(_LOG) + """
        SELECT event_id, CASE WHEN i % 10 = 0 THEN 2 ELSE 1 END::BIGINT AS passed,
          2 * i AS first_offset,
          CASE WHEN i % 10 = 0 THEN 2 * (i + 7) + 1 ELSE 2 * i END AS last_offset
        FROM confirmed WHERE copy = 0""",
}
