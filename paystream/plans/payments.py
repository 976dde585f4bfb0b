"""The payment log derived from the ``events`` table, with faults and copies.

Every event becomes one JSON record, every tenth a second, later copy. Which records are broken,
and how, follows from the event id, so that expected results can be worked out without parsing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystream.config import EVENTS_TOPIC
from paystream.session import configure

# Divisor of the event id -> fault; the first that divides counts.
FAULTS = {
    101: "bad_utf8",
    103: "no_object",
    107: "trailing_text",
    97: "missing_id",
    89: "broken_json",
    83: "wrong_currency",
    79: "float_amount",
    73: "bool_amount",
    71: "naive_time",
    67: "key_mismatch",
    61: "two_errors",
    59: "null_value",
}
COPY_EVERY = 10
COPY_DELAY = 7
ORIGIN = "2024-01-01 00:00:00"
ZONES = {0: ("Z", 0), 1: ("+00:00", 0), 2: ("-03:00", -180), 3: ("+05:30", 330)}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def _event_ts() -> Column:
    """Times are compressed sixtyfold, as the table has only about one event per minute and user."""
    origin = f"unix_micros(timestamp '{ORIGIN}')"
    return F.timestamp_micros(F.expr(f"{origin} + (unix_micros(cast(ts as timestamp)) - {origin}) div 60"))


def last_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest ``event_ts``, one row; only the times are read."""
    return load(spark, sf_dir, "events").agg(F.max(_event_ts()).alias("event_ts"))


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with the values of a payment: no faults, no copies."""
    i = F.col("event_id")
    status = (
        F.when(F.col("event_type") == "view", "PENDING")
        .when(F.col("event_type") == "error", "DECLINED")
        .otherwise("CONFIRMED")
    )
    fault = F.lit(None).cast("string")
    for divisor, name in reversed(FAULTS.items()):
        fault = F.when(i % divisor == 0, name).otherwise(fault)
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    events = load(spark, sf_dir, "events").select(*columns)
    # A file of one row group is read by one task; a topic would have been read by many.
    events = events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id")
    return events.select(
        i.alias("i"),
        F.concat(F.lit("evt-"), i).alias("event_id"),
        _event_ts().alias("event_ts"),
        F.concat(F.lit("merchant-"), F.lpad((F.col("user_id") % 3 + 1).cast("string"), 3, "0"))
        .alias("merchant_id"),
        F.concat(F.lit("account-"), F.lpad((F.col("user_id") % 10 + 1).cast("string"), 3, "0"))
        .alias("account_id"),
        F.round(F.col("value") * 100).cast("bigint").alias("amount"),
        status.alias("status"),
        fault.alias("fault"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
    )


def _time_text() -> Column:
    text = F.lit(None).cast("string")
    for rest, (zone, minutes) in ZONES.items():
        local = F.timestamp_micros(F.unix_micros("event_ts") + minutes * 60_000_000)
        clock = F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        text = F.when(F.col("i") % 4 == rest, F.concat(clock, F.lit(zone))).otherwise(text)
    return F.when(
        F.col("fault") == "naive_time", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    ).otherwise(text)


def _json_text() -> Column:
    fault = F.col("fault")

    def case(name: str, then: str | Column, otherwise: str | Column) -> Column:
        return F.when(F.coalesce(fault == name, F.lit(False)), then).otherwise(otherwise)

    two = F.coalesce(fault == "two_errors", F.lit(False))
    wrong = two | F.coalesce(fault == "wrong_currency", F.lit(False))
    return F.concat(
        F.lit('{"schema_version":1'),
        case("missing_id", F.lit(""), F.concat(F.lit(',"event_id":"'), "event_id", F.lit('"'))),
        F.lit(',"key":"'), case("key_mismatch", F.lit("merchant-999"), F.col("merchant_id")),
        F.lit('","event_time":"'), F.col("event_time"),
        F.lit('","payload":{"transaction_id":"txn-'), F.col("i"),
        F.lit('","merchant_id":"'), F.col("merchant_id"),
        F.lit('","account_id":"'), F.col("account_id"),
        F.lit('","amount":'),
        case("float_amount", F.concat(F.col("amount"), F.lit(".5")),
             case("bool_amount", F.lit("true"), F.col("amount").cast("string"))),
        F.lit(',"currency":"'), F.when(wrong, "USD").otherwise("PYG"),
        F.lit('","status":"'), F.when(two, "REFUNDED").otherwise(F.col("status")),
        F.lit('"}}'),
    )


#: What is done to the text of an event, by its number modulo ``TAMPER_EVERY``: pattern and
#: replacement pairs, and the errors that must follow, before and after those of the amount.
TAMPER_EVERY = 24
TAMPERED = {
    1: ([('"schema_version":1,', "")], ["missing:schema_version"], []),
    2: ([('"schema_version":1', '"schema_version":true')], ["type:schema_version"], []),
    3: ([('"schema_version":1', '"schema_version":1.0')], ["type:schema_version"], []),
    4: ([('"schema_version":1', '"schema_version":2')], ["unsupported:schema_version"], []),
    5: ([('"key":"[^"]*",', "")], ["missing:key"], []),
    6: ([('"key":"[^"]*"', '"key":""')], ["invalid:key"], []),
    7: ([('"key":"[^"]*"', '"key":5')], ["invalid:key"], []),
    8: ([('"event_time":"[^"]*",', "")], ["missing:event_time"], []),
    9: ([('"event_time":"[^"]*"', '"event_time":5')], ["type:event_time"], []),
    10: ([('"event_time":"[^"]*"', '"event_time":"yesterday"')], ["unparseable:event_time"], []),
    11: ([(',"payload":.*$', "}")], ["missing:payload"], None),
    12: ([('"payload":.*$', '"payload":["]"]}')], ["type:payload"], None),
    13: ([('"transaction_id":"[^"]*",', "")], ["missing:payload.transaction_id"], []),
    14: ([('"transaction_id":"[^"]*"', '"transaction_id":""')], ["invalid:payload.transaction_id"], []),
    15: ([('"merchant_id":"[^"]*"', '"merchant_id":""')], ["invalid:payload.merchant_id"], []),
    16: ([('"merchant_id":"[^"]*",', "")], ["missing:payload.merchant_id"], []),
    17: ([('"account_id":"[^"]*"', '"account_id":null')], ["invalid:payload.account_id"], []),
    18: ([('"account_id":"[^"]*",', "")], ["missing:payload.account_id"], []),
    19: ([('"event_id":"[^"]*"', '"event_id":""'), (',"status":"[^"]*"', "")], ["invalid:event_id"],
         ["missing:payload.status"]),
    20: ([('"schema_version":1', '"schema_version":"1"'), ('"key":"[^"]*"', '"key":[]'),
          ('"account_id":"[^"]*"', '"account_id":{}'), ('"currency":"PYG"', '"currency":"pyg"')],
         ["type:schema_version", "invalid:key", "invalid:payload.account_id"], ["invalid:payload.currency"]),
    21: ([("^[{]", '{"tags":["]",[{}]],')], [], []),
    22: ([("^[{]", '{"ratio":NaN,"limit":-Infinity,')], [], []),
    23: ([('"amount":-?[0-9]+,', "")], ["missing:payload.amount"], None),
}


#: How the amount of an event is written, by its number modulo ``BIG_EVERY``: 64 bits and one
#: more, 30 and 60 digits, a negative one, a leading zero, a fraction, text. ``#`` stands for the
#: number, filled up with the digit after it to the length after that.
BIG_EVERY = 8
BIG = {
    1: "9223372036854775808", 2: "1#7:29", 3: "9#8:59", 4: "-1#7:29", 5: "0#1:9", 6: "1#7:29.0", 7: '"1#7:29"',
}
BIG_ERRORS = {4: "range:payload.amount", 5: "syntax:value", 6: "type:payload.amount", 7: "type:payload.amount"}


def big_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every payment as a sound record whose amount is written in one of the ways of ``BIG``."""
    written = F.col("amount").cast("string")
    for rest, pattern in BIG.items():
        before, _, after = pattern.partition("#")
        text = F.lit(pattern)
        if after:
            digit, length = after[0], int("".join(c for c in after[2:].partition(".")[0] if c.isdigit()))
            text = F.concat(
                F.lit(before), F.lpad(F.col("i").cast("string"), length, digit), F.lit(after[2 + len(str(length)):])
            )
        written = F.when(F.col("i") % BIG_EVERY == rest, text).otherwise(written)
    payments = raw_payments(spark, sf_dir).withColumn("written", written)
    return _records(payments, lambda text: F.replace(text, F.lit('"amount":0'), F.concat(F.lit('"amount":'), "written")), F.lit(0))


def tampered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every payment as a record that is sound but for one kind of tampering; none for a rest of 0."""
    def tampered(plain: Column) -> Column:
        text = plain
        for rest, (changes, _, _) in TAMPERED.items():
            other = plain
            for pattern, new in changes:
                other = F.regexp_replace(other, pattern, new)
            text = F.when(F.col("i") % TAMPER_EVERY == rest, other).otherwise(text)
        return text

    return _records(raw_payments(spark, sf_dir), tampered, F.col("amount"))


def _records(payments: DataFrame, change: Callable[[Column], Column], amount: Column) -> DataFrame:
    """Payments as records, after a change to the JSON text."""
    clock = F.concat(F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    payload = F.struct(
        F.concat(F.lit("txn-"), F.col("i")).alias("transaction_id"), "merchant_id", "account_id", amount.alias("amount"),
        F.lit("PYG").alias("currency"), "status",
    )
    event = F.struct(
        F.lit(1).alias("schema_version"), "event_id", F.col("merchant_id").alias("key"),
        clock.alias("event_time"), payload.alias("payload"),
    )
    return payments.select(
        F.col("merchant_id").cast("binary").alias("key"), change(F.to_json(event)).cast("binary").alias("value"),
        F.lit(EVENTS_TOPIC).alias("topic"), "partition", F.col("i").cast("long").alias("offset"),
        F.col("event_ts").alias("timestamp"),
    )


def payment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log: records as a topic holds them."""
    text = F.col("text")
    value = (
        F.when(F.col("fault") == "null_value", F.lit(None).cast("binary"))
        .when(F.col("fault") == "bad_utf8", F.concat(text.cast("binary"), F.unhex(F.lit("FF"))))
        .when(F.col("fault") == "no_object", F.lit("[1, 2, 3]").cast("binary"))
        .when(F.col("fault") == "trailing_text", F.concat(text, F.lit(" x")).cast("binary"))
        .when(F.col("fault") == "broken_json", F.expr("substring(text, 1, length(text) - 1)")
              .cast("binary"))
        .otherwise(text.cast("binary"))
    )
    return (
        raw_payments(spark, sf_dir)
        .withColumn("event_time", _time_text())
        .withColumn("text", _json_text())
        .withColumn("copy", F.explode(F.when(
            F.col("i") % COPY_EVERY == 0, F.array(F.lit(0), F.lit(1))
        ).otherwise(F.array(F.lit(0)))))
        .select(
            F.col("merchant_id").cast("binary").alias("key"),
            value.alias("value"),
            F.lit(EVENTS_TOPIC).alias("topic"),
            "partition",
            ((F.col("i") + F.col("copy") * COPY_DELAY) * 2 + F.col("copy")).alias("offset"),
            F.col("event_ts").alias("timestamp"),
        )
    )
