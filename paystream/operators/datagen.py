"""Test data as Spark jobs: valid payment events, and faults sown into them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystream.config import CURRENCY, DEFAULT, SCHEMA_VERSION, STATUSES, StreamConfig

# The ranges a generated event is drawn from.
BASE_TIME = "2026-01-01 12:00:00"
SECONDS_APART = 2
MERCHANTS = 3
ACCOUNTS = 10
AMOUNT_MIN = 1_000
AMOUNT_MAX = 500_000

EVENT_FIELDS = ["schema_version", "event_id", "key", "event_time", "payload"]


def _digest(seed: int, what: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(what), F.col("id").cast("string")))


def _draw(seed: int, what: str, choices: int) -> Column:
    """A number below ``choices`` that depends on seed, purpose and id only."""
    return F.conv(F.substring(_digest(seed, what), 1, 12), 16, 10).cast("bigint") % choices


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad((number + 1).cast("string"), 3, "0"))


def generate_events(ids: DataFrame, seed: int = 0, start: str = BASE_TIME) -> DataFrame:
    """One valid event per ``id``, in time order, the same for the same seed and start.

    Every value is a hash of seed and id, so tasks need not know of each other.
    """
    status = F.element_at(
        F.array(*(F.lit(s) for s in STATUSES)),
        (_draw(seed, "status", len(STATUSES)) + 1).cast("int"),
    )
    uuid = _digest(seed, "event")
    merchant = _numbered("merchant-", _draw(seed, "merchant", MERCHANTS))
    at = F.timestamp_micros(
        F.unix_micros(F.lit(start).cast("timestamp")) + F.col("id") * SECONDS_APART * 1_000_000
    )
    payload = F.struct(
        F.concat(F.lit("txn-"), F.substring(_digest(seed, "transaction"), 1, 16))
        .alias("transaction_id"),
        merchant.alias("merchant_id"),
        _numbered("account-", _draw(seed, "account", ACCOUNTS)).alias("account_id"),
        (_draw(seed, "amount", AMOUNT_MAX - AMOUNT_MIN + 1) + AMOUNT_MIN).alias("amount"),
        F.lit(CURRENCY).alias("currency"),
        status.alias("status"),
    )
    return ids.select(
        "id",
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.concat_ws(
            "-", uuid.substr(1, 8), uuid.substr(9, 4), F.concat(F.lit("4"), uuid.substr(14, 3)),
            F.concat(F.lit("8"), uuid.substr(18, 3)), uuid.substr(21, 12),
        ).alias("event_id"),
        merchant.alias("key"),
        _iso(at).alias("event_time"),
        payload.alias("payload"),
    )


def generate_stream(
    spark: SparkSession, count: int, seed: int = 0, start: str = BASE_TIME
) -> DataFrame:
    """``count`` valid events with ids 0 .. count - 1."""
    return generate_events(spark.range(count), seed, start)


def sow_faults(
    events: DataFrame, every: int = 10, config: StreamConfig = DEFAULT
) -> DataFrame:
    """Events with out-of-order, duplicate, late and invalid ones among them.

    Of each ``every`` ids (at least 8) one is dated back a little, one comes twice, one is dated
    back beyond all lateness and one lacks its event id. Adds ``arrival`` (the order of sending)
    and ``scenario_tag``; neither belongs to the event.
    """
    if every < 8:
        raise ValueError("there are four kinds of faults to place: every must be at least 8")
    slot = F.col("id") % every
    plan = (
        F.when(slot == 5, F.array(F.lit("out_of_order")))
        .when(slot == 2, F.array(F.lit("normal"), F.lit("duplicate")))
        .when(slot == 6, F.array(F.lit("late")))
        .when(slot == 7, F.array(F.lit("invalid")))
        .otherwise(F.array(F.lit("normal")))
    )
    back = (
        F.when(F.col("scenario_tag") == "out_of_order", 2 * SECONDS_APART + 1)
        .when(F.col("scenario_tag") == "late", config.horizon_seconds + 30)
        .otherwise(0)
    )
    at = F.col("event_time").cast("timestamp")
    shifted = F.timestamp_micros(F.unix_micros(at) - back.cast("bigint") * 1_000_000)
    return (
        events.withColumn("scenario_tag", F.explode(plan))
        .withColumn("event_time", _iso(shifted))
        .withColumn("event_id", F.when(F.col("scenario_tag") != "invalid", F.col("event_id")))
        # A copy is sent four events after its original.
        .withColumn("arrival", F.col("id") * 2 + F.when(
            F.col("scenario_tag") == "duplicate", 9).otherwise(0))
    )
