"""The registered queries: every operator, run over the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystream.config import AGGREGATES_TOPIC, DEAD_LETTER_TOPIC, DEFAULT, EVENTS_TOPIC
from paystream.functions.digits import digits_of
from paystream.jobs import run_stream
from paystream.operators.accounting import consumer_lag, end_offsets, stage_counts
from paystream.operators.aggregate_contract import check_aggregates
from paystream.operators.contract import check_events
from paystream.operators.datagen import EVENT_FIELDS, generate_events, sow_faults
from paystream.operators.dedup import deduplicate, deduplicate_within
from paystream.operators.integrity import log_integrity, strayed_keys
from paystream.operators.latest import column_audit, latest_per_key, reconcile, totals
from paystream.operators.route import (
    confirmed,
    dead_letters,
    invalid_events,
    routed_log,
    valid_events,
)
from paystream.operators.windows import (
    aggregate_windows,
    label_windows,
    serialize_aggregates,
    to_table_types,
)
from paystream.plans.payments import (
    COPY_DELAY,
    COPY_EVERY,
    big_log,
    last_instant,
    load,
    payment_log,
    raw_payments,
    tampered_log,
)
from paystream.schemas import AGGREGATE_COLUMNS
from paystream.session import stream_session, work_dir
from paystream.sources.ordered import read_ordered, write_ordered
from paystream.sources.progress import committed_offsets
from paystream.sources.records import bounded, keyed_records, log_writer, read_log, write_log
from paystream.sources.table import (
    create_table,
    current_rows,
    materialize,
    materialize_next,
    store_versions,
    stored_versions,
)
from paystream.streaming.exact import deduplicate_exactly, pane_stream, with_event_clock
from paystream.streaming.fast import (
    PAYMENT_COLUMNS,
    aggregate_stream,
    confirmed_payments,
    dead_letter_stream,
    deduplicate_stream,
    table_writer,
)
from paystream.streaming.replay import STEP, Replay, arriving

Query = Callable[[SparkSession, str], DataFrame]

FEATURE_LIMIT = 1000
LONG_SECONDS = 400 * 86_400
TICK = "tick"


def _micros_text(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to a work table and read from there: worked out once, however often they are read."""
    path = work_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_events(payment_log(spark, sf_dir))


def _confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confirmed(valid_events(_checked(spark, sf_dir)))


def window_agg_60s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: raw log to count and total per merchant and minute."""
    return to_table_types(
        label_windows(aggregate_windows(deduplicate(_confirmed(spark, sf_dir))))
    )


def parse_outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.get("errors", F.lit(0))
    decoding = first.isin("encoding:value", "syntax:value", "type:value")
    return _checked(spark, sf_dir).groupBy(
        F.when(decoding, first).otherwise("object").alias("outcome")
    ).agg(F.count(F.lit(1)).alias("records"))


def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select(
        "offset", F.posexplode("errors").alias("position", "error")
    )


def validation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of the contract broken in some records, several at once in others."""
    return check_events(tampered_log(spark, sf_dir)).select(
        "offset", F.posexplode("errors").alias("position", "error")
    )


def dlq_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _letters(dead_letters(invalid_events(_checked(spark, sf_dir))))


def _letters(letters: DataFrame) -> DataFrame:
    value = F.col("value").cast("string")
    return letters.select(
        "source_offset",
        F.col("key").cast("string").alias("letter_key"),
        F.get_json_object(value, "$.errors").alias("errors"),
        F.get_json_object(value, "$.raw_data.payload.merchant_id").alias("raw_merchant"),
        F.length(F.get_json_object(value, "$.raw_data")).cast("bigint").alias("raw_length"),
    )


def confirmed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _confirmed(spark, sf_dir).select(
        "event_id", "transaction_id", "merchant_id", "account_id", "amount",
        _micros_text("event_ts").alias("event_ts"), "offset",
    )


def event_time_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_events(_checked(spark, sf_dir)).select(
        "offset", "event_time", _micros_text("event_ts").alias("instant")
    )


def dedup_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(_confirmed(spark, sf_dir)).select("event_id", "partition", "offset")


def dedup_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplication by time on a few ids with very many events, one of them with a third."""
    events = raw_payments(spark, sf_dir).select(
        F.when(F.col("i") % 3 == 0, "often").otherwise(F.col("account_id")).alias("event_id"),
        "event_ts", "partition", F.col("i").alias("offset"),
    )
    return deduplicate_within(events, DEFAULT.horizon_seconds).select(
        "event_id", _micros_text("event_ts").alias("event_ts"), "offset"
    )


def big_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of up to 60 digits from the raw log through windows, JSON and the check of the table."""
    payments = deduplicate(confirmed(valid_events(check_events(big_log(spark, sf_dir)))))
    log = serialize_aggregates(
        label_windows(aggregate_windows(payments)), F.lit(AGGREGATES_TOPIC).alias("topic"),
        F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
    return check_aggregates(log).select(
        "aggregate_key", "transaction_count", "error",
        F.expr(digits_of("total_amount_pyg", "total_amount_wide")).alias("total_digits"),
        F.col("value").cast("string").alias("record_value"),
    )


def big_amount_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the contract says about every amount of that log, and the dead letters' own digits."""
    bad = F.size("errors") > 0
    checked = _stored(check_events(big_log(spark, sf_dir)).select(
        "offset", "partition", "event_id", "errors", "amount", "amount_wide", F.when(bad, F.col("value")).alias("value"),
    ), "amounts")
    letters = dead_letters(invalid_events(checked)).select(
        F.col("source_offset").alias("offset"),
        F.regexp_extract(F.col("value").cast("string"), r'amount\\?":(.*?),', 1).alias("letter_amount"),
    )
    rows = checked.select(
        "offset", F.array_join("errors", ",").alias("errors"),
        F.expr(digits_of("amount", "amount_wide")).alias("digits"),
    )
    return rows.join(letters, "offset", "left")


def aggregate_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serialize_aggregates(window_agg_60s(spark, sf_dir)).select(
        F.col("key").cast("string").alias("record_key"),
        F.col("value").cast("string").alias("record_value"),
    )


def _aggregate_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregates log with three versions of each window, the later the greater."""
    rows = window_agg_60s(spark, sf_dir).withColumn(
        "n", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))
    )
    minute = F.unix_seconds(F.col("window_start").cast("timestamp")).cast("bigint") / 60
    versions = rows.withColumn("minute", minute.cast("bigint")).select(
        "aggregate_key", "merchant_id", "window_start", "window_end",
        (F.col("transaction_count") * F.col("n")).alias("transaction_count"),
        (F.col("total_amount_pyg") * F.col("n")).alias("total_amount_pyg"),
        "minute", "n",
        (F.substring("merchant_id", -1, 1).cast("int") - 1).alias("partition"),
        (F.col("minute") * 10 + F.col("n") * 2).alias("offset"),
    )
    return serialize_aggregates(
        versions, F.lit(AGGREGATES_TOPIC).alias("topic"), "partition", "offset",
        F.col("window_end").cast("timestamp").alias("timestamp"), "minute", "n",
    )


def aggregate_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first broken rule of each record of a log in which many were tampered with."""
    text = F.col("value").cast("string")

    def swap(old: str, new: str) -> Column:
        return F.regexp_replace(text, old, new).cast("binary")

    case = F.col("minute") % 16
    value = (
        F.when(case == 1, swap('"schema_version":1', '"schema_version":2'))
        .when(case == 2, swap('"schema_version":1,', ""))
        .when(case == 3, swap('"transaction_count":[0-9]+', '"transaction_count":true'))
        .when(case == 4, swap('"total_amount_pyg":[0-9]+', '"total_amount_pyg":-1'))
        .when(case == 5, swap('"key":"merchant', '"key":"Merchant'))
        .when(case == 6, swap('"window_end":"[^"]+"', '"window_end":""'))
        .when(case == 7, swap('"payload":', '"load":'))
        .when(case == 8, swap('"schema_version":1', '"schema_version":1.0'))
        .when(case == 9, F.concat("value", F.unhex(F.lit("FF"))))
        .when(case == 10, swap("[}]$", ""))
        .when(case == 11, swap('"merchant_id":"[^"]+"', '"merchant_id":5'))
        .when(case == 14, swap('"transaction_count":[0-9]+', '"transaction_count":0'))
        .when(case == 15, F.concat(F.lit("["), text, F.lit("]")).cast("binary"))
        .otherwise(F.col("value"))
    )
    key = F.when(case == 12, F.lit(None).cast("binary")).when(
        case == 13, F.lit("other").cast("binary")
    ).otherwise(F.col("key"))
    log = _aggregate_log(spark, sf_dir).withColumn("value", value).withColumn("key", key)
    return check_aggregates(log).select("partition", "offset", "error", F.when(
        F.col("error").isNull(), F.col("transaction_count")
    ).alias("transaction_count"))


def latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(check_aggregates(_aggregate_log(spark, sf_dir))).select(
        *AGGREGATE_COLUMNS, "offset"
    )


def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches into the table, the second one twice, the last one oldest."""
    log = _stored(_aggregate_log(spark, sf_dir), "log")
    path = work_dir(spark, "table")
    create_table(spark, path)
    for batch_id, n in enumerate([2, 3, 3, 1]):
        batch_id = min(batch_id, 1) if n > 1 else 2
        materialize(log.filter(F.col("n") == n), path, "upsert", batch_id)
    return current_rows(spark, path)


def upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table filled by a streaming query that reads a log in three steps."""
    log = _aggregate_log(spark, sf_dir)
    columns = ["key", "value", "topic", "partition", "offset", "timestamp"]
    replay = Replay(spark, "upsert")
    replay.run_numbered(log.select(*columns, (F.col("n") - 1).alias(STEP)), 3, table_writer)
    return current_rows(spark, replay.output)


def upsert_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table filled by bounded runs, each going on where the last one ended.

    The second run meets broken records and must leave everything as it was.
    """
    columns = ["key", "value", "topic", "partition", "offset", "timestamp"]
    log = _stored(_aggregate_log(spark, sf_dir).select(*columns), "log")
    path = work_dir(spark, "resume")
    create_table(spark, path)
    part = log.count() // 3
    materialize_next(log, path, part)
    before = stored_versions(spark, path).count()
    broken = F.when(F.col("offset") % 5 == 1, F.lit("{").cast("binary")).otherwise(F.col("value"))
    try:
        materialize_next(log.withColumn("value", broken), path, part)
    except Exception as error:
        if "syntax:value" not in str(error) or stored_versions(spark, path).count() != before:
            raise
    else:
        raise AssertionError("broken records were stored")
    materialize_next(log, path, part)
    materialize_next(log, path)
    return current_rows(spark, path)


def reconcile_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that misses some rows, has others extra and some out of date, against its log."""
    versions = _stored(check_aggregates(_aggregate_log(spark, sf_dir)).select(
        *AGGREGATE_COLUMNS, "offset", "minute", "n"
    ), "versions")
    minute = F.col("minute")
    table = latest_per_key(
        versions.filter((minute % 5 != 1) & ((minute % 5 != 2) | (F.col("n") < 3)))
    )
    log = latest_per_key(versions.filter(minute % 5 != 3))
    return reconcile(table, log, "aggregate_key", AGGREGATE_COLUMNS[1:]).select(
        "aggregate_key", "outcome"
    )


def reconcile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = totals(window_agg_60s(spark, sf_dir))
    return rows.withColumn("total_amount_pyg", F.col("total_amount_pyg").cast("bigint"))


def stage_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_counts(_checked(spark, sf_dir))


def partition_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return end_offsets(payment_log(spark, sf_dir))


def lag_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag of a reader that has got as far as the last confirmed event of each partition."""
    done = _confirmed(spark, sf_dir).groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("committed_offset")
    )
    return consumer_lag(end_offsets(payment_log(spark, sf_dir)), done)


def stream_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream still has to fetch, by its checkpoint: it fails in the third of three steps."""
    log = payment_log(spark, sf_dir)
    end = log.agg(F.max("offset").alias("end"))
    replay = Replay(spark, "lag")
    steps = [(0, "floor(end / 3)"), ("floor(end / 3)", "floor(end / 3) * 2"), ("floor(end / 3) * 2", "end + 1")]

    def store(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 2:
            raise RuntimeError("stopped midway")
        batch.write.parquet(f"{replay.output}/{batch_id}")

    try:
        replay.run(
            [log.join(F.broadcast(end), F.expr(f"offset >= {a} and offset < {b}")).drop("end") for a, b in steps],
            lambda records, _, checkpoint: confirmed_payments(records).writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint),
        )
    except StreamingQueryException as error:
        if "stopped midway" not in str(error):
            raise
    else:
        raise AssertionError("the third step did not fail")
    done = committed_offsets(spark, replay.checkpoint, replay.input)
    return consumer_lag(end_offsets(read_log(spark, replay.input)), done)


#: Offsets with a record too many, and those dated back by an hour.
REPEATED_OFFSET, DATED_BACK = 31, 37


def _faulty_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with repeated offsets and steps back in time."""
    offset = F.col("offset")
    back = F.when(offset % DATED_BACK == 0, F.expr("timestamp - INTERVAL 1 HOUR")).otherwise(F.col("timestamp"))
    log = payment_log(spark, sf_dir).withColumn("timestamp", back)
    return log.union(log.filter(offset % REPEATED_OFFSET == 0))


def integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats, gaps and inversions of each partition."""
    return log_integrity(_faulty_log(spark, sf_dir), block=4096)


def stray_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thousand keys for each merchant, of which a few have records in the next partition."""
    offset = F.col("offset")
    strays = (offset % 3000 == 7) | (offset % 5000 == 1008)
    log = payment_log(spark, sf_dir).select(
        "topic", F.concat(F.col("key").cast("string"), F.lit("/"), offset % 1000).alias("key"),
        ((F.col("partition") + strays.cast("int")) % 3).alias("partition"),
    )
    return strayed_keys(log).withColumnRenamed("key", "record_key")


def ordered_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregates by window and merchant, stored in that order and read with their positions."""
    path = work_dir(spark, "ordered")
    write_ordered(window_agg_60s(spark, sf_dir), path, ["window_start", "merchant_id"])
    return read_ordered(spark, path)


def column_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types and bounds of the stored table's columns, by its files."""
    path = work_dir(spark, "audit")
    materialize(_aggregate_log(spark, sf_dir).filter(F.col("n") == 3), path, "audit", 0)
    return column_audit(spark.read.parquet(f"{path}/run=audit/batch_id=0").drop("window_date"))


def bounded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first records of the log, as for a trial run."""
    log = bounded(payment_log(spark, sf_dir), FEATURE_LIMIT)
    return log.select("partition", "offset", F.col("key").cast("string").alias("record_key"))


def routed_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs of one parse, by topic and key."""
    log = routed_log(_checked(spark, sf_dir), EVENTS_TOPIC, DEAD_LETTER_TOPIC)
    return log.groupBy("topic", F.col("key").cast("string").alias("record_key")).agg(
        F.count(F.lit(1)).alias("records")
    )


def _generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = load(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return generate_events(ids, seed=7)


def generated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _generated(spark, sf_dir).select(
        "id", "event_id", "key", "event_time", "payload.transaction_id", "payload.account_id",
        "payload.amount", "payload.status",
    )


def published_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated events with faults, as records: key and JSON value, in sending order."""
    events = sow_faults(_generated(spark, sf_dir))
    records = keyed_records(events.select(*EVENT_FIELDS))
    return records.select(
        F.col("key").cast("string").alias("record_key"),
        F.col("value").cast("string").alias("record_value"),
    )


def sown_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sow_faults(_generated(spark, sf_dir)).select(
        "arrival", "scenario_tag", "event_id", "event_time"
    )


def record_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log written to files and read back: bytes, nulls and offsets survive."""
    path = work_dir(spark, "log")
    write_log(payment_log(spark, sf_dir), path)
    return read_log(spark, path).select(
        "topic", "partition", "offset", F.length("value").cast("bigint").alias("value_bytes"),
        F.col("key").cast("string").alias("record_key"),
    )


# --- streams --------------------------------------------------------------------------------


def _late() -> Column:
    """The records that are held back until long after their windows have closed."""
    source = F.floor(F.col("offset") / 2) - F.col("offset") % 2 * COPY_DELAY
    return source % 53 == 0


def _tick_record(spark: SparkSession, sf_dir: str, seconds: int) -> DataFrame:
    """A valid event of a merchant of its own, some time after all others: moves the clock."""
    end = last_instant(spark, sf_dir).select(
        F.timestamp_micros(F.unix_micros("event_ts") + seconds * 1_000_000).alias("ts")
    )
    text = F.concat(
        F.lit('{"schema_version":1,"event_id":"tick-'), F.lit(str(seconds)),
        F.lit(f'","key":"{TICK}","event_time":"'), _micros_text("ts"),
        F.lit(f'","payload":{{"transaction_id":"tick","merchant_id":"{TICK}",'
              '"account_id":"tick","amount":1,"currency":"PYG","status":"CONFIRMED"}}'),
    )
    return end.select(
        F.lit(TICK).cast("binary").alias("key"), text.cast("binary").alias("value"),
        F.lit(EVENTS_TOPIC).alias("topic"), F.lit(0).alias("partition"),
        F.lit(2**62 + seconds).alias("offset"), F.col("ts").alias("timestamp"),
    )


def _run_late_log(spark: SparkSession, sf_dir: str) -> Replay:
    """Raw log without the late records, then a tick, then the late records and their copies."""
    log = payment_log(spark, sf_dir)
    late = _late()
    replay = Replay(spark, "windows")
    steps = arriving(log, {0: ~late, 2: late}).unionByName(_tick_record(spark, sf_dir, 600).withColumn(STEP, F.lit(1)))
    replay.run_numbered(
        steps, 3,
        lambda stream, out, checkpoint: log_writer(
            to_table_types(aggregate_stream(stream)), out, checkpoint
        ),
    )
    return replay


def window_agg_stream_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship as a stream with one final row per window; too late records change nothing."""
    replay = _run_late_log(spark, sf_dir)
    return spark.read.parquet(replay.output).filter(F.col("merchant_id") != TICK)


def late_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many confirmed payments were turned away: those of the log less those in a window."""
    written = spark.read.parquet(_run_late_log(spark, sf_dir).output)
    counted = written.filter(F.col("merchant_id") != TICK).select((-F.col("transaction_count")).alias("n"))
    known = _confirmed(spark, sf_dir).agg(F.count_distinct("event_id").alias("n"))
    return known.union(counted).agg(F.sum("n").alias("dropped"))


def lateness_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default settings at the limit of lateness, with all payments and copies in three minutes.

    The clock then stands 119, 120, 121 and 170 seconds after the last window, and at each point
    some payments of all three windows arrive. Only those of the last window at 119 count.
    """
    source = F.floor(F.col("offset") / 2) - F.col("offset") % 2 * COPY_DELAY
    start = F.lit("2026-01-01 12:00:00").cast("timestamp")

    def at(seconds: Column) -> Column:
        return F.timestamp_micros(F.unix_micros(start) + seconds.cast("long") * 1_000_000)

    rows = _payments(spark, sf_dir).withColumn("event_ts", at(source % 180))

    rest = F.col("offset") % 11
    steps = arriving(rows, {0: ~rest.isin(1, 2, 3, 4), **{2 * n: rest == n for n in (1, 2, 3, 4)}})
    for number, after in enumerate((119, 120, 121, 170, 600)):
        tick = _tick(spark.range(1).select(at(F.lit(180)).alias("event_ts")), after)
        steps = steps.unionByName(tick.withColumn(STEP, F.lit(2 * number + 1)))
    replay = Replay(spark, "lateness")
    replay.run_numbered(
        steps, 10,
        lambda stream, out, checkpoint: log_writer(
            to_table_types(label_windows(aggregate_windows(deduplicate_stream(stream)))), out, checkpoint
        ),
    )
    return spark.read.parquet(replay.output).filter(F.col("merchant_id") != TICK).select(
        "merchant_id", "window_start", "transaction_count", "total_amount_pyg"
    )


def window_agg_stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream in update mode: accumulating versions into the table, the last one counts.

    Two steps with half of the log each, so most windows get two versions.
    """
    log = payment_log(spark, sf_dir)
    replay = Replay(spark, "updates")
    config = replace(DEFAULT, lateness_seconds=LONG_SECONDS)

    def start(stream: DataFrame, out: str, checkpoint: str):
        def store(batch: DataFrame, batch_id: int) -> None:
            rows = batch.withColumn("version", F.lit(batch_id).cast("bigint"))
            store_versions(rows, out, "updates", batch_id)

        return (
            to_table_types(aggregate_stream(stream, config)).writeStream.outputMode("update")
            .foreachBatch(store).option("checkpointLocation", checkpoint)
        )

    half = F.floor(F.col("offset") / 2) % 2
    replay.run_numbered(arriving(log, {rest: half == rest for rest in (0, 1)}), 2, start)
    many = stored_versions(spark, replay.output).groupBy("aggregate_key").agg(
        F.count(F.lit(1)).alias("versions")
    )
    return current_rows(spark, replay.output).join(many, "aggregate_key")


def dlq_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters written by a stream."""
    replay = Replay(spark, "letters")
    replay.run(
        [payment_log(spark, sf_dir)],
        lambda stream, out, checkpoint: log_writer(dead_letter_stream(stream), out, checkpoint),
    )
    return _letters(spark.read.parquet(replay.output))


def job_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both logs the streaming job writes, whole, with the job stopped between its sinks.

    First only the query that parses gets to run; then the job starts again on its checkpoint and
    must write each window and each dead letter once.
    """
    base = work_dir(spark, "job")
    session = stream_session(spark)
    args = run_stream.parse_args(["--path", f"{base}/logs", "--checkpoint", f"{base}/checkpoint"])
    logs = run_stream.Logs(session, args)
    write_log(payment_log(spark, sf_dir), f"{base}/logs/{EVENTS_TOPIC}")
    routing = run_stream.start_routing(logs, args)
    routing.processAllAvailable()
    routing.stop()
    queries = run_stream.start_streams(logs, args)
    for step in range(2):
        for running in queries:
            running.processAllAvailable()
        if not step:
            write_log(_tick_record(spark, sf_dir, 86_400).coalesce(1), f"{base}/logs/{EVENTS_TOPIC}")
    for running in queries:
        running.stop()
    key, value = (F.col(c).cast("string").alias(f"record_{c}") for c in ("key", "value"))
    windows, letters = (read_log(spark, f"{base}/logs/{t}") for t in (AGGREGATES_TOPIC, DEAD_LETTER_TOPIC))
    return windows.union(letters).select("topic", key, value)


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _confirmed(spark, sf_dir).select(*PAYMENT_COLUMNS)


def _tick(last: DataFrame, seconds: int) -> DataFrame:
    """A payment of a merchant of its own, some time after the ``event_ts`` of ``last``."""
    return last.select(
        F.timestamp_micros(F.unix_micros("event_ts") + seconds * 1_000_000).alias("event_ts")
    ).select(
        F.lit(f"{TICK}-{seconds}").alias("event_id"), "event_ts",
        F.lit(TICK).alias("merchant_id"), F.lit(1).cast("bigint").alias("amount"),
        F.lit(None).cast("string").alias("amount_wide"), F.lit(0).alias("partition"), F.lit(2**62 + seconds).alias("offset"),
    )


def panes_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every on-time and late pane from the raw log; a lateness as long as the table.

    Steps: most payments; a tick that closes all windows; payments that are late but accepted,
    with their copies; those copies and a tenth of the first payments once more, which must not
    give panes; a tick that ends the lateness; payments that are too late, and all copies.
    """
    config = replace(DEFAULT, lateness_seconds=LONG_SECONDS)
    log = payment_log(spark, sf_dir)
    copy = F.col("offset") % 2 == 1
    source = F.floor(F.col("offset") / 2) - F.col("offset") % 2 * COPY_DELAY
    late = source % 5 == 0
    too_late = source % 7 == 0
    replay = Replay(spark, "panes")
    replay.run(
        [
            log.filter(~late & ~too_late),
            _tick_record(spark, sf_dir, 86_400),
            log.filter(late & ~too_late),
            log.filter((copy | (source % COPY_EVERY == 1)) & ~too_late),
            _tick_record(spark, sf_dir, 86_400 + 2 * LONG_SECONDS),
            log.filter(too_late | copy),
        ],
        lambda stream, out, checkpoint: log_writer(pane_stream(stream, config), out, checkpoint),
    )
    return spark.read.parquet(replay.output).filter(F.col("merchant_id") != TICK).select(
        "aggregate_key", "window_end", "timing", "pane_index", "transaction_count",
        F.col("total_amount_pyg").cast("bigint").alias("total_amount_pyg"),
    )


def dedup_stream_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each id passes: copies within the horizon do not, those after it do again."""
    config = replace(DEFAULT, window_seconds=60, lateness_seconds=LONG_SECONDS)
    rows = _payments(spark, sf_dir)
    original = F.col("offset") % 2 == 0
    replay = Replay(spark, "dedup")
    steps = arriving(rows, {0: original, 1: ~original, 3: ~original}).unionByName(
        _tick(last_instant(spark, sf_dir), 2 * LONG_SECONDS).withColumn(STEP, F.lit(2))
    )
    replay.run_numbered(
        steps, 4,
        lambda stream, out, checkpoint: log_writer(
            deduplicate_exactly(with_event_clock(stream), config), out, checkpoint
        ),
    )
    return (
        spark.read.parquet(replay.output).filter(F.col("merchant_id") != TICK)
        .groupBy("event_id").agg(
            F.count(F.lit(1)).alias("passed"), F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
        )
    )


QUERIES: dict[str, Query] = {
    "window_agg_60s": window_agg_60s,
    "parse_outcome_counts": parse_outcome_counts,
    "validation_errors": validation_errors,
    "validation_rules": validation_rules,
    "dlq_records": dlq_records,
    "confirmed_events": confirmed_events,
    "event_time_offsets": event_time_offsets,
    "routed_topics": routed_topics,
    "dedup_global": dedup_global,
    "dedup_horizon": dedup_horizon,
    "big_amounts": big_amounts,
    "big_amount_errors": big_amount_errors,
    "aggregate_json": aggregate_json,
    "aggregate_validation": aggregate_validation,
    "latest_per_key": latest_versions,
    "upsert_table": upsert_table,
    "reconcile": reconcile_versions,
    "reconcile_totals": reconcile_totals,
    "stage_accounting": stage_accounting,
    "partition_offsets": partition_offsets,
    "consumer_lag": lag_per_partition,
    "stream_lag": stream_lag,
    "log_integrity": integrity,
    "strayed_keys": stray_keys,
    "ordered_result": ordered_result,
    "column_audit": column_facts,
    "bounded_read": bounded_read,
    "record_log": record_log,
    "generated_events": generated_events,
    "sown_faults": sown_faults,
    "published_events": published_events,
    "dlq_stream": dlq_stream,
    "upsert_stream": upsert_stream,
    "upsert_resume": upsert_resume,
    "lateness_default": lateness_default,
    "window_agg_stream_final": window_agg_stream_final,
    "window_agg_stream_update": window_agg_stream_update,
    "late_dropped": late_dropped,
    "job_outputs": job_outputs,
    "panes_exact": panes_exact,
    "dedup_stream_exact": dedup_stream_exact,
}
