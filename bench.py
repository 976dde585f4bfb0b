"""Time the headline queries and print one line of JSON.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_EVENTS`` the number of
generated events for the throughput figure.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from paystream.operators.contract import check_events
from paystream.operators.datagen import EVENT_FIELDS, generate_stream
from paystream.operators.dedup import deduplicate
from paystream.operators.route import confirmed, valid_events
from paystream.operators.windows import aggregate_windows, label_windows, to_table_types
from paystream.plans.queries import QUERIES
from paystream.session import builder, work_dir
from paystream.sources.records import keyed_records

HEADLINE = [
    "window_agg_60s", "validation_errors", "dlq_records", "dedup_global", "dedup_horizon",
    "aggregate_json", "aggregate_validation", "latest_per_key", "reconcile", "stage_accounting",
    "upsert_table", "generated_events", "window_agg_stream_final", "panes_exact",
]


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def throughput(spark, events: int) -> dict[str, float]:
    """Records per second of the flagship on a log of generated events."""
    log = work_dir(spark, "bench-log")
    start = time.perf_counter()
    (
        keyed_records(generate_stream(spark, events).select(*EVENT_FIELDS))
        .selectExpr("key", "value", "'t' AS topic", "0 AS partition",
                    "monotonically_increasing_id() AS offset", "timestamp '2026-01-01' timestamp")
        .write.parquet(log)
    )
    generated = time.perf_counter() - start
    records = spark.read.parquet(log)
    start = time.perf_counter()
    payments = deduplicate(confirmed(valid_events(check_events(records))))
    run(to_table_types(label_windows(aggregate_windows(payments))))
    return {
        "generated_events_per_sec": round(events / generated),
        "flagship_records_per_sec": round(events / (time.perf_counter() - start)),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("paystream-bench").master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="paystream-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    run(QUERIES["window_agg_60s"](spark, sf_dir))
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - start, 3)
    rates = throughput(spark, int(os.environ.get("BENCH_EVENTS", "2000000")))
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), **rates,
    }))


if __name__ == "__main__":
    main()
