"""Batch deduplication: once per id, or once per id and horizon."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paystream.session import ensure_checkpoint_dir

ARRIVAL = ("partition", "offset")
SECOND = 1_000_000
SALTS = 64


def first_per(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ARRIVAL
) -> DataFrame:
    """The first row of each key in the given order.

    Spark plans ``row_number() = 1`` with a group limit on both sides of the shuffle: every task
    sends at most one row per key, so a key with a huge number of copies stays harmless.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return frame.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def deduplicate(events: DataFrame, key: str = "event_id") -> DataFrame:
    """First arrival per id, all others dropped (no horizon)."""
    return first_per(events, [key])


def _second_of(micros: str) -> Column:
    return F.col(micros) - F.pmod(F.col(micros), F.lit(SECOND).cast("long"))


def _sessions(points: DataFrame, key: str, horizon: int) -> DataFrame:
    """Runs of times of one id in which no gap reaches the horizon, as ``(first, last)``.

    Whatever came before, the first time of a run is kept: the last kept one is a horizon back.
    Two times in one cell of horizon length are always in the same run, so runs are found on one
    row per id and cell, of which an id has at most its time span divided by the horizon.
    """
    cells = points.groupBy(key, "cell").agg(
        F.min("t").alias("low"), F.max("t").alias("high")
    )
    by_time = Window.partitionBy(key).orderBy("cell")
    starts = F.coalesce(F.col("low") - F.lag("high").over(by_time) >= horizon, F.lit(True))
    return (
        cells.withColumn("starts", starts)
        .withColumn("run", F.sum(F.col("starts").cast("long")).over(by_time))
        .withColumn("first", F.min("low").over(Window.partitionBy(key, "run")))
        .withColumn("last", F.max("high").over(Window.partitionBy(key, "run")))
    )


def _successors(points: DataFrame, key: str, horizon: int) -> DataFrame:
    """For each time of an id the first one at least a horizon later: ``(key, t, next)``.

    Looked up in two steps, so that no task holds all times of an id: first among the times in
    the same second as ``t + horizon`` (times are whole microseconds, so there are at most a
    million), then, if that second has none, the start of the next second that has one.
    """
    rows = points.select(
        key, F.col("t").alias("at"), F.lit(None).cast("long").alias("origin"),
        F.col("t").alias("row_t"),
    )
    probes = points.select(
        key, (F.col("t") + horizon).alias("at"), F.col("t").alias("origin"),
        F.lit(None).cast("long").alias("row_t"),
    )
    both = rows.unionByName(probes).withColumn("sec", _second_of("at"))
    # From late to early, the last row seen is the nearest one at or after the probe; the frame
    # includes rows with the same time.
    inside = (
        Window.partitionBy(key, "sec").orderBy(F.col("at").desc())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    near = both.withColumn("near", F.min("row_t").over(inside))
    seconds = both.groupBy(key, "sec").agg(F.min("row_t").alias("start"))
    later = (
        Window.partitionBy(key).orderBy(F.col("sec").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    beyond = seconds.withColumn("beyond", F.last("start", ignorenulls=True).over(later)).drop(
        "start"
    )
    return (
        near.filter("origin IS NOT NULL")
        .join(beyond, [key, "sec"])
        .select(key, F.col("origin").alias("t"), F.coalesce("near", "beyond").alias("next"))
        .filter("next IS NOT NULL")
    )


def deduplicate_within(
    events: DataFrame, horizon_seconds: int, key: str = "event_id", ts: str = "event_ts"
) -> DataFrame:
    """Deduplicate with a bounded memory, in event-time order, on a table.

    Per id the earliest event is kept, and after a kept event the next one that is at least the
    horizon later. A dropped event does not prolong the horizon.

    The kept events of an id form a chain. Runs shorter than the horizon, nearly all in practice,
    keep just their first event. In longer runs the chain is followed by pointer doubling: after
    n rounds 2**n links are known, so a run over a year takes 18 rounds, each a join on unique
    keys. Copies with equal id and time are merged before anything else.
    """
    ensure_checkpoint_dir(events.sparkSession)
    horizon = horizon_seconds * 1_000_000
    timed = events.withColumn("_t", F.unix_micros(ts))
    points = timed.select(key, F.col("_t").alias("t")).distinct().withColumn(
        "cell", F.col("t") - F.pmod(F.col("t"), F.lit(horizon))
    ).checkpoint()
    runs = _sessions(points, key, horizon).checkpoint()
    kept = runs.filter("low = first").select(key, F.col("first").alias("t"))

    long_cells = runs.filter(F.col("last") - F.col("first") >= horizon)
    if not long_cells.isEmpty():
        # Salted by second, as one cell of one id may hold a large part of all times.
        salt = F.pmod(F.expr(f"t div {SECOND}"), F.lit(SALTS))
        members = points.withColumn("salt", salt).join(
            long_cells.select(
                key, "cell", "run",
                F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"),
            ),
            [key, "cell", "salt"],
        )
        # Ids are told apart by run from here on: a chain never leaves its run.
        members = members.select(F.struct(key, "run").alias("chain"), "t")
        links = _successors(members, "chain", horizon)
        reached = long_cells.filter("low = first").select(
            F.struct(key, "run").alias("chain"), F.col("first").alias("t")
        )
        # Only starts and targets of links can be on a chain.
        nodes = reached.unionByName(links.select("chain", F.col("next").alias("t"))).distinct()
        links = links.join(nodes, ["chain", "t"], "left_semi").checkpoint()
        reached = reached.checkpoint()
        while True:
            ahead = links.select("chain", F.col("t").alias("next"), F.col("next").alias("after"))
            new = reached.join(links, ["chain", "t"]).select("chain", F.col("next").alias("t"))
            new = new.checkpoint()
            if new.isEmpty():
                break
            reached = reached.unionByName(new)
            links = links.join(ahead, ["chain", "next"]).select(
                "chain", "t", F.col("after").alias("next")
            ).checkpoint()
        kept = kept.unionByName(
            reached.select(F.col(f"chain.{key}").alias(key), "t")
        ).distinct()
    # Both sides end up partitioned by id and time, so the join adds no shuffle of the events.
    return (
        first_per(timed, [key, "_t"])
        .join(kept.withColumnRenamed("t", "_t"), [key, "_t"], "left_semi")
        .select(*events.columns)
    )
