"""Raw events to window rows and dead letters: the streaming job, or a bounded trial run."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from paystream.config import (
    AGGREGATES_TOPIC,
    DEAD_LETTER_TOPIC,
    EVENTS_GROUP,
    EVENTS_TOPIC,
    bootstrap_servers,
)
from paystream.operators.dedup import deduplicate
from paystream.operators.windows import aggregate_windows, label_windows, serialize_aggregates
from paystream.session import builder, stream_session, work_dir
from paystream.sources.records import (
    bounded,
    kafka_source_options,
    log_writer,
    read_log,
    read_topic,
    stamped,
    topic_writer,
    write_log,
    write_topic,
)
from paystream.sources.routed import read_letters, read_payments, route_writer, write_routed
from paystream.streaming.exact import pane_payments
from paystream.streaming.fast import aggregate_payments


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="paystream.jobs.run_stream", description=__doc__)
    parser.add_argument("--bootstrap-servers", help="broker; else the environment, else local")
    parser.add_argument("--input-topic", default=EVENTS_TOPIC)
    parser.add_argument("--aggregates-topic", default=AGGREGATES_TOPIC)
    parser.add_argument("--dlq-topic", default=DEAD_LETTER_TOPIC)
    parser.add_argument("--max-num-records", type=int, help="stop after so many records")
    parser.add_argument("--path", help="folder of file logs to use in place of a broker")
    parser.add_argument("--checkpoint", help="folder of the checkpoints, needed to stream")
    parser.add_argument("--exact", action="store_true", help="publish each pane of each window")
    parser.add_argument("--state-partitions", type=int, help="fixed for a checkpoint's life")
    parser.add_argument("--per-batch", type=int, help="most records (files) parsed in a micro-batch")
    parser.add_argument("--bytes-per-batch", help="most parsed bytes counted in a micro-batch, as 2g")
    return parser.parse_args(argv)


@dataclass
class Logs:
    """Where the job reads and writes: topics of a broker, or folders below a path."""

    spark: SparkSession
    args: argparse.Namespace

    @property
    def servers(self) -> str:
        return bootstrap_servers(self.args.bootstrap_servers)

    def read(self, topic: str, stream: bool, group: str) -> DataFrame:
        if self.args.path:
            return read_log(self.spark, f"{self.args.path}/{topic}", stream, self.args.per_batch)
        options = kafka_source_options(self.servers, topic, group, self.args.per_batch)
        return read_topic(self.spark, options, stream)

    def write(self, records: DataFrame, topic: str) -> None:
        if self.args.path:
            write_log(stamped(records, topic), f"{self.args.path}/{topic}")
        else:
            write_topic(records, self.servers, topic)

    def writer(self, records: DataFrame, topic: str):
        checkpoint = f"{self.args.checkpoint}/{topic}"
        if self.args.path:
            return log_writer(stamped(records, topic), f"{self.args.path}/{topic}", checkpoint)
        return topic_writer(records.select("key", "value"), self.servers, checkpoint, topic)


def run_bounded(logs: Logs, args: argparse.Namespace) -> None:
    """A finite run closes all its windows, so it is the batch form of the same operators."""
    records = bounded(logs.read(args.input_topic, False, EVENTS_GROUP), args.max_num_records)
    path = work_dir(logs.spark, "routed")
    write_routed(records, path)
    windows = label_windows(aggregate_windows(deduplicate(read_payments(logs.spark, path))))
    logs.write(serialize_aggregates(windows), args.aggregates_topic)
    logs.write(read_letters(logs.spark, path), args.dlq_topic)


def start_routing(logs: Logs, args: argparse.Namespace):
    """The query that reads and parses the topic, alone; it goes on from its own checkpoint."""
    records = logs.read(args.input_topic, True, EVENTS_GROUP)
    return route_writer(records, f"{args.checkpoint}/routed", f"{args.checkpoint}/route").start()


def start_streams(logs: Logs, args: argparse.Namespace) -> list:
    """One query reads and parses the topic; one for each output goes on from there.

    What the first one has committed both others will read, exactly once, however often any of
    them is stopped; none waits for another.
    """
    path = f"{args.checkpoint}/routed"
    first = start_routing(logs, args)
    payments = read_payments(logs.spark, path, True, args.bytes_per_batch)
    if args.exact:
        rows = serialize_aggregates(pane_payments(payments), "pane_index")
    else:
        rows = serialize_aggregates(aggregate_payments(payments))
    letters = read_letters(logs.spark, path, True, args.bytes_per_batch)
    return [
        first,
        logs.writer(rows, args.aggregates_topic).start(),
        logs.writer(letters, args.dlq_topic).start(),
    ]


def main(argv: Sequence[str] | None = None) -> int:
    args = parse_args(argv)
    spark = builder("paystream-events").getOrCreate()
    if args.max_num_records is not None:
        run_bounded(Logs(spark, args), args)
        return 0
    if not args.checkpoint:
        raise SystemExit("--checkpoint is needed to stream")
    session = stream_session(spark, args.state_partitions)
    start_streams(Logs(session, args), args)
    session.streams.awaitAnyTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
