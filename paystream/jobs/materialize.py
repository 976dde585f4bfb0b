"""Aggregates log to the stored table: the second streaming job, or a bounded trial run."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from paystream.config import AGGREGATES_GROUP, AGGREGATES_TOPIC, bootstrap_servers
from paystream.session import builder, stream_session
from paystream.sources.records import kafka_source_options, read_log, read_topic
from paystream.sources.table import TABLE_NAME, create_table, materialize_next
from paystream.streaming.fast import table_writer


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="paystream.jobs.materialize", description=__doc__)
    parser.add_argument("--bootstrap-servers", help="broker; else the environment, else local")
    parser.add_argument("--topic", default=AGGREGATES_TOPIC)
    parser.add_argument("--table-path", default=f"data/{TABLE_NAME}")
    parser.add_argument("--max-messages", type=int, help="stop after so many records")
    parser.add_argument("--path", help="folder of file logs to use in place of a broker")
    parser.add_argument("--checkpoint", help="folder of the checkpoint, needed to stream")
    parser.add_argument("--per-batch", type=int, help="most records (files) of a micro-batch")
    return parser.parse_args(argv)


def run(args: argparse.Namespace) -> None:
    spark = builder("paystream-aggregates").getOrCreate()
    stream = args.max_messages is None
    if stream and not args.checkpoint:
        raise SystemExit("--checkpoint is needed to stream")
    session = stream_session(spark)
    create_table(session, args.table_path)
    if args.path:
        records = read_log(session, f"{args.path}/{args.topic}", stream, args.per_batch)
    else:
        servers = bootstrap_servers(args.bootstrap_servers)
        options = kafka_source_options(servers, args.topic, AGGREGATES_GROUP, args.per_batch)
        records = read_topic(session, options, stream)
    if not stream:
        materialize_next(records, args.table_path, args.max_messages)
        return
    table_writer(records, args.table_path, args.checkpoint).start().awaitTermination()


def main(argv: Sequence[str] | None = None) -> int:
    """0 when done or interrupted; 1 after a record that breaks the contract."""
    args = parse_args(argv)
    try:
        run(args)
    except KeyboardInterrupt:
        return 0
    except Exception as error:
        print(f"materialize: stopped, batch not committed: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
