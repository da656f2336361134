"""Ingest job: ``spark-submit chronolake/jobs/ingest.py --log ... --dead-letters ... --checkpoint ...``."""

from __future__ import annotations

import argparse
import os

from chronolake.session import build_session
from chronolake.sources.files import MAX_FILES_PER_TRIGGER, read_record_files
from chronolake.sources.kafka import MAX_OFFSETS_PER_TRIGGER, TOPICS, kafka_options, read_kafka
from chronolake.streaming.ingest import (
    COPY_TASKS,
    DEDUP_DELAY,
    LOG_INTERVAL,
    STREAM_CONF,
    await_any,
    start_split_ingest,
)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--brokers")
    source.add_argument("--files", help="folder of JSON records with the Kafka source's columns")
    parser.add_argument("--topics", nargs="+", default=list(TOPICS))
    parser.add_argument("--log", required=True)
    parser.add_argument("--dead-letters", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--interval", default=LOG_INTERVAL)
    parser.add_argument("--available-now", action="store_true")
    parser.add_argument("--dedup-delay", default=DEDUP_DELAY)
    parser.add_argument("--snapshot-ops", nargs="*", default=[])
    parser.add_argument("--max-offsets", type=int, default=MAX_OFFSETS_PER_TRIGGER, help="of a micro-batch")
    parser.add_argument("--max-files", type=int, default=MAX_FILES_PER_TRIGGER, help="of a micro-batch")
    args = parser.parse_args(argv)

    spark = build_session("chronolake-ingest", conf=STREAM_CONF)
    if args.brokers:
        options = kafka_options(
            args.brokers,
            args.topics,
            max_offsets_per_trigger=args.max_offsets,
            security_protocol=os.getenv("KAFKA_SECURITY_PROTOCOL", "PLAINTEXT"),
            username=os.getenv("KAFKA_USERNAME"),
            password=os.getenv("KAFKA_PASSWORD"),
        )
        records = read_kafka(spark, options)
    else:
        records = read_record_files(spark, args.files, max_files_per_trigger=args.max_files)
    query = start_split_ingest(
        records,
        args.log,
        args.dead_letters,
        args.checkpoint,
        interval=None if args.available_now else args.interval,
        delay=args.dedup_delay,
        snapshot_ops=tuple(args.snapshot_ops),
        copy_tasks=COPY_TASKS if args.files else 0,
    )
    if args.available_now:
        query.awaitTermination()
    else:
        await_any(spark, [query])


if __name__ == "__main__":
    main()
