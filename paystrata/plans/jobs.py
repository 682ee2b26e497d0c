"""Command-line jobs, one per layer. ``--help`` lists each job's options.

    spark-submit … -m paystrata.plans.jobs bronze --bootstrap HOST:PORT \\
        --root URI --checkpoint URI
    spark-submit … -m paystrata.plans.jobs compact --root URI [--since YYYY-MM-DD] [--until YYYY-MM-DDTHH:MM]
    spark-submit … -m paystrata.plans.jobs gate --root URI --reports URI --date YYYY-MM-DD
    spark-submit … -m paystrata.plans.jobs gate --root URI --reports URI --all-days
    spark-submit … -m paystrata.plans.jobs silver --root URI --silver URI --date YYYY-MM-DD
    spark-submit … -m paystrata.plans.jobs gold --silver URI --gold URI

Each returns 0, or 1 if the stream failed, a day did not pass or was not published.
Logging is left to the caller's configuration.
"""

from __future__ import annotations

import argparse
import datetime as dt
import signal
import sys
import threading

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from paystrata.operators import gold, parse, silver
from paystrata.plans import compaction, gate
from paystrata.session import engine_session, object_store_conf
from paystrata.sources.envelopes import DEFAULT_TOPIC, stream_from_kafka
from paystrata.streaming.bronze import start_bronze_batches, start_bronze_files
from paystrata.streaming.triggers import TRIGGER_INTERVAL

_POLL_SECONDS = 1.0


def _session(args: argparse.Namespace) -> SparkSession:
    store = object_store_conf(args.s3_region) if args.s3_region else {}
    return engine_session(
        f"paystrata-{args.job}", shuffle_partitions=args.shuffle_partitions, extra=store
    )


def follow(query: StreamingQuery, stop: threading.Event) -> int:
    """Stay with a stream until it ends or ``stop`` is set; 1 if it failed.

    A stop waits until the running micro-batch is written, so that the next start
    has nothing to repeat.
    """
    try:
        while not (stop.is_set() or query.awaitTermination(_POLL_SECONDS)):
            pass
        while query.isActive and query.status["isTriggerActive"]:
            query.awaitTermination(_POLL_SECONDS)
    except StreamingQueryException:
        return 1
    query.stop()
    return 0 if query.exception() is None else 1


def bronze(args: argparse.Namespace) -> int:
    envelopes = stream_from_kafka(
        _session(args),
        args.bootstrap,
        topic=args.topic,
        max_offsets_per_trigger=args.max_offsets_per_trigger,
        min_partitions=args.min_partitions,
    )
    options = {"interval": args.interval, "files_per_partition": args.files_per_partition}
    if args.quarantine is None:
        query = start_bronze_files(envelopes, args.root, args.checkpoint, **options)
    else:
        query = start_bronze_batches(
            envelopes, args.root, args.checkpoint, quarantine=args.quarantine, **options
        )
    stop = threading.Event()
    for number in (signal.SIGINT, signal.SIGTERM):
        signal.signal(number, lambda *_: stop.set())
    return follow(query, stop)


def compact(args: argparse.Namespace) -> int:
    """Merge the batches of hours that have ended (by now, unless told otherwise)."""
    until = args.until or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    compaction.compact_bronze(_session(args), args.root, since=args.since, until=until)
    return 0


def check(args: argparse.Namespace) -> int:
    spark = _session(args)
    if not args.all_days:
        return 0 if gate.run_gate(spark, args.root, args.date, args.reports) else 1
    status = gate.run_gate_for_all_days(spark, args.root, args.reports)
    return 0 if status.where("NOT success").isEmpty() else 1


def to_silver(args: argparse.Namespace) -> int:
    """Upsert a published day. What is left out is in the quarantine."""
    spark = _session(args)
    day = gate.read_if_published(spark, args.root, args.date)
    if day is None:
        return 1
    silver.upsert_silver(parse.addressable(day), args.silver)
    return 0


def to_gold(args: argparse.Namespace) -> int:
    """Bring the route cube up to silver's newest version."""
    gold.update_gold(_session(args), args.silver, args.gold)
    return 0


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="paystrata")
    jobs = root.add_subparsers(dest="job", required=True)

    def job(name: str, run, about: str, *required: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name, help=about)
        for option in required:
            added.add_argument(f"--{option}", required=True)
        added.add_argument("--s3-region", help="region of an s3a:// root")
        added.add_argument("--shuffle-partitions", type=int)
        added.set_defaults(run=run)
        return added

    stream = job("bronze", bronze, "topic to hourly-partitioned Parquet", "bootstrap", "root", "checkpoint")
    stream.add_argument("--topic", default=DEFAULT_TOPIC)
    stream.add_argument("--quarantine")
    stream.add_argument("--interval", default=TRIGGER_INTERVAL)
    stream.add_argument("--files-per-partition", type=int)
    stream.add_argument("--max-offsets-per-trigger", type=int)
    stream.add_argument("--min-partitions", type=int)

    merge = job("compact", compact, "one folder per hour instead of one per trigger", "root")
    merge.add_argument("--since", type=dt.date.fromisoformat)
    merge.add_argument("--until", type=dt.datetime.fromisoformat, help="UTC; default: now")

    days = job("gate", check, "validate arrival days", "root", "reports").add_mutually_exclusive_group(required=True)
    days.add_argument("--date")
    days.add_argument("--all-days", action="store_true")

    job("silver", to_silver, "upsert a published day", "root", "silver", "date")
    job("gold", to_gold, "roll silver up by route", "silver", "gold")
    return root


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return args.run(args)


if __name__ == "__main__":
    sys.exit(main())
