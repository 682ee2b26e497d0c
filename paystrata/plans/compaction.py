"""Compaction of the callback sink's folders, one per trigger and hour, into one per hour.

Readers see every row once all the time: the merged folders count from the moment that
the day's new version is there, and the merged batches cease to at the same moment. A
replay of a merged batch changes nothing, a later batch counts beside the merged folder.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
import uuid
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.plans.gate import manifest_of
from paystrata.schema import BATCH_COLUMN, PARTITION_COLUMNS
from paystrata.sinks import reports
from paystrata.sources import files, snapshots, versions
from paystrata.sources.bronze import day_name, read_day, require_writer
from paystrata.streaming.bronze import overwrite_batch

logger = logging.getLogger(__name__)

#: How long replaced folders stay for readers of the state before. It must exceed the
#: time of any scan and of any compaction.
GRACE = dt.timedelta(hours=6)


class CompactionFailed(RuntimeError):
    """The merged folders do not hold the rows of the batches; nothing was published."""


def compact_bronze(
    spark: SparkSession,
    root: str,
    *,
    since: dt.date | None = None,
    until: dt.datetime | None = None,
    grace: dt.timedelta = GRACE,
) -> int:
    """Merge the batches of each hour that has several; the number of hours merged.

    Only hours from the day ``since`` on that ended by ``until`` are merged (default:
    all), and the rows without an arrival time, which lie in the default partition; days
    before ``since`` are not listed. All hours are read and written
    by one job, in which AQE chooses the files per hour by size; then each day gets its
    new version. Two compactions of a day cannot both publish: the second raises, and
    what it wrote never counts. Folders that no longer count go with the first
    compaction that begins ``grace`` after the version which replaced them.

    A day whose marker names exactly its files stays published: the marker then names
    the merged files, which hold the same rows. The incremental gate validates a merged
    day anew, so compact before its first run.
    """
    require_writer(spark, root, commit_log=False)
    remove_replaced(spark, root, since=since, grace=grace)
    snapshots.begin(spark, root)
    tag = f"{snapshots.MERGED}{_now()}-{uuid.uuid4().hex}"
    states, sources, targets = {}, [], []
    for day in _days(spark, root, since):
        earlier = versions.listed(spark, snapshots.place(root, day))
        compacted = snapshots.hours(spark, earlier[-1]) if earlier else {}
        merged = _to_merge(snapshots.batches(spark, root, day), compacted, day, until)
        if merged:
            states[day] = earlier, {**compacted, **{hour: _merged(found, compacted.get(hour), tag) for hour, found in merged.items()}}
            sources += [batch.path for found in merged.values() for batch in found]
            targets += [f"{root.rstrip('/')}/{day}/{hour}/{BATCH_COLUMN}={tag}" for hour in merged]
    if not sources:
        return 0
    rows = _rows(spark, root, sources)
    overwrite_batch(rows.hint("rebalance", *PARTITION_COLUMNS), tag, root, PARTITION_COLUMNS)
    before, after = rows.count(), _rows(spark, root, targets).count()  # from the files' footers
    if before != after:
        raise CompactionFailed(f"{before} rows in the batches of {root}, {after} after merging")
    same = _published_as_is(spark, root, set(states))
    for day, (earlier, state) in states.items():
        entry = {"published": _now(), "hours": {name: hour._asdict() for name, hour in state.items()}}
        versions.publish(spark, snapshots.place(root, day), earlier, entry)
    for date, published in same.items():
        _name_merged_files(spark, root, date, published)
    logger.info("%d folders merged into %d below %s", len(sources), len(targets), root)
    return len(targets)


def remove_replaced(
    spark: SparkSession, root: str, *, since: dt.date | None = None, grace: dt.timedelta = GRACE
) -> int:
    """Delete folders that do not count in a version older than ``grace``: merged batches,
    replays of them, and what compactions left that died; the number of folders."""
    latest = _now() - int(grace.total_seconds() * 1000)
    removed = 0
    for day in _days(spark, root, since) if snapshots.is_used(spark, root) else []:
        found = versions.listed(spark, snapshots.place(root, day))
        if found and versions.content(spark, found[-1])["published"] > latest:
            continue
        compacted = snapshots.hours(spark, found[-1]) if found else {}
        for batch in snapshots.batches(spark, root, day):
            running = batch.tag.startswith(snapshots.MERGED) and _begun(batch.tag) > latest
            if not running and not snapshots.counts(batch, compacted):
                removed += files.delete(spark, batch.path)
    return removed


def _days(spark: SparkSession, root: str, since: dt.date | None) -> list[str]:
    """Folders of the days from ``since`` on, and that of the rows without a day."""

    def wanted(day: str) -> bool:
        parts = [part.partition("=")[2] for part in day.split("/")]
        return since is None or not all(map(str.isdigit, parts)) or dt.date(*map(int, parts)) >= since

    return [day for day in snapshots.all_days(spark, root) if wanted(day)]


def _now() -> int:
    return int(time.time() * 1000)


def _begun(tag: str) -> int:
    """When the compaction began that wrote a merged folder."""
    return int(tag.removeprefix(snapshots.MERGED).partition("-")[0])


def _rows(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    rows = spark.read.option("basePath", root).parquet(*paths).drop(BATCH_COLUMN)
    # Values of the default partition alone have no type.
    return rows.withColumns({name: F.col(name).cast("int") for name in PARTITION_COLUMNS})


def _to_merge(
    found: list[snapshots.Batch], compacted: dict[str, snapshots.Hour], day: str, until: dt.datetime | None
) -> dict[str, list[snapshots.Batch]]:
    """The folders that count of each ended hour that has several."""
    by_hour = defaultdict(list)
    for batch in found:
        if snapshots.counts(batch, compacted) and _has_ended(day, batch.hour, until):
            by_hour[batch.hour].append(batch)
    return {hour: several for hour, several in by_hour.items() if len(several) > 1}


def _has_ended(day: str, hour: str, until: dt.datetime | None) -> bool:
    parts = [part.partition("=")[2] for part in (*day.split("/"), hour)]
    if until is None or not all(part.isdigit() for part in parts):
        return True
    return dt.datetime(*map(int, parts)) + dt.timedelta(hours=1) <= until


def _merged(found: list[snapshots.Batch], before: snapshots.Hour | None, tag: str) -> snapshots.Hour:
    last = dict(before.batches) if before else {}
    for batch in found:
        if not batch.tag.startswith(snapshots.MERGED):
            stream, number = snapshots.numbered(batch.tag)
            last[stream] = max(number, last.get(stream, -1))
    return snapshots.Hour(tag, last)


def _published_as_is(spark: SparkSession, root: str, days: set[str]) -> dict[dt.date, reports.Published]:
    """Markers of days that still are what their marker names."""
    found = {date: path for date, path in reports.markers(spark, root).items() if day_name(date) in days}
    named = {date: reports.read_marker(spark, path) for date, path in found.items()}
    return {date: one for date, one in named.items() if manifest_of(read_day(spark, root, date.isoformat())) == one.files}


def _name_merged_files(spark: SparkSession, root: str, date: dt.date, published: reports.Published) -> None:
    """The marker of a compacted day; if rows have come since, it keeps naming the old files."""
    manifest = manifest_of(read_day(spark, root, date.isoformat()))
    if sum(rows for _, _, rows in manifest.values()) == published.rows:
        reports.write_marker(spark, root, date, published._replace(files=manifest))
