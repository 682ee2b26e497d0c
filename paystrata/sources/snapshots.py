"""Snapshots of compacted days: which batch folders hold a day's rows.

The callback sink leaves a folder per trigger and hour. Where compaction has merged
them, the day's newest version names, per hour, the merged folder and the last batch of
each stream that is in it. Those batches' own folders no longer count, also when a
replay writes one of them again; later batches do, and so does every folder of a day
that was never compacted.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import SparkSession

from paystrata.schema import BATCH_COLUMN, DAY_COLUMNS
from paystrata.sources import files, versions

_FOLDER = "_snapshots"
MERGED = "merged-"


class Hour(NamedTuple):
    """The merged folder of an hour, and per stream the last batch that is in it."""

    merged: str
    batches: dict[str, int]


class Batch(NamedTuple):
    """A folder of the callback sink or of a compaction."""

    path: str
    hour: str
    tag: str


def numbered(tag: str) -> tuple[str, int]:
    """Stream and number of a batch tag ``<stream>-<number>``; other tags are their own stream."""
    stream, _, number = tag.rpartition("-")
    return (stream, int(number)) if stream and number.isdigit() else (tag, 0)


def place(root: str, day: str) -> str:
    """Folder of the versions of a day (named by its folder below the table)."""
    return f"{root.rstrip('/')}/{_FOLDER}/{day}"


def all_days(spark: SparkSession, root: str) -> list[str]:
    """Folders of all days below the table, that of rows without one included."""
    pattern = "/".join(f"{name}=*" for name in DAY_COLUMNS)
    depth = len(DAY_COLUMNS)
    return ["/".join(path.split("/")[-depth:]) for path in files.matching(spark, f"{root.rstrip('/')}/{pattern}")]


def hours(spark: SparkSession, version: str) -> dict[str, Hour]:
    return {name: Hour(**entry) for name, entry in versions.content(spark, version)["hours"].items()}


def newest_hours(spark: SparkSession, root: str, day: str) -> dict[str, Hour]:
    """Compacted hours of a day; none where it was never compacted."""
    found = versions.listed(spark, place(root, day))
    return hours(spark, found[-1]) if found else {}


def batches(spark: SparkSession, root: str, day: str) -> list[Batch]:
    """All folders of a day's batches, whether they count or not."""
    found = files.matching(spark, f"{root.rstrip('/')}/{day}/*/{BATCH_COLUMN}=*")
    parts = (path.split("/") for path in found)
    return [Batch(path, names[-2], names[-1].partition("=")[2]) for path, names in zip(found, parts)]


def counts(batch: Batch, compacted: dict[str, Hour]) -> bool:
    """True if the rows of a folder are the table's, given the day's compacted hours."""
    hour = compacted.get(batch.hour)
    if batch.tag.startswith(MERGED):
        return hour is not None and batch.tag == hour.merged
    stream, number = numbered(batch.tag)
    return hour is None or number > hour.batches.get(stream, -1)


def is_used(spark: SparkSession, root: str) -> bool:
    """True once a compaction has begun on the table."""
    return files.exists(spark, f"{root.rstrip('/')}/{_FOLDER}")


def begin(spark: SparkSession, root: str) -> None:
    """From now on readers take the folders that count, one by one."""
    if not is_used(spark, root):
        files.write_text(spark, f"{root.rstrip('/')}/{_FOLDER}/.used", "")


def paths_of_day(spark: SparkSession, root: str, day: str) -> list[str]:
    """What to read for a day: its folder, or those below it that count.

    The version is read before the folders are listed, so that a compaction which ends
    in between shows nothing twice; what it wrote has no version yet and does not count.
    """
    if is_used(spark, root):
        compacted = newest_hours(spark, root, day)
        found = batches(spark, root, day)
        if found:
            return [batch.path for batch in found if counts(batch, compacted)]
    return [f"{root.rstrip('/')}/{day}"]


def paths_of_table(spark: SparkSession, root: str) -> list[str]:
    """What to read for all days: the root alone if nothing was ever compacted."""
    if not is_used(spark, root):
        return [root]
    return [path for day in all_days(spark, root) for path in paths_of_day(spark, root, day)]
