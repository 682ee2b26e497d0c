"""Compaction of batch folders: every row once, whatever runs meanwhile."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from payment_rows import good

from paystrata.operators import parse
from paystrata.plans import compaction, gate, jobs
from paystrata.plans.compaction import compact_bronze, remove_replaced
from paystrata.sources import snapshots, versions
from paystrata.sources.bronze import read_bronze, read_day, read_unroutable
from paystrata.streaming.bronze import write_bronze_batch

NOW = dt.timedelta(0)
DAY = "2024-01-15"


@pytest.fixture
def table(spark, transactions, tmp_path):
    """Root of a table, and how to deliver batches of three rows each: two of an hour
    of their own, by turns one of two, and one without an arrival time."""
    root = str(tmp_path / "bronze")

    def deliver(number: int, stream: str = "q") -> None:
        rows = [
            good(txn_id=f"TXN-{number:011X}{n}", arrival_timestamp=f"2024-01-15T{10 + number % 2}:00:0{n}.000Z")
            for n in range(2)
        ]
        rows.append(good(txn_id=f"TXN-{number:011X}9", arrival_timestamp="x"))
        write_bronze_batch(parse.encode_envelopes(transactions(rows)), f"{stream}-{number}", root)

    return root, deliver


def ids(df):
    return sorted(row.txn_id for row in df.select("txn_id").collect())


def data_files(root):
    return sorted(str(path.relative_to(root)) for path in Path(root).rglob("*.parquet"))


@pytest.mark.parametrize("triggers", [4, 10])
def test_files_do_not_depend_on_the_number_of_triggers(spark, table, triggers):
    root, deliver = table
    for number in range(triggers):
        deliver(number)
    before = ids(read_bronze(spark, root))
    assert len(before) == 3 * triggers == len(set(before))
    assert compact_bronze(spark, root) == 3  # two hours and the default partition
    assert ids(read_bronze(spark, root)) == before
    assert remove_replaced(spark, root) == 0  # still kept for readers
    assert remove_replaced(spark, root, grace=NOW) == 2 * triggers
    assert len(data_files(root)) == 3
    assert ids(read_bronze(spark, root)) == before
    assert read_day(spark, root, DAY).count() == 2 * triggers
    assert read_unroutable(spark, root).count() == triggers
    assert compact_bronze(spark, root) == 0  # nothing left to merge


def test_readers_see_each_row_once_while_it_runs(spark, table, monkeypatch):
    root, deliver = table
    for number in range(4):
        deliver(number)
    before, seen = ids(read_bronze(spark, root)), []
    earlier_reader = read_bronze(spark, root)
    publish = versions.publish

    def watched(*args):
        seen.append(ids(read_bronze(spark, root)))
        publish(*args)
        seen.append(ids(read_bronze(spark, root)))
        seen.append(ids(read_day(spark, root, DAY)) + ids(read_unroutable(spark, root)))

    monkeypatch.setattr(versions, "publish", watched)
    compact_bronze(spark, root)
    assert len(seen) == 6 and all(sorted(rows) == before for rows in seen)
    assert ids(earlier_reader) == before


def test_replays_and_later_batches(spark, table):
    root, deliver = table
    for number in range(4):
        deliver(number)
    before = ids(read_bronze(spark, root))
    compact_bronze(spark, root)
    deliver(3)  # its commit record was lost
    assert ids(read_bronze(spark, root)) == before
    remove_replaced(spark, root, grace=NOW)
    deliver(3)
    assert ids(read_bronze(spark, root)) == before
    deliver(4)
    deliver(0, stream="other")  # not a replay: another stream
    after = ids(read_bronze(spark, root))
    assert len(after) == len(before) + 6
    assert compact_bronze(spark, root, grace=NOW) == 2  # the hour 10 and the default partition
    assert ids(read_bronze(spark, root)) == after
    deliver(4)
    assert ids(read_bronze(spark, root)) == after
    remove_replaced(spark, root, grace=NOW)
    assert len(data_files(root)) == 3


def test_a_compaction_that_dies_leaves_no_trace(spark, table, monkeypatch):
    root, deliver = table
    for number in range(4):
        deliver(number)
    before, files_before = ids(read_bronze(spark, root)), data_files(root)

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "publish", dies)
        with pytest.raises(OSError):
            compact_bronze(spark, root)
    assert len(data_files(root)) > len(files_before)
    assert ids(read_bronze(spark, root)) == before
    assert remove_replaced(spark, root) == 0  # it might still be running
    assert remove_replaced(spark, root, grace=NOW) == 3
    assert data_files(root) == files_before
    assert compact_bronze(spark, root) == 3
    assert ids(read_bronze(spark, root)) == before


def test_of_two_compactions_one_fails(spark, table, monkeypatch):
    root, deliver = table
    for number in range(4):
        deliver(number)
    before, publish, other = ids(read_bronze(spark, root)), versions.publish, []

    def overtaken(*args):
        if not other:
            other.append("running")
            assert compact_bronze(spark, root) == 3
        publish(*args)

    monkeypatch.setattr(versions, "publish", overtaken)
    with pytest.raises(Exception, match="exist"):
        compact_bronze(spark, root)
    assert ids(read_bronze(spark, root)) == before
    remove_replaced(spark, root, grace=NOW)
    assert len(data_files(root)) == 3 and ids(read_bronze(spark, root)) == before


def test_only_ended_hours_of_the_chosen_days(spark, table):
    root, deliver = table
    for number in range(4):
        deliver(number)
    assert compact_bronze(spark, root, since=dt.date(2024, 1, 16)) == 1  # default partition
    assert compact_bronze(spark, root, until=dt.datetime(2024, 1, 15, 11, 59)) == 1
    assert set(snapshots.newest_hours(spark, root, snapshots.all_days(spark, root)[0])) == {"arrival_hour=10"}
    assert jobs.main(["compact", "--root", root, "--until", "2024-01-15T12:00"]) == 0
    assert len(ids(read_bronze(spark, root))) == 12


def test_missing_rows_are_not_published(spark, table, monkeypatch):
    root, deliver = table
    for number in range(4):
        deliver(number)
    write = compaction.overwrite_batch
    monkeypatch.setattr(compaction, "overwrite_batch", lambda df, *rest: write(df.where("txn_id > 'TXN-000000000011'"), *rest))
    with pytest.raises(compaction.CompactionFailed):
        compact_bronze(spark, root)
    assert len(ids(read_bronze(spark, root))) == 12


def test_a_published_day_stays_published(spark, table, tmp_path):
    root, deliver = table
    for number in range(4):
        deliver(number)
    assert gate.run_gate(spark, root, DAY, str(tmp_path))
    before = ids(gate.read_if_published(spark, root, DAY))
    compact_bronze(spark, root)
    remove_replaced(spark, root, grace=NOW)
    assert ids(gate.read_if_published(spark, root, DAY)) == before
    assert ids(gate.read_published(spark, root)) == before


def test_rows_that_came_after_validation_stay_unpublished(spark, table, tmp_path):
    root, deliver = table
    for number in range(4):
        deliver(number)
    assert gate.run_gate(spark, root, DAY, str(tmp_path))
    before = ids(gate.read_if_published(spark, root, DAY))
    deliver(4)
    compact_bronze(spark, root)
    assert ids(gate.read_if_published(spark, root, DAY)) == before  # the old files
    remove_replaced(spark, root, grace=NOW)
    assert gate.read_if_published(spark, root, DAY) is None  # until the gate runs again
    assert gate.run_gate(spark, root, DAY, str(tmp_path))
    assert len(ids(gate.read_if_published(spark, root, DAY))) == 10
