from __future__ import annotations

import json
import os

import pytest
from payment_rows import good, plan_text
from pyspark.sql import functions as F

from paystrata import session
from paystrata.operators import parse
from paystrata.plans import gate
from paystrata.schema import BRONZE_COLUMNS
from paystrata.sinks.bronze import append_bronze
from paystrata.sinks.envelopes import publish_to_files
from paystrata.sinks.reports import read_reports
from paystrata.sources.bronze import DayNotFound, read_day
from paystrata.sources.envelopes import stream_from_files
from paystrata.streaming.bronze import start_bronze_files

DAY = "2024-01-15"


@pytest.fixture
def roots(tmp_path):
    return str(tmp_path / "bronze"), str(tmp_path / "out")


def marker(root):
    from pathlib import Path

    return Path(root) / "arrival_year=2024/arrival_month=1/arrival_day=15/_SUCCESS"


def report(reports):
    from pathlib import Path

    path = Path(reports) / "quality_reports/bronze/year=2024/month=1/day=15/validation_report.json"
    return json.loads(path.read_text())


def test_pass_writes_report_and_marker(spark, transactions, roots):
    root, reports = roots
    append_bronze(parse.to_bronze(transactions(4)), root)
    assert gate.run_gate(spark, root, DAY, reports) is True
    assert json.loads(marker(root).read_text())["rows"] == 4
    document = report(reports)
    assert document["logical_date"] == DAY and document["success"] is True
    assert document["validated_at"].endswith("+00:00")
    assert document["statistics"] == {
        "evaluated_expectations": 19,
        "successful_expectations": 19,
        "unsuccessful_expectations": 0,
        "success_percent": 100.0,
    }
    assert document["failed_expectations"] == [] and document["unroutable_rows"] == 0
    assert gate.read_if_published(spark, root, DAY).count() == 4
    assert gate.read_published(spark, root).count() == 4


def test_fail_writes_report_only(spark, transactions, roots):
    root, reports = roots
    rows = [good(txn_id=f"TXN-{n:012X}", gateway_id="GW-009") for n in range(3)]
    append_bronze(parse.to_bronze(transactions(rows)), root)
    assert gate.run_gate(spark, root, DAY, reports) is False
    assert not marker(root).exists()
    (failure,) = report(reports)["failed_expectations"]
    assert failure["expectation_type"] == "expect_column_values_to_be_in_set"
    assert json.loads(failure["kwargs"])["column"] == "gateway_id"
    assert failure["result"]["partial_unexpected_counts"] == [{"value": "GW-009", "count": 3}]
    assert gate.read_if_published(spark, root, DAY) is None
    assert gate.read_published(spark, root).count() == 0


def test_rows_after_publication_are_not_served(spark, transactions, roots):
    root, reports = roots
    append_bronze(parse.to_bronze(transactions(3)), root)
    assert gate.run_gate(spark, root, DAY, reports)
    append_bronze(parse.to_bronze(transactions([good(txn_id="TXN-0000000000FF", amount=0.1)])), root)
    assert read_day(spark, root, DAY).count() == 4
    assert gate.read_if_published(spark, root, DAY).count() == 3
    assert gate.read_published(spark, root).count() == 3
    # Nor is a row that was slipped in with an early ingest time.
    early = parse.to_bronze(transactions(1)).withColumn("pipeline_timestamp", F.lit("2020-01-01").cast("timestamp"))
    append_bronze(early, root)
    assert gate.read_if_published(spark, root, DAY).count() == 3


@pytest.mark.parametrize("change", ["gone", "rewritten", "touched"])
def test_changed_days_are_not_among_the_published(spark, transactions, roots, change):
    root, reports = roots
    rows = [good(), good(txn_id="TXN-00000000000B", arrival_timestamp="2024-01-16T01:00:00.000Z")]
    append_bronze(parse.to_bronze(transactions(rows)), root)
    gate.run_gate_for_all_days(spark, root, reports)
    assert gate.read_published(spark, root).count() == 2
    (path,) = marker(root).parent.glob("arrival_hour=*/*.parquet")
    if change == "touched":
        os.utime(path, (1, 1))
    elif change == "rewritten":
        when = path.stat().st_mtime
        path.write_bytes(path.read_bytes() + b" ")
        os.utime(path, (when, when))
    else:
        path.unlink()
    assert [r.arrival_day for r in gate.read_published(spark, root).collect()] == [16]
    assert gate.read_if_published(spark, root, DAY) is None


def test_published_rows_are_not_counted_to_be_read(spark, transactions, roots):
    """Marker and listing suffice: the plan of the read is one scan of the named files."""
    root, reports = roots
    append_bronze(parse.to_bronze(transactions(3)), root)
    gate.run_gate(spark, root, DAY, reports)
    (named,) = json.loads(marker(root).read_text())["files"]
    append_bronze(parse.to_bronze(transactions(2)), root)
    day = gate.read_if_published(spark, root, DAY)
    assert [path.split("/bronze/")[1] for path in day.inputFiles()] == [named]
    assert "Aggregate" not in plan_text(day) and "Join" not in plan_text(day)


@pytest.mark.parametrize("run", ["one", "all"])
def test_dying_run_leaves_nothing_published(spark, transactions, roots, tmp_path, monkeypatch, run):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path / "shared"))
    root, reports = roots
    append_bronze(parse.to_bronze(transactions(3)), root)
    assert gate.run_gate(spark, root, DAY, reports)

    def die(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(gate, "suite_report", die)
    with pytest.raises(RuntimeError):
        if run == "one":
            gate.run_gate(spark, root, DAY, reports)
        else:
            gate.run_gate_for_all_days(spark, root, reports)
    assert not marker(root).exists()
    assert not [p for p in (tmp_path / "shared").rglob("*") if p.is_file()]


def test_failing_rerun_withdraws_the_marker(spark, transactions, roots):
    root, reports = roots
    append_bronze(parse.to_bronze(transactions(2)), root)
    assert gate.run_gate(spark, root, DAY, reports)
    append_bronze(parse.to_bronze(transactions(2)), root)  # now every id is repeated
    assert not gate.run_gate(spark, root, DAY, reports)
    assert not marker(root).exists()
    (failure,) = report(reports)["failed_expectations"]
    assert failure["expectation_type"] == "expect_column_values_to_be_unique"
    assert failure["result"]["unexpected_count"] == 4


def test_missing_day_and_bad_date_raise(spark, transactions, roots):
    root, reports = roots
    append_bronze(parse.to_bronze(transactions(1)), root)
    with pytest.raises(DayNotFound):
        gate.run_gate(spark, root, "2024-01-16", reports)
    with pytest.raises(ValueError):
        gate.run_gate(spark, root, "16-01-2024", reports)


def test_all_days_match_single_days(spark, transactions, roots, tmp_path):
    root, reports = roots
    rows = [
        good(txn_id="TXN-00000000000A"),
        good(txn_id="TXN-00000000000A", arrival_timestamp="2024-01-16T01:00:00.000Z"),
        good(txn_id="TXN-00000000000B", arrival_timestamp="2024-01-16T01:00:00.000Z", amount=0.2),
        good(txn_id="TXN-00000000000C", arrival_timestamp="unreadable"),
    ]
    append_bronze(parse.to_bronze(transactions(rows)), root)
    together = gate.run_gate_for_all_days(spark, root, reports).collect()
    assert {r.logical_date: r.success for r in together} == {DAY: True, "2024-01-16": False}
    assert marker(root).exists()
    alone = str(tmp_path / "alone")
    for date in (DAY, "2024-01-16"):
        gate.run_gate(spark, root, date, alone)
    columns = ["logical_date", "success", "unroutable_rows", "statistics", "failed_expectations", "year", "month", "day"]
    left, right = (read_reports(spark, path).select(*columns) for path in (reports, alone))
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))
    assert gate.read_published(spark, root).count() == 1


def test_day_scan_is_a_partition_filter(spark, transactions, roots):
    root, _ = roots
    rows = [good(), good(arrival_timestamp="2024-01-16T01:00:00.000Z")]
    append_bronze(parse.to_bronze(transactions(rows)), root)
    day = read_day(spark, root, DAY)
    assert tuple(day.columns) == BRONZE_COLUMNS and day.count() == 1
    filters = plan_text(day).split("PartitionFilters: [")[1].split("]")[0]
    assert "arrival_day" in filters and "arrival_year" in filters


def test_gate_reads_streamed_tables_through_their_log(spark, transactions, roots, tmp_path):
    """A file the stream never committed must not be validated."""
    root, reports = roots
    publish_to_files(transactions(3), str(tmp_path / "in"))
    start_bronze_files(
        stream_from_files(spark, str(tmp_path / "in")), root, str(tmp_path / "ck"), available_now=True
    ).awaitTermination()
    committed = next(marker(root).parent.glob("arrival_hour=*/*.parquet"))
    (committed.parent / "uncommitted.parquet").write_bytes(committed.read_bytes())
    assert read_day(spark, root, DAY).count() == 3
    assert gate.run_gate(spark, root, DAY, reports)
    assert gate.read_if_published(spark, root, DAY).count() == 3


def test_report_counts_rows_no_day_contains(spark, transactions, roots, tmp_path):
    root, reports = roots
    bad = [good(txn_id=f"TXN-{n:012X}", arrival_timestamp="?") for n in range(3)]
    for rows, ingested in (([good()], DAY), (bad[:2], DAY), (bad[2:], "2024-01-16")):
        bronze = parse.to_bronze(transactions(rows))
        stamp = F.lit(f"{ingested} 23:59:59").cast("timestamp")
        append_bronze(bronze.withColumn("pipeline_timestamp", stamp), root)
    assert gate.run_gate(spark, root, DAY, reports)
    assert report(reports)["unroutable_rows"] == 2
    assert report(reports)["statistics"]["successful_expectations"] == 19
    (row,) = gate.run_gate_for_all_days(spark, root, str(tmp_path / "all")).collect()
    assert (row.logical_date, row.unroutable_rows) == (DAY, 2)
