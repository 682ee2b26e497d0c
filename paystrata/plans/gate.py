"""The quality gate: validate arrival days, always report, publish on a pass."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.functions.times import parse_logical_date, report_time
from paystrata.operators.rules import BRONZE_SUITE, Rule
from paystrata.operators.validation import suite_report, summarize_rules, unexpected_samples
from paystrata.schema import DAY_COLUMNS, INGEST_COLUMN
from paystrata.session import materialized, scratch_path
from paystrata.sinks import reports
from paystrata.sources import files
from paystrata.sources.bronze import (
    DayNotFound,
    day_path,
    file_manifest,
    present_files,
    read_bronze,
    read_day,
    read_listed,
    read_unroutable,
)

logger = logging.getLogger(__name__)


def validate(
    df: DataFrame,
    suite: Sequence[Rule] = BRONZE_SUITE,
    by: Sequence[str] = (),
    scratch: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rule summary and report of ``df``, per group of ``by`` (runs jobs).

    The summary (one row per rule and group) is written down, at ``scratch`` if the
    caller removes it, else among the application's tables. Sample values are
    then looked up for the failing rules only: a table that passes is not
    scanned again, and one that fails is scanned for the columns at fault.
    """
    summary = materialized(
        summarize_rules(df, suite, by), scratch or scratch_path(df.sparkSession, "rule_summary")
    )
    failing = {
        row.rule_id
        for row in summary.where(~F.col("success")).select("rule_id").distinct().collect()
    }
    samples = unexpected_samples(df, [rule for rule in suite if rule.rule_id in failing], by)
    return summary, suite_report(summary, samples, by)


def _as_document(report: DataFrame, logical_date: Column, unroutable: Column) -> DataFrame:
    return report.select(
        *(name for name in DAY_COLUMNS if name in report.columns),
        logical_date.alias("logical_date"),
        report_time().alias("validated_at"),
        "success",
        unroutable.alias("unroutable_rows"),
        "statistics",
        "failed_expectations",
        F.col("success").alias("passed"),
    )


def count_unroutable(spark: SparkSession, root: str, date: dt.date) -> int:
    """Rows ingested on ``date`` that have no readable arrival time.

    No rule ever sees them, so the report counts them. The range on the ingest
    time is pushed to the Parquet statistics, which skip files of other days.
    """
    rows = read_unroutable(spark, root)
    if rows is None:
        return 0
    ingested = F.col(INGEST_COLUMN)
    start, end = (F.lit(day).cast("timestamp") for day in (date, date + dt.timedelta(days=1)))
    return rows.where((ingested >= start) & (ingested < end)).count()


def _unroutable_by_day(spark: SparkSession, root: str) -> DataFrame:
    rows = read_unroutable(spark, root)
    if rows is None:
        rows = read_bronze(spark, root).where("false")
    return rows.groupBy(F.to_date(INGEST_COLUMN).alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("n_unroutable")
    )


def manifest_of(df: DataFrame) -> dict[str, list[int]]:
    """Length, modification time and rows of each file behind a day (one record per file)."""
    return {row.file: [row.length, row.modified, row.rows] for row in file_manifest(df).collect()}


def conclude(
    spark: SparkSession,
    root: str,
    reports_root: str,
    date: dt.date,
    report: DataFrame,
    manifest: dict[str, list[int]],
) -> bool:
    """Write the day's report, and its marker if all rules hold; whether they do."""
    unroutable = F.lit(count_unroutable(spark, root, date)).cast("bigint")
    document = _as_document(report, F.lit(date.isoformat()), unroutable)
    row = reports.report_documents(document, "passed").first()
    path = reports.write_report(spark, reports_root, date, row.document)
    if row.passed:
        rows = sum(n for _, _, n in manifest.values())
        reports.write_marker(spark, root, date, reports.Published(rows, manifest))
        logger.info("all rules hold for %s", date)
    else:
        logger.error("rules broken for %s, see %s", date, path)
    return row.passed


def run_gate(
    spark: SparkSession,
    root: str,
    logical_date: str,
    reports_root: str,
    suite: Sequence[Rule] = BRONZE_SUITE,
) -> bool:
    """Validate one arrival day; True, and a marker, iff every rule holds.

    The report is written either way. A marker left by an earlier run is removed
    before anything else, so neither a day that no longer passes nor one whose
    validation dies is read as published. Files written after the start are not
    validated, and the marker does not name them. A day without rows raises
    :class:`DayNotFound`. Where only few files are new since the last run,
    :func:`paystrata.plans.incremental.run_gate_incrementally` reads just those.
    """
    date = parse_logical_date(logical_date)
    scratch = scratch_path(spark, "gate")
    try:
        reports.remove_marker(spark, root, date)
        day = read_day(spark, root, logical_date)
        manifest = manifest_of(day)
        if not manifest:
            raise DayNotFound(f"no bronze rows for {logical_date} below {root}")
        _, report = validate(day, suite, scratch=scratch)
        return conclude(spark, root, reports_root, date, report, manifest)
    except Exception:
        logger.exception("quality gate failed for %s", logical_date)
        raise
    finally:
        files.delete(spark, scratch)


def run_gate_for_all_days(
    spark: SparkSession,
    root: str,
    reports_root: str,
    suite: Sequence[Rule] = BRONZE_SUITE,
) -> DataFrame:
    """Validate every arrival day of the table in one pass (backfill).

    Rules are evaluated per day by grouping, so the number of Spark jobs does not
    depend on the number of days. What reaches the driver is one bounded document
    per day. Rows without an arrival day belong to no day and are not validated
    here; each report counts those ingested on its day. Returns the reports as a
    table.
    """
    reports.remove_markers(spark, root)
    days = read_bronze(spark, root).where(F.col(DAY_COLUMNS[0]).isNotNull())
    scratch = scratch_path(spark, "gate")
    try:
        _report_days(spark, root, reports_root, suite, days, scratch)
    finally:
        files.delete(spark, scratch)
    return reports.read_reports(spark, reports_root)


def _report_days(
    spark: SparkSession,
    root: str,
    reports_root: str,
    suite: Sequence[Rule],
    days: DataFrame,
    scratch: str,
) -> None:
    _, report = validate(days, suite, by=DAY_COLUMNS, scratch=scratch)
    day = F.make_date(*map(F.col, DAY_COLUMNS))
    unroutable = _unroutable_by_day(spark, root)
    counted = report.join(unroutable, day == unroutable["ingest_date"], "left")
    parts = [F.regexp_extract("file", f"{name}=([0-9]+)/", 1).cast("int").alias(name) for name in DAY_COLUMNS]
    listed = file_manifest(days).select(*parts, F.struct("file", "length", "modified", "rows").alias("entry"))
    manifests = listed.groupBy(*DAY_COLUMNS).agg(F.collect_list("entry").alias("files"))
    document = _as_document(
        counted, F.date_format(day, "yyyy-MM-dd"), F.coalesce("n_unroutable", F.lit(0))
    ).join(manifests, list(DAY_COLUMNS))
    documents = reports.report_documents(document, *DAY_COLUMNS, "passed", "files")
    for row in documents.toLocalIterator():
        date = dt.date(row.arrival_year, row.arrival_month, row.arrival_day)
        reports.write_report(spark, reports_root, date, row.document)
        if row.passed:
            manifest = {f.file: [f.length, f.modified, f.rows] for f in row.files}
            rows = sum(f.rows for f in row.files)
            reports.write_marker(spark, root, date, reports.Published(rows, manifest))


def is_published(spark: SparkSession, root: str, logical_date: str) -> bool:
    return reports.has_marker(spark, root, parse_logical_date(logical_date))


def _unchanged(published: reports.Published, present: dict[str, tuple[int, int]]) -> bool:
    """True if every validated file is still there as it was."""
    return all(present.get(name) == (length, modified) for name, (length, modified, _) in published.files.items())


def _present(spark: SparkSession, folder: str) -> dict[str, tuple[int, int]]:
    return {row.file: (row.length, row.modified) for row in present_files(spark, folder).collect()}


def read_if_published(spark: SparkSession, root: str, logical_date: str) -> DataFrame | None:
    """The validated files of a day that the gate let pass, else None.

    Exactly the files that the marker names are read, so rows that came after the
    validation do not show. If one of them is gone or has another length or
    modification time (the folder is listed, no file is opened), nothing is served.
    """
    date = parse_logical_date(logical_date)
    if not reports.has_marker(spark, root, date):
        return None
    published = reports.read_marker(spark, reports.marker_path(root, date))
    if not _unchanged(published, _present(spark, day_path(root, date))):
        logger.error("%s has changed since it was validated; run the gate again", logical_date)
        return None
    return read_listed(spark, root, published.files)


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """Validated files of all published days, as one scan.

    Days of which a validated file is gone or has changed are left out. The driver
    holds the names of the published files, as it does for any scan of them.
    """
    published = {date: reports.read_marker(spark, path) for date, path in reports.markers(spark, root).items()}
    if not published:
        return read_bronze(spark, root).where(F.lit(False))
    present = _present(spark, root)
    same = {date: marker for date, marker in published.items() if _unchanged(marker, present)}
    if len(same) < len(published):
        logger.error("changed since they were validated: %s; run the gate again", sorted(map(str, published.keys() - same.keys())))
    names = [name for marker in same.values() for name in marker.files]
    return read_listed(spark, root, names) if names else read_bronze(spark, root).where(F.lit(False))
