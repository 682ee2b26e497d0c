"""Validation reports and publish markers, one of each per arrival day."""

from __future__ import annotations

import datetime as dt
import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.sources import files
from paystrata.sources.bronze import day_path

REPORT_NAME = "validation_report.json"
MARKER_NAME = "_SUCCESS"
REPORT_SCHEMA = """
    logical_date STRING,
    validated_at STRING,
    success BOOLEAN,
    unroutable_rows BIGINT,
    statistics STRUCT<
        evaluated_expectations: BIGINT,
        successful_expectations: BIGINT,
        unsuccessful_expectations: BIGINT,
        success_percent: DOUBLE>,
    failed_expectations ARRAY<STRUCT<
        expectation_type: STRING,
        kwargs: STRING,
        result: STRUCT<
            element_count: BIGINT,
            missing_count: BIGINT,
            missing_percent: DOUBLE,
            unexpected_count: BIGINT,
            unexpected_percent: DOUBLE,
            unexpected_percent_total: DOUBLE,
            partial_unexpected_counts: ARRAY<STRUCT<value: STRING, count: BIGINT>>,
            error: STRING>>>
"""


class Published(NamedTuple):
    """What a marker vouches for: the validated files (relative to the table) with their
    length, modification time and rows."""

    rows: int
    files: dict[str, list[int]]


def report_path(reports_root: str, date: dt.date) -> str:
    return (
        f"{reports_root.rstrip('/')}/quality_reports/bronze"
        f"/year={date.year}/month={date.month}/day={date.day}/{REPORT_NAME}"
    )


def report_documents(report: DataFrame, *keep: str) -> DataFrame:
    """The report rows as JSON text, nulls included."""
    fields = [name for name in report.columns if name not in keep]
    document = F.to_json(F.struct(*fields), {"ignoreNullFields": "false", "pretty": "true"})
    return report.select(*keep, document.alias("document"))


def write_report(spark: SparkSession, reports_root: str, date: dt.date, document: str) -> str:
    path = report_path(reports_root, date)
    files.write_text(spark, path, document)
    return path


def read_reports(spark: SparkSession, reports_root: str) -> DataFrame:
    """All reports as a table with year, month and day: the status of every day."""
    root = f"{reports_root.rstrip('/')}/quality_reports/bronze"
    return (
        spark.read.schema(REPORT_SCHEMA)
        .option("multiLine", True)
        .option("basePath", root)
        .json(f"{root}/year=*/month=*/day=*/{REPORT_NAME}")
    )


def marker_path(root: str, date: dt.date) -> str:
    return f"{day_path(root, date)}/{MARKER_NAME}"


def write_marker(spark: SparkSession, root: str, date: dt.date, published: Published) -> None:
    """Publish the day: exactly these files."""
    files.write_text(spark, marker_path(root, date), json.dumps(published._asdict()))


def read_marker(spark: SparkSession, path: str) -> Published:
    return Published(**json.loads(files.read_text(spark, path)))


def markers(spark: SparkSession, root: str) -> dict[dt.date, str]:
    """Paths of the markers of all published days."""
    pattern = f"{root.rstrip('/')}/arrival_year=*/arrival_month=*/arrival_day=*/{MARKER_NAME}"
    found = {}
    for path in files.matching(spark, pattern):
        parts = [part.split("=")[1] for part in path.split("/")[-4:-1]]
        if all(part.isdigit() for part in parts):
            found[dt.date(*map(int, parts))] = path
    return found


def remove_markers(spark: SparkSession, root: str) -> None:
    """Unpublish the whole table, days that have lost all their rows included."""
    for path in markers(spark, root).values():
        files.delete(spark, path)


def remove_marker(spark: SparkSession, root: str, date: dt.date) -> bool:
    return files.delete(spark, marker_path(root, date))


def has_marker(spark: SparkSession, root: str, date: dt.date) -> bool:
    return files.exists(spark, marker_path(root, date))
