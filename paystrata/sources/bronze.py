"""Reading the bronze table, whole or by arrival day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.functions.times import parse_logical_date
from paystrata.schema import BRONZE_COLUMNS, DAY_COLUMNS
from paystrata.sources import files, snapshots


class DayNotFound(LookupError):
    """The bronze table holds no rows for the logical date."""


def day_name(date: dt.date) -> str:
    """Folder of one arrival day below the table; partition values are not zero-padded."""
    return f"arrival_year={date.year}/arrival_month={date.month}/arrival_day={date.day}"


def day_path(root: str, date: dt.date) -> str:
    return f"{root.rstrip('/')}/{day_name(date)}"


#: Folder of the rows without an arrival day.
NO_DAY = "/".join(f"{name}=__HIVE_DEFAULT_PARTITION__" for name in DAY_COLUMNS)


def has_commit_log(spark: SparkSession, root: str) -> bool:
    """True for a table of the streaming file sink."""
    return files.exists(spark, f"{root.rstrip('/')}/_spark_metadata")


def require_writer(spark: SparkSession, root: str, *, commit_log: bool) -> None:
    """Refuse to mix the two kinds of writers in one table.

    Readers of a table with a commit log see the logged files only, so rows that
    another writer adds, or had added before, would silently be missing.
    """
    if has_commit_log(spark, root) == commit_log:
        return
    if commit_log and not files.matching(spark, f"{root.rstrip('/')}/arrival_year=*"):
        return
    kind = "without" if commit_log else "with"
    raise ValueError(f"{root} is a table {kind} a streaming commit log; use its own writer")


def in_contract_order(df: DataFrame) -> DataFrame:
    """Contract columns first and in order; extra columns follow.

    A Parquet read returns partition columns last, after the ingest time.
    """
    known = [name for name in BRONZE_COLUMNS if name in df.columns]
    extra = [name for name in df.columns if name not in BRONZE_COLUMNS]
    return df.select(*known, *extra)


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    paths = snapshots.paths_of_table(spark, root)
    return in_contract_order(spark.read.option("basePath", root).parquet(*paths))


def read_unroutable(spark: SparkSession, root: str) -> DataFrame | None:
    """Rows without an arrival day (default partition), or None if there are none.

    They belong to no logical date; their ingest time tells when they came.
    """
    folder = f"{root.rstrip('/')}/{NO_DAY}"
    if not files.exists(spark, folder):
        return None
    if has_commit_log(spark, root):
        rows = spark.read.parquet(root)
    else:
        paths = snapshots.paths_of_day(spark, root, NO_DAY)
        rows = spark.read.option("basePath", root).parquet(*paths)
    return in_contract_order(rows.where(F.col(DAY_COLUMNS[0]).isNull()))


def read_day(spark: SparkSession, root: str, logical_date: str) -> DataFrame:
    """All rows that arrived on ``logical_date``; a missing day raises.

    A table written by the streaming file sink is read through its root, whose
    commit log names exactly the committed files; the day is then a partition
    filter. Any other table is listed for that day's folder only, so the cost of
    planning does not grow with the age of the table. Of a day that was compacted, the
    folders that count are read (:mod:`paystrata.sources.snapshots`).
    """
    date = parse_logical_date(logical_date)
    folder = day_path(root, date)
    if not files.exists(spark, folder):
        raise DayNotFound(f"no bronze rows for {logical_date}: {folder}")
    if has_commit_log(spark, root):
        rows = spark.read.parquet(root)
    else:
        try:
            paths = snapshots.paths_of_day(spark, root, day_name(date))
            rows = spark.read.option("basePath", root).parquet(*paths)
        except AnalysisException as error:
            raise DayNotFound(f"no bronze rows for {logical_date}: {folder}") from error
    year, month, day = (F.col(name) for name in DAY_COLUMNS)
    return in_contract_order(
        rows.where((year == date.year) & (month == date.month) & (day == date.day))
    )


FILE_SCHEMA = "file string, length bigint, modified bigint"


def _below(path: Column, folder: str) -> Column:
    """Path relative to the table, which begins with the folder's last part."""
    return F.regexp_extract(path, f"({folder}.*)$", 1)


def file_manifest(df: DataFrame) -> DataFrame:
    """``file``, ``length``, ``modified``, ``rows`` of the Parquet files behind a table's rows.

    One job that reads no column. The files are those listed when ``df`` was made: all
    that is computed from ``df`` comes from them, whatever is written meanwhile.
    """
    return df.groupBy(
        _below(F.col("_metadata.file_path"), f"{DAY_COLUMNS[0]}=").alias("file"),
        F.col("_metadata.file_size").alias("length"),
        F.unix_millis("_metadata.file_modification_time").alias("modified"),
    ).agg(F.count(F.lit(1)).alias("rows"))


def present_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file``, ``length``, ``modified`` of what now lies below a folder (listing only)."""
    if not files.exists(spark, folder):
        return spark.createDataFrame([], FILE_SCHEMA)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return listing.load(folder).select(
        _below(F.col("path"), f"{DAY_COLUMNS[0]}=").alias("file"), "length", F.unix_millis("modificationTime").alias("modified")
    )


def read_listed(spark: SparkSession, root: str, names: Collection[str]) -> DataFrame:
    """Exactly the named files (relative to the table)."""
    paths = [f"{root.rstrip('/')}/{name}" for name in sorted(names)]
    return in_contract_order(spark.read.option("basePath", root).parquet(*paths))
