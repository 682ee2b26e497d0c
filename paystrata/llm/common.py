"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.session import materialized, scratch_path, use_engine_conf
from paystrata.sources import files

#: A word is a run of bytes other than space, tab, newline, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

#: Python workers get few rows at a time, so that long texts fit in their memory.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}

#: The files of a query's shuffles go when it ends. Else they stay until the driver collects
#: its garbage, and those of all queries of an operator lie on disk together.
SHUFFLE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def use_llm_conf(spark: SparkSession) -> SparkSession:
    """Engine settings plus small Arrow batches and shuffles that go with their query."""
    use_engine_conf(spark)
    for key, value in {**BATCH_CONF, **SHUFFLE_CONF}.items():
        spark.conf.set(key, value)
    return spark


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut."""
    return materialized(df, scratch_path(df.sparkSession, label))


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``written`` that nothing will read any more."""
    for table in tables:
        for folder in {posixpath.dirname(name) for name in table.inputFiles()}:
            files.delete(table.sparkSession, folder)


def text_key(text: Column) -> Column:
    """16 bytes that name a text (half of its SHA-256); null counts as empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def held_out(doc_id: Column) -> Column:
    """Rows whose CRC-32 of the id as text leaves 2 when divided by 4; a null id is none."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def is_finite_vector(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components (a null vector: false)."""

    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return F.coalesce(~F.exists(vector, bad), F.lit(False))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


Query = Callable[[SparkSession, str], DataFrame]
