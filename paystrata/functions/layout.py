"""Where rows go before a partitioned write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cluster_for_write(
    df: DataFrame, columns: Sequence[str], files_per_partition: int
) -> DataFrame:
    """Bring rows of one output folder together in ``files_per_partition`` tasks.

    Without this every task writes a file into every folder it holds rows of.
    The salt is the number of the producing task, so it also splits a folder
    that holds a third of all rows, and even one made of identical rows, which a
    hash of the content would send to a single task. A recomputed task has the
    same number, so a retry sends its rows to the same places.
    """
    if files_per_partition < 1:
        raise ValueError("files_per_partition must be at least 1")
    salt = F.spark_partition_id() % F.lit(files_per_partition)
    # The salt has to be fixed before the exchange, hence the helper column.
    salted = df.withColumn("_write_salt", salt)
    return salted.repartition(*columns, "_write_salt").drop("_write_salt")
