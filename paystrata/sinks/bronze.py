"""Batch writes of the bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from paystrata.schema import PARTITION_COLUMNS
from paystrata.sources.bronze import require_writer


def append_bronze(bronze: DataFrame, root: str, *, rebalance: bool = True) -> None:
    """Append rows to the hourly-partitioned table (backfill; runs a job).

    The rebalance lets AQE decide the files per hour from measured sizes: small
    hours share a task, a hot hour (or the default partition of malformed rows)
    is split, and no task opens a file in every hour it has rows for. It costs
    one shuffle; leave it out where the input already arrives hour by hour.
    """
    require_writer(bronze.sparkSession, root, commit_log=False)
    rows = bronze.hint("rebalance", *PARTITION_COLUMNS) if rebalance else bronze
    rows.write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(root)
