"""Row-level duplicate detection that stays balanced under hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Unless stated otherwise, a key is hot when it holds at least this share of all
# rows and at least this many rows. The share alone bounds the number of hot keys:
# 10,000. Both ways give the same rows.
HOT_SHARE = 1 / 10_000
HOT_ROWS = 100_000


def group_sizes(df: DataFrame, key: str = "txn_id") -> DataFrame:
    """Rows per non-null key. Tasks count before the shuffle, so a hot key costs
    one record per task."""
    present = df.where(F.col(key).isNotNull())
    return present.groupBy(key).agg(F.count(F.lit(1)).alias("group_size"))


def _with_group_size(df: DataFrame, key: str, hot_share: float, hot_rows: int) -> DataFrame:
    """Attach ``group_size`` (NULL where the key occurs once or is NULL).

    A window over the key would put a whole group into one task, and so would a
    plain join with the counted groups. Hot keys are therefore looked up in a
    broadcast table, which the hot share bounds (1/share records) whatever the
    size of the data. Only the other repeated keys are joined by key, and in that
    join the hot and the NULL-keyed rows, which have no partner there, are
    scattered by the task that read them. AQE turns that join into a broadcast
    too when it measures the repeated keys to be few.
    """
    sizes = group_sizes(df, key).where(F.col("group_size") > 1)
    rows = df.agg(F.count(F.lit(1))).scalar()
    is_hot = F.col("group_size") >= F.greatest(rows * F.lit(hot_share), F.lit(float(hot_rows)))
    hot = sizes.where(is_hot).select(key, F.col("group_size").alias("_hot_size"))
    by_key = F.xxhash64(key)
    cold = sizes.where(~is_hot).select(
        key, F.col("group_size").alias("_cold_size"), by_key.alias("_spread")
    )
    # The number of a task survives its retry, unlike a random salt.
    scatter = F.spark_partition_id().cast("bigint")
    looked_up = df.join(F.broadcast(hot), key, "left").withColumn(
        "_spread",
        F.when(F.col(key).isNull() | F.col("_hot_size").isNotNull(), scatter).otherwise(by_key),
    )
    return looked_up.join(cold, [key, "_spread"], "left").select(
        *(looked_up[name] for name in df.columns),
        F.coalesce("_hot_size", "_cold_size").alias("group_size"),
    )


def duplicate_rows(
    df: DataFrame, key: str = "txn_id", *, hot_share: float = HOT_SHARE, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """All members of every duplicate group, with ``group_size``."""
    sized = _with_group_size(df, key, hot_share, hot_rows)
    return sized.where(F.col("group_size").isNotNull())


def mark_duplicates(
    df: DataFrame, key: str = "txn_id", *, hot_share: float = HOT_SHARE, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every row of ``df`` with ``is_duplicate``; NULL keys are never duplicates."""
    marked = _with_group_size(df, key, hot_share, hot_rows)
    return marked.select(*df.columns, F.col("group_size").isNotNull().alias("is_duplicate"))
