"""Gold rollups by route and day.

Rows are reduced to the finest grain first. Rollup and cube then expand those
few records instead of every transaction (a three-column cube would otherwise
multiply the input by eight before its aggregate).

The gold table keeps these records per event date. An update reads only the dates of
silver whose folder has changed, replaces their records and cubes the records of all
dates. (Subtracting replaced rows would not do: a minimum cannot be taken back, and
sums of doubles would drift.) A version file names the records and the cube, so that
readers see one state and nothing is overwritten.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.functions.payments import is_failed
from paystrata.operators import silver
from paystrata.schema import DAY_COLUMNS
from paystrata.sources import versions

ROUTE = ("gateway_id", "payment_method", "merchant_category")


def finest_grain(txns: DataFrame, *keys: str) -> DataFrame:
    return txns.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_txns"),
        F.count_if(is_failed()).alias("n_failed"),
        F.sum("amount").alias("amount_sum"),
        F.min("amount").alias("amount_min"),
        F.max("amount").alias("amount_max"),
    )


def _combined(grouped, *extra) -> DataFrame:
    merged = grouped.agg(
        F.sum("n_txns").alias("n_txns"),
        F.sum("n_failed").alias("n_failed"),
        F.sum("amount_sum").alias("amount_sum"),
        F.min("amount_min").alias("amount_min"),
        F.max("amount_max").alias("amount_max"),
        *extra,
    )
    return with_failure_rate(merged)


def with_failure_rate(rolled: DataFrame) -> DataFrame:
    return rolled.withColumn("failure_rate", F.col("n_failed") / F.col("n_txns"))


def route_summary(txns: DataFrame) -> DataFrame:
    return with_failure_rate(finest_grain(txns, *ROUTE))


def route_rollup(txns: DataFrame) -> DataFrame:
    """Subtotals gateway > method > category; ``grouping_level`` tells a subtotal
    from a NULL code."""
    grain = finest_grain(txns, *ROUTE)
    return _combined(grain.rollup(*ROUTE), F.grouping_id().alias("grouping_level"))


def route_cube(txns: DataFrame) -> DataFrame:
    return _cube(finest_grain(txns, *ROUTE))


def _cube(grain: DataFrame) -> DataFrame:
    return _combined(grain.cube(*ROUTE), F.grouping_id().alias("grouping_level"))


def daily_summary(bronze: DataFrame) -> DataFrame:
    return with_failure_rate(finest_grain(bronze, *DAY_COLUMNS))


def update_gold(spark: SparkSession, silver_path: str, path: str) -> list[str]:
    """Bring the route cube at ``path`` up to silver's newest version (runs jobs).

    Returns the event dates (or ``none``) that were read: those whose silver folder is
    not the one their records came from. Records of dates that silver no longer has
    are dropped. Updates may be skipped: nothing depends on which versions lie between.
    A run that dies has changed nothing; the next one removes what it left. One writer
    at a time; replaced folders stay until the second update after, for readers.
    """
    earlier = versions.listed(spark, path)
    state = versions.content(spark, earlier[-1]) if earlier else {"source": {}, "records": {}}
    _remove_unnamed(spark, path, earlier)
    source = silver.current_folders(spark, silver_path)
    changed = {slot: name for slot, name in source.items() if state["source"].get(slot) != name}
    if earlier and source.keys() == state["source"].keys() and not changed:
        return []
    root, load = path.rstrip("/"), uuid.uuid4().hex
    records = {slot: name for slot, name in state["records"].items() if slot in source and slot not in changed}
    if changed:
        grain = finest_grain(silver.read_folders(spark, silver_path, changed.values()), "slot", *ROUTE)
        grain.hint("rebalance", "slot").write.partitionBy("slot").parquet(f"{root}/records/{load}")
        records |= {slot: f"records/{load}/slot={slot}" for slot in changed}
    _cube(_records(spark, path, records)).write.parquet(f"{root}/cube/{load}")
    versions.publish(spark, path, earlier, {"source": source, "records": records, "cube": f"cube/{load}"})
    return sorted(changed)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """The route cube of the newest version."""
    earlier = versions.listed(spark, path)
    if not earlier:
        return _cube(_records(spark, path, {}))
    cube = versions.content(spark, earlier[-1])["cube"]
    return spark.read.parquet(f"{path.rstrip('/')}/{cube}")


def _records(spark: SparkSession, path: str, records: dict[str, str]) -> DataFrame:
    empty = finest_grain(spark.createDataFrame([], silver.SILVER_SCHEMA), *ROUTE)
    if not records:
        return empty
    return spark.read.schema(empty.schema).parquet(*(f"{path.rstrip('/')}/{name}" for name in sorted(records.values())))


def _remove_unnamed(spark: SparkSession, path: str, earlier: list[str]) -> None:
    states = [versions.content(spark, version) for version in earlier[-2:]]
    versions.remove_unnamed(spark, path, "records/*/slot=*", {n for s in states for n in s["records"].values()})
    versions.remove_unnamed(spark, path, "cube/*", {s["cube"] for s in states})
