"""Deterministic weighted assignment of rows to the values of a dimension."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paystrata import dimensions as dims
from paystrata.functions.ids import padded_id, unit_interval


@dataclass(frozen=True)
class Intervals:
    """A cut of [0, 1) into ``size`` intervals: value, lower and upper bound."""

    table: DataFrame
    size: int


def weight_intervals(choices: DataFrame, size: int, value: str, weight: Column) -> Intervals:
    """One interval per row of ``choices``, as wide as its share of the weight.

    ``choices`` has ``size`` rows numbered by ``position``; it is a dimension or
    a pool, so its running sum is one small window.
    """
    upto = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    last = F.col("position") == F.max("position").over(everything)
    share = F.round(F.sum(weight).over(upto) / F.sum(weight).over(everything), 12)
    ends = choices.select(
        "position",
        F.col(value).alias("value"),
        # The last interval ends at 1 exactly, so that every row finds a value.
        F.when(last, F.lit(1.0)).otherwise(share).alias("upper"),
    )
    previous = F.lag("upper", 1, 0.0).over(Window.orderBy("position"))
    return Intervals(ends.select("value", previous.alias("lower"), "upper"), size)


def assign_by_weight(
    df: DataFrame, key: Column, intervals: Intervals, name: str, *, cells: int = 64
) -> DataFrame:
    """Add column ``name``: the value whose interval holds the key's uniform number.

    The range lookup is an equality join on a grid cell plus a range condition,
    a hash join instead of a nested loop. The grid has at most ``cells`` records
    more than there are intervals; choose as many cells as intervals for a large
    pool. The planner decides from its size whether it is broadcast; a shuffle by
    cell is balanced, because the numbers are uniform.
    """
    number = F.col("_uniform")
    grid = intervals.table.select(
        F.explode(
            F.sequence(F.floor(F.col("lower") * cells), F.ceil(F.col("upper") * cells) - 1)
        ).alias("_cell"),
        F.col("value").alias(name),
        F.col("lower").alias("_lower"),
        F.col("upper").alias("_upper"),
    ).where(F.col("_lower") < F.col("_upper"))
    placed = df.withColumn("_uniform", unit_interval(key)).withColumn(
        "_cell", F.floor(number * cells)
    )
    inside = (
        (placed["_cell"] == grid["_cell"])
        & (number >= F.col("_lower"))
        & (number < F.col("_upper"))
    )
    return placed.join(grid, inside, "left").select(*df.columns, name)


def draw_from_dimension(
    key: Column, dim: dims.Dimension, value: str, weigh: Callable[[dict], float] | None = None
) -> Column:
    """The dimension's value whose interval holds the key's uniform number.

    A dimension's weights are constants (at most 24), so its bounds are too: the
    draw is a lookup in a literal array, a plain projection. ``weigh`` gives a
    row's weight, its ``weight`` unless stated.
    """
    rows = [dict(zip(dim.column_names, row)) for row in dim.rows]
    weights = [weigh(row) if weigh else row["weight"] for row in rows]
    total, reached, uppers = sum(weights), 0.0, []
    for weight in weights:
        reached += weight
        uppers.append(round(reached / total, 12))
    uppers[-1] = 1.0  # so that every row finds a value
    bounds = F.array(*(F.struct(F.lit(u).alias("upper"), F.lit(r[value]).alias("value")) for u, r in zip(uppers, rows)))
    number = unit_interval(key)

    def pick(drawn: Column) -> Column:
        return F.get(F.filter(bounds, lambda bound: drawn < bound["upper"]), F.lit(0))["value"]

    # As a lambda's variable the number is computed once, not once per bound.
    return F.get(F.transform(F.array(number), pick), F.lit(0))


def dimension_intervals(spark: SparkSession, dim: dims.Dimension, key: str) -> Intervals:
    return weight_intervals(dim.table(spark), len(dim.rows), key, F.col("weight"))


def merchant_intervals(spark: SparkSession, merchants: int = dims.MERCHANT_POOL_SIZE) -> Intervals:
    """Merchants 1..n with weight 1/rank."""
    pool = spark.range(1, merchants + 1, numPartitions=1).select(
        F.col("id").alias("position"), padded_id("MRC-", F.col("id")).alias("merchant_id")
    )
    return weight_intervals(pool, merchants, "merchant_id", F.lit(1.0) / F.col("position"))


def frequency_intervals(spark: SparkSession) -> Intervals:
    """Segments weighted by head count times transaction frequency: the segment
    mix that drawing users by their frequency produces."""
    return weight_intervals(
        dims.SEGMENT.table(spark),
        len(dims.SEGMENT.rows),
        "segment",
        F.col("weight") * F.col("txn_frequency"),
    )
