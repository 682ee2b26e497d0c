"""Failure and late-arrival totals and rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paystrata.functions.payments import is_failed, is_late, percent_tenths
from paystrata.operators.ranking import global_rank

REPORT_EVERY = 1000
# Report points per second-level block of the running sum.
_POINTS_PER_BLOCK = 10_000


def late_arrivals(txns: DataFrame) -> DataFrame:
    return txns.where(is_late())


def failed_transactions(txns: DataFrame) -> DataFrame:
    return txns.where(is_failed())


def totals(txns: DataFrame) -> DataFrame:
    """Published, failed and late rows; valid on a batch and on a stream."""
    return txns.agg(
        F.count(F.lit(1)).alias("published"),
        F.count_if(is_failed()).alias("failed"),
        F.count_if(is_late()).alias("late"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Add both rates, in percent with one decimal."""
    published = F.col("published")
    return counts.withColumns(
        {
            "failure_rate": F.when(published > 0, percent_tenths(F.col("failed"), published)),
            "late_rate": F.when(published > 0, percent_tenths(F.col("late"), published)),
        }
    )


def running_rates(txns: DataFrame, sequence: str, every: int = REPORT_EVERY) -> DataFrame:
    """Totals and rates since the start, at every ``every`` published rows.

    ``sequence`` orders the rows as they were published; it may start anywhere
    and have gaps, because rows are counted by their rank (a range sort of three
    columns, which runs a job). Rows are then reduced to one record per report
    point. The running sum over points has two levels, because one window over all
    of them would be a single task: sums of blocks of 10,000 points (one per 10
    million rows) are accumulated first and then added to a window inside each
    block.
    """
    narrow = txns.select(
        F.col(sequence).alias("_order"), is_failed().alias("_failed"), is_late().alias("_late")
    )
    ranked = global_rank(narrow, F.col("_order").asc_nulls_last(), name="_rank")
    point = F.call_function("div", F.col("_rank") - 1, F.lit(every))
    points = (
        ranked.groupBy(point.alias("point"))
        .agg(
            F.count(F.lit(1)).alias("published"),
            F.count_if("_failed").alias("failed"),
            F.count_if("_late").alias("late"),
        )
        .withColumn("block", F.call_function("div", F.col("point"), F.lit(_POINTS_PER_BLOCK)))
    )
    measures = ("published", "failed", "late")
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = points.groupBy("block").agg(*(F.sum(name).alias(name) for name in measures))
    before = blocks.select(
        "block",
        *(
            F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"before_{name}")
            for name in measures
        ),
    )
    so_far = (
        Window.partitionBy("block")
        .orderBy("point")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = points.join(before, "block").select(
        *(
            (F.col(f"before_{name}") + F.sum(name).over(so_far)).alias(name)
            for name in measures
        )
    )
    return with_rates(running.where(F.col("published") % every == 0))
