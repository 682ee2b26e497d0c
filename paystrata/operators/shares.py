"""Observed distributions next to the configured ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paystrata import dimensions as dims
from paystrata.functions.payments import is_failed
from paystrata.functions.times import event_hour, parse_event_time


def share_versus_weight(
    txns: DataFrame, value: Column, dim: dims.Dimension, key: str
) -> DataFrame:
    """Share of each value of a dimension against its normalised weight.

    Values the dimension does not know and values never observed both appear.
    Rows are reduced to one count per value first; the total is a scalar
    subquery over those counts, so no window gathers them in one task.
    """
    counts = txns.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n_txns"))
    total = counts.agg(F.sum("n_txns")).scalar()
    weights = dim.table(txns.sparkSession).select(
        F.col(key).alias("value"),
        # A window over a constant table of at most 24 rows.
        (F.col("weight") / F.sum("weight").over(Window.partitionBy())).alias("expected_share"),
    )
    observed = F.coalesce(F.col("n_txns"), F.lit(0))
    share = observed / total
    return counts.join(weights, "value", "full").select(
        "value",
        observed.alias("n_txns"),
        share.alias("observed_share"),
        "expected_share",
        (share - F.col("expected_share")).alias("share_difference"),
    )


def segment_shares(txns: DataFrame) -> DataFrame:
    return share_versus_weight(txns, F.col("user_segment"), dims.SEGMENT, "segment")


def category_shares(txns: DataFrame) -> DataFrame:
    return share_versus_weight(
        txns, F.col("merchant_category"), dims.MERCHANT_CATEGORY, "category"
    )


def method_shares(txns: DataFrame) -> DataFrame:
    return share_versus_weight(txns, F.col("payment_method"), dims.PAYMENT_METHOD, "method")


def reason_shares(txns: DataFrame) -> DataFrame:
    """Shares among failed transactions."""
    return share_versus_weight(
        txns.where(is_failed()), F.col("failure_reason"), dims.FAILURE_REASON, "reason"
    )


def city_shares(txns: DataFrame) -> DataFrame:
    return share_versus_weight(txns, F.col("location_city"), dims.LOCATION, "city")


def hour_shares(txns: DataFrame) -> DataFrame:
    """Hour-of-day profile of event time."""
    return share_versus_weight(
        txns, event_hour(F.col("txn_timestamp")), dims.HOUR_WEIGHT, "hour"
    )


def lateness_profile(txns: DataFrame) -> DataFrame:
    """Rows per number of days between event and arrival.

    ``n_ahead`` counts events whose time lies after their arrival; that happens
    within a day and, around midnight, as a negative number of days.
    """
    event = parse_event_time(F.col("txn_timestamp"))
    arrival = parse_event_time(F.col("arrival_timestamp"))
    days = F.date_diff(F.to_date(arrival), F.to_date(event))
    return txns.groupBy(days.alias("days_late")).agg(
        F.count(F.lit(1)).alias("n_txns"), F.count_if(event > arrival).alias("n_ahead")
    )
