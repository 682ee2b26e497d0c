"""Dimension lookups and the formulas that need them.

Every dimension is a constant table of at most 24 rows whose size Catalyst
knows, so these joins are broadcast hash joins that do not move transactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata import dimensions as dims
from paystrata.functions.payments import (
    amount_zscore,
    expected_amount,
    failure_probability,
    is_failed,
)


def _lookup(txns: DataFrame, dim: dims.Dimension, key: str, on: str, columns: dict[str, str]) -> DataFrame:
    table = dim.table(txns.sparkSession).select(
        F.col(key).alias(on), *(F.col(name).alias(alias) for name, alias in columns.items())
    )
    return txns.join(table, on, "left")


def with_segment(txns: DataFrame) -> DataFrame:
    return _lookup(
        txns, dims.SEGMENT, "segment", "user_segment",
        {"avg_amount": "segment_avg_amount", "txn_frequency": "segment_frequency"},
    )


def with_category(txns: DataFrame) -> DataFrame:
    return _lookup(
        txns, dims.MERCHANT_CATEGORY, "category", "merchant_category",
        {"avg_amount": "category_avg_amount", "failure_rate": "category_failure_rate"},
    )


def with_gateway(txns: DataFrame) -> DataFrame:
    return _lookup(
        txns, dims.GATEWAY, "gateway_id", "gateway_id",
        {"success_rate": "gateway_success_rate", "avg_latency_ms": "gateway_latency_ms"},
    )


def with_method(txns: DataFrame) -> DataFrame:
    return _lookup(
        txns, dims.PAYMENT_METHOD, "method", "payment_method",
        {"failure_rate": "method_failure_rate", "processor": "method_processor"},
    )


def with_processor(txns: DataFrame) -> DataFrame:
    return _lookup(
        txns, dims.PROCESSOR, "processor_id", "processor_id",
        {"success_rate": "processor_success_rate", "settlement_hours": "settlement_hours"},
    )


def enrich(txns: DataFrame) -> DataFrame:
    """All five lookups; unknown codes keep the row, with NULLs."""
    for step in (with_segment, with_category, with_gateway, with_method, with_processor):
        txns = step(txns)
    return txns


def expected_failure(txns: DataFrame) -> DataFrame:
    """``failure_probability`` per row; NULL where a code is unknown."""
    looked_up = with_gateway(with_method(with_category(txns)))
    return looked_up.withColumn(
        "failure_probability",
        failure_probability(
            F.col("category_failure_rate"),
            F.col("method_failure_rate"),
            F.col("gateway_success_rate"),
        ),
    ).select(*txns.columns, "failure_probability")


def expected_versus_actual(txns: DataFrame) -> DataFrame:
    """Expected and actual failures per gateway, method and category.

    ``n_scored`` says how many rows had a probability, so a route with an
    unknown gateway shows its failures without pretending to expect none.
    """
    return (
        expected_failure(txns)
        .groupBy("gateway_id", "payment_method", "merchant_category")
        .agg(
            F.count(F.lit(1)).alias("n_txns"),
            F.count("failure_probability").alias("n_scored"),
            F.sum("failure_probability").alias("expected_failures"),
            F.count_if(is_failed()).alias("actual_failures"),
        )
    )


def amount_scores(txns: DataFrame) -> DataFrame:
    """``expected_amount`` and ``amount_zscore`` per row."""
    mean = expected_amount(F.col("segment_avg_amount"), F.col("category_avg_amount"))
    return (
        with_category(with_segment(txns))
        .withColumn("expected_amount", mean)
        .withColumn("amount_zscore", amount_zscore(F.col("amount"), F.col("expected_amount")))
        .select(*txns.columns, "expected_amount", "amount_zscore")
    )
