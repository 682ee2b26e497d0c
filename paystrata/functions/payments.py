"""Predicates and formulas over transaction columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Smallest amount, spread of amounts, and the failure-risk mix.
MINIMUM_AMOUNT = 10.0
AMOUNT_SPREAD = 0.3
CATEGORY_RISK_SHARE = 0.4
METHOD_RISK_SHARE = 0.4
GATEWAY_RISK_SHARE = 0.2


def is_late() -> Column:
    """True where the event happened on a day before its arrival day."""
    return F.col("txn_timestamp") < F.substring("arrival_timestamp", 1, 10)


def is_failed() -> Column:
    return F.col("status") == "FAILED"


def percent_tenths(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` to one decimal, rounded half up.

    Both are counts; integer division makes the rounding exact, which a binary
    fraction such as 20.15 would not be.
    """
    tenths = F.call_function("div", F.lit(2000) * part + whole, F.lit(2) * whole)
    return tenths.cast("double") / F.lit(10.0)


def clamp_amount(amount: Column) -> Column:
    return F.round(F.greatest(F.lit(MINIMUM_AMOUNT), amount), 2)


def expected_amount(segment_average: Column, category_average: Column) -> Column:
    return (segment_average + category_average) / F.lit(2.0)


def amount_zscore(amount: Column, expected: Column) -> Column:
    return (amount - expected) / (expected * F.lit(AMOUNT_SPREAD))


def failure_probability(
    category_failure: Column, method_failure: Column, gateway_success: Column
) -> Column:
    return (
        category_failure * F.lit(CATEGORY_RISK_SHARE)
        + method_failure * F.lit(METHOD_RISK_SHARE)
        + (F.lit(1.0) - gateway_success) * F.lit(GATEWAY_RISK_SHARE)
    )
