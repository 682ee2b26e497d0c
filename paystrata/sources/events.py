"""Transactions derived from an ``events`` table.

The mapping is a pure projection: it adds no shuffle, stays in whole-stage
codegen but for the JSON lookup, and lets Catalyst prune event columns nobody
asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.functions.ids import padded_id
from paystrata.functions.times import days_before, event_time_text
from paystrata.schema import TRANSACTION_COLUMNS

# What each small integer of an event stands for.
SEGMENTS = ("premium", "regular", "new", "dormant")
CATEGORIES = (
    "food_delivery", "ecommerce", "utilities", "entertainment",
    "travel", "grocery", "healthcare", "fuel",
)
GATEWAY_IDS = ("GW-001", "GW-002", "GW-003", "GW-004")
GATEWAY_NAMES = ("Razorpay", "PayU", "Cashfree", "Unknown")
PROCESSOR_IDS = ("PRC-001", "PRC-002", "PRC-004", "PRC-001")
PROCESSOR_NAMES = ("NPCI", "Visa", "RBI_NEFT", "NPCI")
METHODS = ("UPI", "CARD", "NETBANKING", "WALLET")
REASONS = ("INSUFFICIENT_FUNDS", "TIMEOUT", "BANK_DECLINED")
DEVICES = ("mobile", "desktop", "tablet")
CITIES = ("Mumbai", "Delhi")
STATES = ("Maharashtra", "Delhi")


def _pick(values: tuple[str, ...], number: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), (number % len(values)).cast("int"))


def transactions_from_events(events: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 20 transaction columns, and any event columns named in ``keep``."""
    event_id, user = F.col("event_id"), F.col("user_id")
    days_late = F.when(
        event_id % 20 == 0, 1 + F.call_function("div", event_id, F.lit(20)) % 7
    ).otherwise(0)
    # Prepared first, because several columns need each and the JSON lookup
    # should run once per row.
    prepared = events.withColumns(
        {
            "_bucket": F.get_json_object("props", "$.k").cast("int"),
            "_arrival": F.col("ts").cast("timestamp"),
            "_days_late": days_late.cast("int"),
        }
    )
    bucket, arrival = F.col("_bucket"), F.col("_arrival")
    failed = F.col("event_type") == "error"
    other_card = event_id % 25 == 0

    columns = {
        "txn_id": F.concat(F.lit("TXN-"), F.lpad(F.hex(event_id), 12, "0")),
        "txn_timestamp": event_time_text(days_before(arrival, F.col("_days_late"))),
        "arrival_timestamp": event_time_text(arrival),
        "amount": F.col("value"),
        "currency": F.lit("INR"),
        "status": F.when(failed, "FAILED").otherwise("SUCCESS"),
        "failure_reason": F.when(failed, _pick(REASONS, event_id)),
        "user_id": padded_id("USR-", user),
        "user_segment": _pick(SEGMENTS, user),
        "merchant_id": padded_id("MRC-", bucket),
        "merchant_category": _pick(CATEGORIES, bucket),
        "gateway_id": _pick(GATEWAY_IDS, bucket),
        "gateway_name": _pick(GATEWAY_NAMES, bucket),
        "processor_id": F.when(other_card, "PRC-003").otherwise(_pick(PROCESSOR_IDS, event_id)),
        "processor_name": F.when(other_card, "Mastercard").otherwise(
            _pick(PROCESSOR_NAMES, event_id)
        ),
        "payment_method": _pick(METHODS, event_id),
        "device_type": _pick(DEVICES, event_id),
        "location_city": _pick(CITIES, user),
        "location_state": _pick(STATES, user),
        "is_international": F.lit(False),
    }
    assert tuple(columns) == TRANSACTION_COLUMNS
    return prepared.select(
        *keep, *(value.alias(name) for name, value in columns.items())
    )


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/events.parquet")


def read_transactions(
    spark: SparkSession, folder: str, *, keep: tuple[str, ...] = ()
) -> DataFrame:
    return transactions_from_events(read_events(spark, folder), keep=keep)
