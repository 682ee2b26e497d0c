"""Envelope to typed bronze rows, and back.

The same functions work on a batch and on a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.functions.ids import has_id
from paystrata.functions.times import parse_event_time
from paystrata.schema import (
    BRONZE_COLUMNS,
    CORRUPT_COLUMN,
    INGEST_COLUMN,
    PARSE_SCHEMA,
    TRANSACTION_COLUMNS,
    TRANSACTION_SCHEMA,
)

_ARRIVAL = "_arrival_time"

#: How far an arrival time may lie ahead of the ingest time: clocks differ a little.
CLOCK_TOLERANCE = "1 day"

# Reasons that leave a row without a usable identity or version: it stays in bronze
# and in the quarantine, and silver and the deduplicated stream do without it.
UNADDRESSABLE = ("empty_payload", "malformed_json", "no_fields", "no_id", "implausible_time")


def _with_arrival_parts(df: DataFrame) -> DataFrame:
    moment = F.col(_ARRIVAL)
    return (
        df.withColumn(_ARRIVAL, parse_event_time(F.col("arrival_timestamp")))
        .withColumns(
            {
                "arrival_year": F.year(moment),
                "arrival_month": F.month(moment),
                "arrival_day": F.dayofmonth(moment),
                "arrival_hour": F.hour(moment),
                INGEST_COLUMN: F.current_timestamp(),
            }
        )
        .drop(_ARRIVAL)
    )


def to_bronze(transactions: DataFrame) -> DataFrame:
    """Typed transactions with partition and ingest columns, in contract order.

    Rows whose arrival time does not parse get NULL partition values; they are
    kept, in the default partition.
    """
    return _with_arrival_parts(transactions).select(*BRONZE_COLUMNS)


def parse_transactions(envelopes: DataFrame) -> DataFrame:
    """Bronze rows of JSON envelopes. Nothing is rejected: text that is not a
    JSON object gives a row of NULLs, a field of the wrong type gives one NULL."""
    parsed = envelopes.select(
        F.from_json(F.col("value").cast("string"), TRANSACTION_SCHEMA).alias("record")
    )
    return to_bronze(parsed.select("record.*"))


def parse_with_diagnosis(envelopes: DataFrame) -> DataFrame:
    """Bronze rows plus ``key``, ``value`` and ``reason`` (NULL for a sound row).

    One parse serves both outputs: select the bronze columns for the table and
    :func:`quarantined` rows for the side output.

    Two details keep it right and fast. The explicit mode turns off Spark's
    pruning of unread JSON fields, which would leave errors in them unseen. And
    the record is unpacked by a generator, through which Spark does not push a
    filter on ``reason``: pushed, it would parse the text anew for every field
    the reason looks at.
    """
    text = F.col("value").cast("string")
    record = F.from_json(text, PARSE_SCHEMA, {"mode": "PERMISSIVE"})
    parsed = envelopes.select("key", "value", F.inline(F.array(record)))
    return _with_arrival_parts(parsed).withColumn("reason", _reason()).drop(CORRUPT_COLUMN)


def is_plausible() -> Column:
    """False where a bronze row claims to have arrived after it was ingested.

    A row without a readable arrival time is not implausible, only incomplete.
    """
    arrival = parse_event_time(F.col("arrival_timestamp"))
    latest = F.col(INGEST_COLUMN) + F.expr(f"INTERVAL {CLOCK_TOLERANCE}")
    return F.coalesce(arrival <= latest, F.lit(True))


def addressable(bronze: DataFrame) -> DataFrame:
    """Bronze rows with an id and a plausible version, as silver takes them.

    Exactly the rows whose reason is in :data:`UNADDRESSABLE` are left out, so what
    is missing here is in the quarantine.
    """
    return bronze.where(has_id(F.col("txn_id")) & is_plausible())


def _reason() -> Column:
    text = F.col("value").cast("string")
    nothing_parsed = F.coalesce(*(F.col(name).cast("string") for name in TRANSACTION_COLUMNS)).isNull()
    return (
        F.when(text.isNull() | (F.trim(text) == ""), "empty_payload")
        .when(F.col(CORRUPT_COLUMN).isNotNull() & nothing_parsed, "malformed_json")
        .when(nothing_parsed, "no_fields")
        .when(~has_id(F.col("txn_id")), "no_id")
        .when(~is_plausible(), "implausible_time")
        .when(F.col(CORRUPT_COLUMN).isNotNull(), "bad_field")
        .when(F.col("arrival_year").isNull(), "bad_arrival_time")
    )


def bronze_rows(diagnosed: DataFrame) -> DataFrame:
    """All rows of :func:`parse_with_diagnosis`, sound or not, as bronze."""
    return diagnosed.select(*BRONZE_COLUMNS)


def quarantined(diagnosed: DataFrame) -> DataFrame:
    """The rows that need a look, with their raw message and the reason."""
    return diagnosed.where(F.col("reason").isNotNull()).select("key", "value", "reason")


def encode_envelopes(transactions: DataFrame) -> DataFrame:
    """Message envelopes: the id as key, the row as JSON with explicit nulls."""
    record = F.to_json(F.struct(*TRANSACTION_COLUMNS), {"ignoreNullFields": "false"})
    key = F.when(F.col("txn_id") != "", F.col("txn_id").cast("binary"))
    return transactions.select(key.alias("key"), record.cast("binary").alias("value"))
