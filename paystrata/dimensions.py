"""Reference dimensions: segments, categories, gateways, processors and so on.

Each dimension becomes an inline ``VALUES`` relation. Catalyst then knows its
exact size, so a join with it is broadcast because it was measured to be small,
not because a hint said so.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Dimension:
    """Rows of one reference table; ``columns`` pairs a name with a SQL type."""

    name: str
    columns: tuple[tuple[str, str], ...]
    rows: tuple[tuple, ...]

    @property
    def column_names(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.columns)

    def table(self, spark: SparkSession) -> DataFrame:
        """The dimension, led by ``position`` (its row's place, from 1)."""
        rows = ", ".join(
            "(" + ", ".join([str(place), *map(_literal, row)]) + ")"
            for place, row in enumerate(self.rows, start=1)
        )
        names = ", ".join(("position", *self.column_names))
        casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in self.columns)
        return spark.sql(f"SELECT position, {casts} FROM VALUES {rows} AS t({names})")


def _literal(value) -> str:
    if isinstance(value, tuple):
        return "array(" + ", ".join(map(_literal, value)) + ")"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("'", "''") + "'"


# The reference tables of the payment platform.
SEGMENT = Dimension(
    "segment",
    (("segment", "STRING"), ("weight", "DOUBLE"), ("avg_amount", "DOUBLE"), ("txn_frequency", "DOUBLE")),
    (
        ("premium", 0.10, 5000.0, 0.40),
        ("regular", 0.60, 800.0, 0.45),
        ("new", 0.20, 300.0, 0.10),
        ("dormant", 0.10, 150.0, 0.05),
    ),
)
MERCHANT_CATEGORY = Dimension(
    "merchant_category",
    (("category", "STRING"), ("weight", "DOUBLE"), ("avg_amount", "DOUBLE"), ("failure_rate", "DOUBLE")),
    (
        ("food_delivery", 0.25, 400.0, 0.03),
        ("ecommerce", 0.20, 1200.0, 0.04),
        ("utilities", 0.15, 2500.0, 0.02),
        ("entertainment", 0.10, 600.0, 0.05),
        ("travel", 0.10, 8000.0, 0.08),
        ("grocery", 0.10, 350.0, 0.02),
        ("healthcare", 0.05, 1500.0, 0.03),
        ("fuel", 0.05, 2000.0, 0.02),
    ),
)
GATEWAY = Dimension(
    "gateway",
    (
        ("gateway_id", "STRING"),
        ("name", "STRING"),
        ("success_rate", "DOUBLE"),
        ("avg_latency_ms", "INT"),
        ("supported_methods", "ARRAY<STRING>"),
    ),
    (
        ("GW-001", "Razorpay", 0.97, 120, ("UPI", "CARD", "NETBANKING", "WALLET")),
        ("GW-002", "PayU", 0.95, 180, ("UPI", "CARD", "NETBANKING")),
        ("GW-003", "Cashfree", 0.96, 150, ("UPI", "CARD", "WALLET")),
    ),
)
PROCESSOR = Dimension(
    "processor",
    (
        ("processor_id", "STRING"),
        ("name", "STRING"),
        ("supported_methods", "ARRAY<STRING>"),
        ("success_rate", "DOUBLE"),
        ("settlement_hours", "INT"),
    ),
    (
        ("PRC-001", "NPCI", ("UPI",), 0.97, 0),
        ("PRC-002", "Visa", ("CARD",), 0.95, 24),
        ("PRC-003", "Mastercard", ("CARD",), 0.94, 24),
        ("PRC-004", "RBI_NEFT", ("NETBANKING",), 0.98, 2),
    ),
)
PAYMENT_METHOD = Dimension(
    "payment_method",
    (("method", "STRING"), ("weight", "DOUBLE"), ("failure_rate", "DOUBLE"), ("processor", "STRING")),
    (
        ("UPI", 0.55, 0.025, "PRC-001"),
        ("CARD", 0.25, 0.060, "PRC-002"),
        ("NETBANKING", 0.12, 0.040, "PRC-004"),
        ("WALLET", 0.08, 0.030, "PRC-001"),
    ),
)
FAILURE_REASON = Dimension(
    "failure_reason",
    (("reason", "STRING"), ("weight", "DOUBLE")),
    (
        ("INSUFFICIENT_FUNDS", 0.35),
        ("BANK_DECLINED", 0.20),
        ("TIMEOUT", 0.15),
        ("INVALID_CREDENTIALS", 0.10),
        ("GATEWAY_ERROR", 0.10),
        ("DAILY_LIMIT_EXCEEDED", 0.05),
        ("FRAUD_SUSPECTED", 0.05),
    ),
)
LOCATION = Dimension(
    "location",
    (("city", "STRING"), ("state", "STRING"), ("weight", "DOUBLE")),
    (
        ("Mumbai", "Maharashtra", 0.20),
        ("Delhi", "Delhi", 0.18),
        ("Bangalore", "Karnataka", 0.15),
        ("Hyderabad", "Telangana", 0.10),
        ("Chennai", "Tamil Nadu", 0.08),
        ("Kolkata", "West Bengal", 0.07),
        ("Pune", "Maharashtra", 0.06),
        ("Ahmedabad", "Gujarat", 0.05),
        ("Jaipur", "Rajasthan", 0.04),
        ("Lucknow", "Uttar Pradesh", 0.03),
        ("Other", "Other", 0.04),
    ),
)
# The hour weights sum to 1.08; readers normalise them.
_HOUR_WEIGHTS = (
    0.01, 0.01, 0.01, 0.01, 0.01, 0.02, 0.03, 0.04,
    0.05, 0.06, 0.06, 0.06, 0.07, 0.07, 0.06, 0.05,
    0.05, 0.05, 0.06, 0.07, 0.08, 0.07, 0.05, 0.03,
)
HOUR_WEIGHT = Dimension(
    "hour_weight",
    (("hour", "INT"), ("weight", "DOUBLE")),
    tuple(enumerate(_HOUR_WEIGHTS)),
)
# A card payment may also settle through this processor besides its mapped one.
CARD_ALTERNATIVE = ("CARD", "PRC-003")
# Size of the simulated pool of merchants, for the rank weights.
MERCHANT_POOL_SIZE = 1000

DIMENSIONS = {
    dim.name: dim
    for dim in (
        SEGMENT,
        MERCHANT_CATEGORY,
        GATEWAY,
        PROCESSOR,
        PAYMENT_METHOD,
        FAILURE_REASON,
        LOCATION,
        HOUR_WEIGHT,
    )
}
