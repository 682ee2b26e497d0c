"""Declarative row rules and the 19-rule bronze suite."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from paystrata.schema import BRONZE_COLUMNS

# Rule type names as they appear in reports.
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
MATCH_REGEX = "expect_column_values_to_match_regex"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
COLUMNS_IN_ORDER = "expect_table_columns_to_match_ordered_list"


@dataclass(frozen=True)
class Rule:
    """One rule; ``params`` are the arguments besides the column name."""

    rule_id: int
    rule_type: str
    column: str | None = None
    params: dict = field(default_factory=dict)

    @property
    def kwargs(self) -> str:
        """All arguments as JSON text, for reports."""
        named = {} if self.column is None else {"column": self.column}
        return json.dumps({**named, **self.params})

    @property
    def is_row_rule(self) -> bool:
        """True where one row is enough to tell whether it breaks the rule."""
        return self.rule_type in _ROW_CHECKS

    def unexpected(self) -> Column:
        """True on the rows that break this row rule; NULLs only break NOT_NULL."""
        value = F.col(self.column)
        if self.rule_type == NOT_NULL:
            return value.isNull()
        return value.isNotNull() & ~_ROW_CHECKS[self.rule_type](value, self.params)


_ROW_CHECKS = {
    NOT_NULL: lambda value, _: value.isNotNull(),
    MATCH_REGEX: lambda value, params: value.rlike(params["regex"]),
    BETWEEN: lambda value, params: value.between(params["min_value"], params["max_value"]),
    IN_SET: lambda value, params: value.isin(*params["value_set"]),
}


def columns_in_order(present: list[str], expected: list[str]) -> bool:
    """True where ``expected`` is an ordered subsequence of ``present``."""
    remaining = iter(present)
    return all(name in remaining for name in expected)


# The rules every arrival day must meet, in report order.
BRONZE_SUITE = (
    Rule(1, NOT_NULL, "txn_id"),
    Rule(2, UNIQUE, "txn_id"),
    Rule(3, MATCH_REGEX, "txn_id", {"regex": r"^TXN-[A-Z0-9]{12}$"}),
    Rule(4, NOT_NULL, "amount"),
    Rule(5, BETWEEN, "amount", {"min_value": 1.0, "max_value": 1000000.0}),
    Rule(6, IN_SET, "status", {"value_set": ["SUCCESS", "FAILED"]}),
    Rule(7, NOT_NULL, "status"),
    Rule(8, NOT_NULL, "user_id"),
    Rule(9, MATCH_REGEX, "user_id", {"regex": r"^USR-\d{6}$"}),
    Rule(10, IN_SET, "user_segment", {"value_set": ["premium", "regular", "new", "dormant"]}),
    Rule(11, NOT_NULL, "merchant_id"),
    Rule(12, MATCH_REGEX, "merchant_id", {"regex": r"^MRC-\d{6}$"}),
    Rule(
        13,
        IN_SET,
        "merchant_category",
        {
            "value_set": [
                "food_delivery", "ecommerce", "utilities", "entertainment",
                "travel", "grocery", "healthcare", "fuel",
            ]
        },
    ),
    Rule(14, IN_SET, "payment_method", {"value_set": ["UPI", "CARD", "NETBANKING", "WALLET"]}),
    Rule(15, NOT_NULL, "txn_timestamp"),
    Rule(16, NOT_NULL, "arrival_timestamp"),
    Rule(17, NOT_NULL, "gateway_id"),
    Rule(18, IN_SET, "gateway_id", {"value_set": ["GW-001", "GW-002", "GW-003"]}),
    Rule(19, COLUMNS_IN_ORDER, None, {"column_list": list(BRONZE_COLUMNS), "exact_match": False}),
)
