from __future__ import annotations

import json
import math

import pytest
from payment_rows import good, plan_text
from hypothesis import given
from hypothesis import strategies as st

from paystrata.operators import parse, validation
from paystrata.operators.rules import BRONZE_SUITE, columns_in_order
from paystrata.schema import BRONZE_COLUMNS


def summary(df, **options):
    return {row.rule_id: row for row in validation.summarize_rules(df, **options).collect()}


# One value that breaks each row rule.
BREAKING = {
    1: None, 3: "TXN-12345", 4: None, 5: 0.99, 6: "PENDING", 7: None, 8: None, 9: "USR-1",
    10: "vip", 11: None, 12: "MRC-12345x", 13: "toys", 14: "CASH", 15: None, 16: None, 17: None,
    18: "GW-004",
}
ROW_RULES = [rule for rule in BRONZE_SUITE if rule.is_row_rule]


def test_the_suite_has_nineteen_rules():
    assert [rule.rule_id for rule in BRONZE_SUITE] == list(range(1, 20))
    assert len(ROW_RULES) == 17


def test_sound_rows_pass(transactions):
    result = summary(parse.to_bronze(transactions(5)))
    assert sorted(result) == list(range(1, 20))
    assert all(row.success for row in result.values())
    assert result[3].element_count == 5 and result[3].unexpected_percent == 0.0


@pytest.mark.parametrize("rule", ROW_RULES, ids=lambda rule: f"rule{rule.rule_id}")
def test_each_rule_fails_on_its_breaking_value(transactions, rule):
    rows = [good(txn_id=f"TXN-{n:012X}") for n in range(3)]
    rows.append(good(txn_id="TXN-00000000000Z") | {rule.column: BREAKING[rule.rule_id]})
    result = summary(parse.to_bronze(transactions(rows)))
    row = result[rule.rule_id]
    assert not row.success
    assert (row.element_count, row.unexpected_count) == (4, 1)
    assert row.unexpected_percent == row.unexpected_percent_total == 25.0
    # A NULL breaks the not-null rule of its column and no other.
    broken = {r.rule_id for r in result.values() if not r.success}
    assert broken == {rule.rule_id}


def test_boundaries_are_inclusive_and_nan_is_out(transactions):
    amounts = [1.0, 1e6, 0.999, 1000000.01, math.nan, None]
    rows = [good(txn_id=f"TXN-{n:012X}", amount=a) for n, a in enumerate(amounts)]
    row = summary(parse.to_bronze(transactions(rows)))[5]
    assert (row.unexpected_count, row.missing_count) == (3, 1)
    assert row.unexpected_percent == 60.0 and row.unexpected_percent_total == 50.0


def test_uniqueness_counts_all_members_and_ignores_nulls(transactions):
    ids = ["TXN-00000000000A"] * 3 + ["TXN-00000000000B"] * 2 + ["TXN-00000000000C", None, None]
    row = summary(parse.to_bronze(transactions([good(txn_id=i) for i in ids])))[2]
    assert (row.element_count, row.missing_count, row.unexpected_count) == (8, 2, 5)
    assert not row.success


def test_trailing_newline_is_accepted(transactions):
    rows = transactions([good(user_id="USR-000001\n")])
    assert summary(parse.to_bronze(rows))[9].success


def test_empty_table(transactions):
    result = summary(parse.to_bronze(transactions(3)).where("false"))
    assert len(result) == 19 and all(row.success for row in result.values())
    assert result[5].element_count == 0 and result[5].unexpected_percent is None
    assert result[2].element_count == 0


def test_missing_column_fails_only_its_rules(transactions):
    result = summary(parse.to_bronze(transactions(3)).drop("amount", "txn_id"))
    errors = {i: row.error for i, row in result.items() if row.error}
    assert errors == dict.fromkeys([1, 2, 3, 4, 5], "column_missing")
    assert {i for i, row in result.items() if not row.success} == {1, 2, 3, 4, 5, 19}


def test_groups_are_judged_apart(transactions):
    rows = [
        good(txn_id="TXN-00000000000A"),
        good(txn_id="TXN-00000000000A", arrival_timestamp="2024-01-16T00:00:00.000Z"),
        good(txn_id="TXN-00000000000B", arrival_timestamp="2024-01-16T00:00:00.000Z", amount=0.1),
    ]
    bronze = parse.to_bronze(transactions(rows))
    by_day = validation.summarize_rules(bronze, by=["arrival_day"])
    failed = {(r.arrival_day, r.rule_id) for r in by_day.where("not success").collect()}
    assert failed == {(16, 5)}  # the repeated id is unique within each day
    verdicts = validation.suite_statistics(by_day, by=["arrival_day"]).collect()
    assert {r.arrival_day: r.success for r in verdicts} == {15: True, 16: False}


def test_one_scan_and_no_shuffle_of_rows_for_the_row_rules(transactions, spark, tmp_path):
    path = str(tmp_path / "t")
    parse.to_bronze(transactions(5)).write.parquet(path)
    table = spark.read.parquet(path)
    rules = [rule for rule in BRONZE_SUITE if rule.is_row_rule]
    plan = validation.summarize_rules(table, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange") == 1
    assert "partial_count" in plan
    assert "location_city" not in plan  # columns without a rule are not read


def test_samples_are_the_most_frequent_with_ties_by_value(transactions):
    statuses = ["A"] * 3 + ["C"] * 2 + ["B"] * 2 + [f"X{n:02}" for n in range(30)]
    rows = [good(txn_id=f"TXN-{n:012X}", status=s) for n, s in enumerate(statuses)]
    samples = validation.unexpected_samples(parse.to_bronze(transactions(rows))).collect()
    listed = [(r.value, r.n) for r in sorted(samples, key=lambda r: r.place)]
    assert listed[:4] == [("A", 3), ("B", 2), ("C", 2), ("X00", 1)]
    assert len(listed) == 20


def test_sampling_limits_values_before_the_shuffle(transactions):
    plan = plan_text(validation.unexpected_samples(parse.to_bronze(transactions(3))))
    assert plan.count("WindowGroupLimit") == 2


def test_report_lists_failures_with_arguments(transactions):
    rows = [good(txn_id=f"TXN-{n:012X}", amount=0.5) for n in range(2)]
    bronze = parse.to_bronze(transactions(rows))
    result = validation.summarize_rules(bronze)
    report = validation.suite_report(result, validation.unexpected_samples(bronze)).first()
    assert not report.success
    assert report.statistics.evaluated_expectations == 19
    assert report.statistics.unsuccessful_expectations == 1
    (failure,) = report.failed_expectations
    assert json.loads(failure.kwargs)["min_value"] == 1.0
    assert failure.result.unexpected_count == 2
    assert [tuple(s) for s in failure.result.partial_unexpected_counts] == [("0.5", 2)]


def test_groups_keyed_by_null_keep_their_samples(transactions):
    rows = [
        good(txn_id=f"TXN-{n:012X}", payment_method=method, amount=0.5)
        for n, method in enumerate(["UPI", None, None])
    ]
    bronze, by = parse.to_bronze(transactions(rows)), ["payment_method"]
    report = validation.suite_report(
        validation.summarize_rules(bronze, by=by), validation.unexpected_samples(bronze, by=by), by
    )
    samples = {
        r.payment_method: r.failed_expectations[0].result.partial_unexpected_counts[0]["count"]
        for r in report.collect()
    }
    assert samples == {"UPI": 1, None: 2}


@given(st.lists(st.sampled_from("abcdef"), unique=True), st.data())
def test_any_subsequence_is_in_order(columns, data):
    chosen = [name for name in columns if data.draw(st.booleans())]
    assert columns_in_order(columns, chosen)
    if len(chosen) > 1:
        assert not columns_in_order(columns, chosen[::-1])


def test_extra_columns_are_allowed_but_order_counts():
    assert columns_in_order([*BRONZE_COLUMNS, "extra"], list(BRONZE_COLUMNS))
    assert not columns_in_order(list(reversed(BRONZE_COLUMNS)), list(BRONZE_COLUMNS))
