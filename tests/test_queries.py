"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest
from compare import difference, tables

import __spark_entry__ as entry_module
from paystrata.plans.oracle import statements
from paystrata.plans.queries import QUERIES

STATEMENTS = statements()


@pytest.fixture(scope="module")
def duck(small):
    return tables(small)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(STATEMENTS) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, small, duck, name):
    result = QUERIES[name](spark, small)
    assert difference(result, duck, STATEMENTS[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() == 531


def test_golden_counts(spark, small):
    run = entry_module.queries()
    totals = run["failure_late_rates"](spark, small).first()
    assert (totals.published, totals.failed, totals.late) == (1000, 201, 50)
    assert run["day_scan"](spark, small).count() == 26
    assert run["processor_mismatch"](spark, small).count() == 30
    broken = {r.rule_id: r.unexpected_count for r in run["failed_rules"](spark, small).collect()}
    assert broken == {5: 10, 18: 247}
