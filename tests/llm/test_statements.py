"""Registered queries against their SQL twins, on whole tables."""

from __future__ import annotations

import pytest
from compare import difference, tables

from paystrata.llm.queries import QUERIES
from paystrata.llm.statements import STATEMENTS


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_query(spark, small, name):
    assert difference(QUERIES[name](spark, small), tables(small), STATEMENTS[name]) is None


def test_all_operators_are_registered():
    import __spark_entry__ as entry

    numbers = {name.split("_")[0] for name in entry.queries() if name.startswith("op")}
    assert numbers == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in entry.queries()
