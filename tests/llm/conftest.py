from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from paystrata.llm.common import use_llm_conf  # noqa: E402

CLASHING = ("node", "tkey", "size", "class", "row", "token", "digest", "surt", "copies", "place", "bucket")


@pytest.fixture(scope="module")
def llm(spark):
    return use_llm_conf(spark)


@pytest.fixture(scope="session")
def clash():
    """Add columns whose names the operators use inside."""

    def add(df):
        return df.withColumns({name: F.lit("x") for name in CLASHING if name not in df.columns})

    return add
