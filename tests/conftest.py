from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from payment_rows import good  # noqa: E402
from paystrata.schema import TRANSACTION_COLUMNS, TRANSACTION_SCHEMA  # noqa: E402
from paystrata.session import use_engine_conf  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("paystrata-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield use_engine_conf(session)
    session.stop()


@pytest.fixture
def conf(spark):
    """Change settings for one test."""
    before = {}

    def change(**settings):
        for key, value in settings.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def transactions(spark):
    """Build transactions from dicts, or from a count of sound rows."""

    def build(rows):
        if isinstance(rows, int):
            rows = [good(txn_id=f"TXN-{n:012X}") for n in range(rows)]
        values = [tuple(row[name] for name in TRANSACTION_COLUMNS) for row in rows]
        return spark.createDataFrame(values, TRANSACTION_SCHEMA)

    return build
