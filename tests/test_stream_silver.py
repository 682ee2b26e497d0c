from __future__ import annotations

import itertools
import time

import pytest
from payment_rows import good
from pyspark.sql import functions as F

from paystrata.operators import parse, silver
from paystrata.schema import TRANSACTION_COLUMNS
from paystrata.sinks.envelopes import publish_to_files
from paystrata.sources import versions
from paystrata.sources.envelopes import stream_from_files
from paystrata.streaming.silver import start_silver


@pytest.fixture
def feed(spark, transactions, tmp_path):
    """Deliver rows, let the stream take them and return its last progress."""
    inbox, path, checkpoint = (str(tmp_path / name) for name in ("in", "silver", "ck"))

    def run(rows, delay="1 hour"):
        if rows:
            publish_to_files(transactions(rows), inbox)
        bronze = parse.parse_transactions(stream_from_files(spark, inbox))
        query = start_silver(bronze, path, checkpoint, delay, available_now=True)
        query.awaitTermination()
        return query.recentProgress

    run.path = path
    return run


def arriving(day, **changes):
    return good(arrival_timestamp=f"2024-01-{day}T10:00:00.000Z", **changes)


def test_the_order_as_one_value_chooses_as_the_window_does(spark, transactions):
    times = ["2024-01-15T10:00:00.99Z", "2024-01-15T10:00:00.995Z", "2024-01-14T10:00:00Z", "not a time", "not", "", None]
    devices = ["mobile", None, "tablet"]
    rows = [
        good(txn_id=f"TXN-{n:012X}", arrival_timestamp=a, txn_timestamp=t, device_type=d, amount=x)
        for n, picked in enumerate(itertools.combinations(times, 3))
        for a, t, d, x in itertools.product(picked, times[:4], devices, (1.0, None))
    ]
    table = transactions(rows)
    row = F.min_by(F.struct(*TRANSACTION_COLUMNS), silver.version_order())
    aggregated = table.groupBy("txn_id").agg(row.alias("row")).select("row.*")
    windowed = silver.latest_per_transaction(table)
    assert aggregated.count() == 35
    assert aggregated.exceptAll(windowed).count() == windowed.exceptAll(aggregated).count() == 0


def test_versions_in_any_order_over_four_deliveries(spark, feed):
    days = (13, 16, 14, 15)
    for at, day in enumerate(days):
        rows = [arriving(day, txn_id=f"TXN-{(n + at) % 4:012X}", amount=float(day)) for n in range(3)]
        feed([*rows, arriving(10, amount=0.0), good(txn_id=None), good(txn_id=" ")])
    found = {r.txn_id: r.amount for r in silver.read_silver(spark, feed.path).collect()}
    # Each id is absent from one of the deliveries: id 3 from that of day 13, id 0 from that of day 16.
    assert found == {
        "TXN-000000000000": 15.0, "TXN-000000000001": 16.0, "TXN-000000000002": 16.0,
        "TXN-000000000003": 16.0, "TXN-0000000000AB": 0.0,
    }


def test_state_is_evicted_and_silver_forgets_nothing(spark, feed):
    feed([arriving(16, txn_id=f"TXN-{n:012X}", amount=16.0) for n in range(50)], "1 second")
    for later in range(2):
        time.sleep(2.5)
        progress = feed([arriving(15 - later, txn_id=f"TXN-{n:012X}", amount=1.0) for n in range(5)], "1 second")
    states = [p.stateOperators[0] for p in progress if p.stateOperators]
    assert states[-1].numRowsTotal <= 10
    assert silver.read_silver(spark, feed.path).agg(F.min("amount")).first()[0] == 16.0


def test_a_trigger_without_rows_publishes_nothing(spark, feed):
    feed([good()])
    before = versions.listed(spark, feed.path)
    feed([])
    feed([good(txn_id=None)])
    assert versions.listed(spark, feed.path) == before
