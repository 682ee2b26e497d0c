from __future__ import annotations

import pytest
from payment_rows import good

from paystrata.operators import gold, silver


def on(day, number, **changes):
    return good(txn_id=f"TXN-{number:012X}", txn_timestamp=f"2024-01-{day:02}T09:00:00.000Z", **changes)


def later(row, **changes):
    return {**row, "arrival_timestamp": "2024-01-16T10:00:00.000Z", **changes}


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "silver"), str(tmp_path / "gold")


def test_equals_the_full_cube_after_every_upsert(spark, transactions, paths):
    table, cube = paths
    first = [on(day, day * 10 + n, amount=float(n), gateway_id=f"GW-00{n}") for day in (1, 2, 3) for n in (1, 2, 3)]
    batches = [
        first,
        [later(first[0], amount=99.0), later(first[4], status="FAILED"), on(4, 90, amount=-5.0)],
        [{**later(first[8]), "txn_timestamp": "2024-01-01T00:00:00.000Z", "arrival_timestamp": "2024-01-17T00:00:00.000Z"}],
        [{**first[0], "txn_timestamp": "?", "arrival_timestamp": "2024-01-18T00:00:00.000Z"}],
    ]
    for batch in batches:
        silver.upsert_silver(transactions(batch), table)
        gold.update_gold(spark, table, cube)
        assert rows_of(gold.read_gold(spark, cube)) == rows_of(gold.route_cube(silver.read_silver(spark, table)))


def test_untouched_dates_are_not_read(spark, transactions, paths, monkeypatch):
    table, cube = paths
    silver.upsert_silver(transactions([on(1, 1), on(2, 2), on(3, 3)]), table)
    assert gold.update_gold(spark, table, cube) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    silver.upsert_silver(transactions([on(2, 4)]), table)
    read, real = [], silver.read_folders
    monkeypatch.setattr(silver, "read_folders", lambda s, p, names: read.extend(names) or real(s, p, names))
    assert gold.update_gold(spark, table, cube) == ["2024-01-02"]
    assert [name.rsplit("=", 1)[1] for name in read] == ["2024-01-02"]
    assert gold.update_gold(spark, table, cube) == [] and len(read) == 1


def test_skipped_versions_do_not_matter(spark, transactions, paths):
    table, cube = paths
    silver.upsert_silver(transactions([on(1, 1), on(2, 2)]), table)
    gold.update_gold(spark, table, cube)
    for n in range(5):
        silver.upsert_silver(transactions([on(1 + n % 2, 10 + n, amount=float(n))]), table)
    gold.update_gold(spark, table, cube)
    assert rows_of(gold.read_gold(spark, cube)) == rows_of(gold.route_cube(silver.read_silver(spark, table)))


def test_a_date_that_silver_has_left_is_dropped(spark, transactions, paths):
    table, cube = paths
    row = on(1, 1)
    silver.upsert_silver(transactions([row]), table)
    gold.update_gold(spark, table, cube)
    silver.upsert_silver(transactions([{**later(row), "txn_timestamp": "2024-01-05T00:00:00.000Z"}]), table)
    assert gold.update_gold(spark, table, cube) == ["2024-01-05"]
    assert gold.read_gold(spark, cube).where("grouping_level = 7").first().n_txns == 1


def test_readers_keep_their_version_and_old_folders_go(spark, transactions, paths, tmp_path):
    table, cube = paths
    assert gold.read_gold(spark, cube).where("grouping_level < 7").count() == 0
    readers = []
    for n in range(4):
        silver.upsert_silver(transactions([on(1, n)]), table)
        gold.update_gold(spark, table, cube)
        readers.append(gold.read_gold(spark, cube).where("grouping_level = 7"))
    assert [r.first().n_txns for r in readers[-2:]] == [3, 4]
    assert len(list((tmp_path / "gold/cube").glob("*"))) == 3


def test_an_update_that_dies_changes_nothing(spark, transactions, paths, monkeypatch):
    table, cube = paths
    silver.upsert_silver(transactions([on(1, 1)]), table)
    gold.update_gold(spark, table, cube)
    silver.upsert_silver(transactions([on(1, 2)]), table)
    with monkeypatch.context() as patch:
        patch.setattr(gold.versions, "publish", _lost)
        with pytest.raises(RuntimeError):
            gold.update_gold(spark, table, cube)
    assert gold.read_gold(spark, cube).where("grouping_level = 7").first().n_txns == 1
    gold.update_gold(spark, table, cube)
    assert gold.read_gold(spark, cube).where("grouping_level = 7").first().n_txns == 2


def _lost(*_):
    raise RuntimeError("driver lost")
