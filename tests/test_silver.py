from __future__ import annotations

import datetime as dt

import pytest
from payment_rows import good, plan_text
from pyspark.sql import functions as F

from paystrata.functions import times
from paystrata.operators import locator, silver
from paystrata.sources import files

A, B, C = "TXN-00000000000A", "TXN-00000000000B", "TXN-00000000000C"


def table(spark, path):
    return {row.txn_id: row for row in silver.read_silver(spark, path).collect()}


def at(day, **changes):
    return good(arrival_timestamp=f"2024-01-{day:02}T10:00:00.000Z", **changes)


def test_latest_arrival_wins_and_ties_do_not_depend_on_order(transactions):
    rows = [at(15, amount=1.0), at(17, amount=2.0), at(16, amount=3.0), good(txn_id=None)]
    assert [r.amount for r in silver.latest_per_transaction(transactions(rows)).collect()] == [2.0]
    tied = [at(15, device_type=d) for d in ("tablet", "desktop", "mobile")]
    for order in (tied, tied[::-1]):
        (row,) = silver.latest_per_transaction(transactions(order)).collect()
        assert row.device_type == "desktop"


def test_arrivals_are_compared_as_times(transactions):
    def kept(*arrivals):
        rows = [good(arrival_timestamp=text) for text in arrivals]
        (row,) = silver.latest_per_transaction(transactions(rows)).collect()
        return row.arrival_timestamp

    assert kept("2024-01-15T10:00:00.99Z", "2024-01-15T10:00:00.995Z") == "2024-01-15T10:00:00.995Z"
    assert kept("not a time", "2024-01-15T10:00:00.000Z", None) == "2024-01-15T10:00:00.000Z"
    assert kept("b", "a", None) == "b"
    assert kept("2024-01-15T10:00:00.5Z", "2024-01-15T10:00:00.500Z") == "2024-01-15T10:00:00.5Z"


def test_an_unreadable_arrival_replaces_nothing(spark, transactions, tmp_path):
    path = str(tmp_path / "silver")
    silver.upsert_silver(transactions([at(15, txn_id=A)]), path)
    silver.upsert_silver(transactions([good(txn_id=A, arrival_timestamp="not a time", amount=9.0)]), path)
    assert table(spark, path)[A].amount == 250.5


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_both_ways_to_the_latest_version_agree(transactions, tmp_path, conf, threshold):
    conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    hot = [at(1 + n % 28, amount=float(n)) for n in range(60)]
    others = [at(15, txn_id=f"TXN-{n % 90:012X}", amount=float(n)) for n in range(120)]
    table = transactions([*hot, *others, good(txn_id=None), good(txn_id=" ")])
    latest = silver.latest_versions(table, str(tmp_path / "ids"))
    expected = silver.latest_per_transaction(table)
    assert sorted(latest.collect(), key=str) == sorted(expected.collect(), key=str)
    assert latest.count() == 91


def test_rows_with_a_unique_id_are_not_shuffled(spark, transactions, tmp_path):
    plan = plan_text(silver.latest_versions(transactions(20), str(tmp_path / "ids")))
    alone = plan.split("Window")[0]
    assert "BroadcastHashJoin" in alone and "Exchange hashpartitioning" not in alone


def test_upsert(spark, transactions, tmp_path):
    path = str(tmp_path / "silver")
    silver.upsert_silver(transactions([at(15, txn_id=A), at(15, txn_id=B)]), path)
    silver.upsert_silver(
        transactions([at(16, txn_id=A, status="FAILED"), at(14, txn_id=B, amount=1.0), at(16, txn_id=C)]),
        path,
    )
    rows = table(spark, path)
    assert sorted(rows) == [A, B, C]
    assert rows[A].status == "FAILED" and rows[B].amount == 250.5
    assert rows[A].event_date == dt.date(2024, 1, 15)


def test_untouched_dates_are_not_rewritten(spark, transactions, tmp_path):
    path = str(tmp_path / "silver")
    other = good(txn_id=B, txn_timestamp="2024-01-03T00:00:00.000Z")
    silver.upsert_silver(transactions([at(15, txn_id=A), other]), path)
    before = folders(spark, path)
    silver.upsert_silver(transactions([at(16, txn_id=A)]), path)
    after = folders(spark, path)
    assert after["2024-01-03"] == before["2024-01-03"] and after["2024-01-15"] != before["2024-01-15"]
    assert sorted(table(spark, path)) == [A, B]
    assert silver.read_silver(spark, path, [dt.date(2024, 1, 3)]).first().txn_id == B
    assert silver.read_silver(spark, path, []).count() == 0


def test_copied_rows_are_not_exchanged(spark, transactions, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "silver"), []
    silver.upsert_silver(transactions(20), path)
    real = silver.latest_per_transaction

    def watched(df, tie_breakers=()):
        plans.append(plan_text(df))
        return real(df, tie_breakers)

    monkeypatch.setattr(silver, "latest_per_transaction", watched)
    silver.upsert_silver(transactions([at(16, txn_id="TXN-000000000003")]), path)
    assert "BroadcastHashJoin" in plans[-1] and "Exchange hashpartitioning" not in plans[-1]
    assert len(table(spark, path)) == 20


def test_readers_keep_their_version_during_an_upsert(spark, transactions, tmp_path):
    path = str(tmp_path / "silver")
    silver.upsert_silver(transactions([at(15, txn_id=A)]), path)
    reader = silver.read_silver(spark, path)
    silver.upsert_silver(transactions([at(16, txn_id=A, amount=9.0)]), path)
    assert reader.first().amount == 250.5 and table(spark, path)[A].amount == 9.0
    silver.upsert_silver(transactions([at(17, txn_id=A, amount=8.0)]), path)
    silver.upsert_silver(transactions([at(18, txn_id=A, amount=7.0)]), path)
    assert len(list((tmp_path / "silver/data").glob("*/slot=*"))) == 3
    assert len(list((tmp_path / "silver/_versions").glob("*.json"))) == 2


def test_repeating_a_batch_changes_nothing(spark, transactions, tmp_path):
    path = str(tmp_path / "silver")
    stamp = lambda day: F.lit(f"2024-02-{day:02} 00:00:00").cast("timestamp")
    batch = transactions([at(15, txn_id=A), at(15, txn_id=B)])
    silver.upsert_silver(batch, path, updated_at=stamp(1))
    before = table(spark, path)
    silver.upsert_silver(batch, path, updated_at=stamp(2))
    assert table(spark, path) == before


def test_moved_transaction_leaves_no_old_row(spark, transactions, tmp_path):
    path = str(tmp_path / "silver")
    silver.upsert_silver(transactions([at(15, txn_id=A)]), path)
    moved = at(16, txn_id=A, txn_timestamp="2024-01-11T00:00:00.000Z")
    silver.upsert_silver(transactions([moved]), path)
    rows = silver.read_silver(spark, path).collect()
    assert [(r.txn_id, r.event_date) for r in rows] == [(A, dt.date(2024, 1, 11))]
    assert list(folders(spark, path)) == ["2024-01-11"]


def test_unreadable_event_time_has_its_own_partition(spark, transactions, tmp_path):
    path = str(tmp_path / "silver")
    silver.upsert_silver(transactions([at(15, txn_id=A, txn_timestamp="?")]), path)
    silver.upsert_silver(transactions([at(16, txn_id=A, txn_timestamp="?", amount=5.0)]), path)
    assert table(spark, path)[A].amount == 5.0
    silver.upsert_silver(transactions([at(17, txn_id=A)]), path)
    rows = silver.read_silver(spark, path).collect()
    assert [r.event_date for r in rows] == [dt.date(2024, 1, 15)]


def test_interrupted_upsert_changes_nothing(spark, transactions, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    silver.upsert_silver(transactions([at(15, txn_id=A)]), path)
    with monkeypatch.context() as patch:
        patch.setattr(silver.files, "write_text", _lost)
        with pytest.raises(RuntimeError):
            silver.upsert_silver(transactions([at(16, txn_id=A, amount=9.0)]), path)
    assert table(spark, path)[A].amount == 250.5
    assert len(list((tmp_path / "silver/data").glob("*/slot=*"))) == 2
    silver.upsert_silver(transactions([at(16, txn_id=B)]), path)
    assert sorted(table(spark, path)) == [A, B]
    assert len(list((tmp_path / "silver/data").glob("*/slot=*"))) == 2


def test_a_version_is_not_replaced(spark, tmp_path):
    files.write_text(spark, str(tmp_path / "v.json"), "1", replace=False)
    with pytest.raises(Exception, match="exist"):
        files.write_text(spark, str(tmp_path / "v.json"), "2", replace=False)


def opened(monkeypatch):
    """Folders and files that an upsert reads, call by call."""
    seen, real = [], silver._read

    def watched(spark, path, folders):
        seen.append(sorted(folders))
        return real(spark, path, folders)

    monkeypatch.setattr(silver, "_read", watched)
    return seen


def on(day, number, **changes):
    return good(txn_id=f"TXN-{number:012X}", txn_timestamp=f"2024-01-{day:02}T09:00:00.000Z", **changes)


@pytest.mark.parametrize("together", [True, False])
def test_files_without_the_ids_are_not_opened(spark, transactions, tmp_path, monkeypatch, together):
    path = str(tmp_path / "silver")
    # Ids of the dates are either mixed (the filters tell) or in ranges (the bounds tell).
    rows = [on(day, n * 5 + day if together else day * 1000 + n) for day in range(1, 6) for n in range(300)]
    silver.upsert_silver(transactions(rows), path)
    current = folders(spark, path)
    seen = opened(monkeypatch)
    moved = [{**rows[7], "txn_timestamp": "2024-01-04T09:00:00.000Z", "arrival_timestamp": "2024-01-16T10:00:00.000Z"}]
    silver.upsert_silver(transactions(moved), path)
    assert all(name.startswith(current["2024-01-01"] + "/") for name in seen[0]) and len(seen[0]) == 1
    assert seen[1] == sorted([current["2024-01-01"], current["2024-01-04"]])
    (row,) = [r for r in silver.read_silver(spark, path).collect() if r.txn_id == rows[7]["txn_id"]]
    assert row.event_date == dt.date(2024, 1, 4) and silver.read_silver(spark, path).count() == 1500
    seen.clear()
    silver.upsert_silver(transactions([on(9, 10**9)]), path)
    assert seen[0] == [] and silver.read_silver(spark, path).count() == 1501


def test_every_id_is_found_among_several_blocks_and_loads(spark, tmp_path):
    root = str(tmp_path)
    for load in range(3):
        ids = spark.range(load * 20_000, load * 20_000 + 20_000).selectExpr("concat('T', hash(id)) AS txn_id", "id % 3 AS slot")
        ids.repartition(2, "slot").write.partitionBy("slot").parquet(f"{root}/data/{load}")
        locator.index_folder(spark, root, f"data/{load}", f"{root}/_files/{load}", f"{root}/sizes{load}")
    index = locator.read_index(spark, [f"{root}/_files/{load}" for load in range(3)])
    assert max(r.n_blocks for r in index.select("n_blocks").collect()) == 4
    held = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/data").select("txn_id", F.regexp_extract("_metadata.file_path", "(data/.*)$", 1).alias("file"))
    for row in held.orderBy(F.rand(1)).limit(12).collect():
        assert row.file in locator.files_that_may_hold(index, spark.createDataFrame([(row.txn_id,)], "txn_id string"))
    everything = locator.files_that_may_hold(index, held.select("txn_id"))
    assert everything == sorted({r.file for r in held.select("file").collect()})
    strange = spark.range(200).selectExpr("concat('T', hash(id + 1000000)) AS txn_id").join(held, "txn_id", "left_anti")
    assert len(locator.files_that_may_hold(index, strange)) <= 1


def test_a_table_without_index_is_read_whole(spark, transactions, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    silver.upsert_silver(transactions([on(1, 1), on(2, 2)]), path)
    files.delete(spark, f"{path}/_files")
    seen = opened(monkeypatch)
    silver.upsert_silver(transactions([on(2, 2, arrival_timestamp="2024-01-16T10:00:00.000Z", amount=1.0)]), path)
    assert len(seen[0]) == 2 and silver.read_silver(spark, path).count() == 2


def test_large_batches_read_all_ids(spark, transactions, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    silver.upsert_silver(transactions([on(1, 1), on(2, 2)]), path)
    monkeypatch.setattr(locator, "MOST_IDS", 1)
    seen = opened(monkeypatch)
    silver.upsert_silver(transactions([on(3, 3), on(3, 4)]), path)
    assert len(seen[0]) == 2 and silver.read_silver(spark, path).count() == 4


def test_changed_rows(spark, transactions, tmp_path):
    path = str(tmp_path / "silver")
    assert silver.changed_rows(spark, path).count() == 0
    silver.upsert_silver(transactions([on(1, 1), on(1, 2), on(2, 3)]), path)
    assert [r.sign for r in silver.changed_rows(spark, path).collect()] == [1, 1, 1]
    later = dict(arrival_timestamp="2024-01-16T10:00:00.000Z", amount=7.0)
    silver.upsert_silver(transactions([on(2, 1, **later), on(1, 4)]), path)
    rows = sorted((r.sign, r.txn_id[-1], r.amount, str(r.event_date)) for r in silver.changed_rows(spark, path).collect())
    assert rows == [(-1, "1", 250.5, "2024-01-01"), (1, "1", 7.0, "2024-01-02"), (1, "4", 250.5, "2024-01-01")]


def test_indexes_go_with_their_folders(spark, transactions, tmp_path):
    path = str(tmp_path / "silver")
    for day in range(15, 20):
        silver.upsert_silver(transactions([at(day, txn_id=A, amount=float(day))]), path)
    loads = {p.parent.name for p in (tmp_path / "silver/data").glob("*/slot=*")}
    assert {p.name for p in (tmp_path / "silver/_files").glob("*")} == loads and len(loads) == 3


def _lost(*_, **__):
    raise RuntimeError("driver lost")


def folders(spark, path):
    return silver._folders(spark, silver._versions(spark, path)[-1])


def test_only_rows_of_held_ids_compete(spark, transactions, tmp_path, monkeypatch):
    path, ranked = str(tmp_path / "silver"), []
    real = silver.latest_per_transaction

    def watched(df, tie_breakers=()):
        if tie_breakers:
            ranked.append(df.count())
        return real(df, tie_breakers)

    monkeypatch.setattr(silver, "latest_per_transaction", watched)
    silver.upsert_silver(transactions([on(1, n) for n in range(20)]), path)
    later = dict(arrival_timestamp="2024-01-16T10:00:00.000Z", amount=7.0)
    silver.upsert_silver(transactions([on(1, 3, **later), *(on(2, n) for n in range(100, 110))]), path)
    assert ranked == [0, 2]
    assert sorted(r.amount for r in silver.read_silver(spark, path).collect()) == [7.0] + [250.5] * 29


def test_an_index_row_per_id_is_sorted(spark, tmp_path, monkeypatch):
    root, explodes = str(tmp_path), []
    spark.range(5000).selectExpr("concat('T', id) AS txn_id").write.parquet(f"{root}/data")
    real = F.explode
    monkeypatch.setattr(locator.F, "explode", lambda column: explodes.append(str(column)) or real(column))
    locator.index_folder(spark, root, "data", f"{root}/index", f"{root}/sizes")
    assert all("hash" not in text for text in explodes)
    rows = locator.read_index(spark, [f"{root}/index"]).collect()
    assert sum(r.n_blocks for r in rows) >= 3 and all(len(r.bits) == locator.BLOCK_BITS // 8 for r in rows)
    bits = sum(int.from_bytes(r.bits).bit_count() for r in rows)
    assert 5000 * 7 < bits <= 5000 * 8


def test_usual_times_are_read_as_by_the_pattern(spark):
    texts = ["2024-01-15T10:00:00.995Z", "2024-01-15T10:00:00.5Z", "2024-02-30T10:00:00.000Z", "2024-01-15T24:00:00.000Z",
             "2024-01-15T10:00:60.000Z", "0999-01-15T10:00:00.000Z", "2024-01-15T10:00:00Z", "2024-01-15T10:00:00.0000Z",
             "2024-01-15T10:00:00.000Z\n", " 2024-01-15T10:00:00.000Z", "+12024-01-15T10:00:00.000Z", "1582-10-10T00:00:00.000Z", "x", "", None]
    table = spark.createDataFrame([(text,) for text in texts], "text string")
    pattern = F.try_to_timestamp("text", F.lit(times.EVENT_TIME_PATTERN))
    assert table.where(~times.parse_event_time(F.col("text")).eqNullSafe(pattern)).collect() == []
    assert table.where(times.parse_event_time(F.col("text")).isNotNull()).count() >= 3
