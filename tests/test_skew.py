"""Operators under one key that holds a third of all rows."""

from __future__ import annotations

from collections import Counter
from fractions import Fraction

from payment_rows import good, plan_text
from pyspark.sql import functions as F

from paystrata.functions.layout import cluster_for_write
from paystrata.operators.ranking import global_rank, merchant_rank_weights
from paystrata.operators.rates import running_rates
from paystrata.operators.silver import latest_per_transaction
from paystrata.operators import duplicates, rates, rules, validation


def skewed(spark, rows=30_000):
    """A third of the rows are identical copies of one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    payload = F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.sha2(key, 256))
    return spark.range(0, rows, numPartitions=8).select(
        key.alias("txn_id"), payload.alias("payload")
    )


def final_plan(df) -> str:
    df.collect()
    return plan_text(df)


def rows_per_task(df, condition) -> list[int]:
    placed = df.where(condition).groupBy(F.spark_partition_id()).count()
    return [row["count"] for row in placed.collect()]


def test_hot_duplicates_are_spread_over_tasks(spark, conf, tmp_path):
    path = str(tmp_path / "t")
    skewed(spark).write.parquet(path)
    conf(
        spark__sql__adaptive__enabled="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__files__maxPartitionBytes="100000",
        spark__sql__files__openCostInBytes="1000",
    )
    table = spark.read.parquet(path)
    found = duplicates.duplicate_rows(table, hot_rows=100)
    plan = plan_text(found)
    # Hot keys are broadcast, the others meet in a shuffled join.
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
    assert found.groupBy("txn_id", "group_size").count().collect() == [("hot", 10_000, 10_000)]
    loads = rows_per_task(found, "txn_id = 'hot'")
    assert sum(loads) == 10_000 and max(loads) < 5_000
    marked = duplicates.mark_duplicates(table, hot_rows=100)
    assert Counter(r.is_duplicate for r in marked.collect()) == {True: 10_000, False: 20_000}


def test_the_number_of_hot_keys_is_bounded():
    assert 1 / duplicates.HOT_SHARE == 10_000


def test_hot_and_cold_groups_give_the_same_answer(spark):
    rows = spark.range(0, 2000, numPartitions=6).select(
        F.when(F.col("id") % 10 > 0, F.sqrt("id").cast("int").cast("string")).alias("txn_id"), "id"
    )
    sizes = Counter(r.txn_id for r in rows.collect())
    expected = sorted((r.id, sizes[r.txn_id]) for r in rows.collect() if r.txn_id and sizes[r.txn_id] > 1)
    for hot_rows in (1, 20, 10**9):  # all groups hot, some, none
        found = duplicates.duplicate_rows(rows, hot_rows=hot_rows)
        assert sorted((r.id, r.group_size) for r in found.collect()) == expected


def test_null_keys_are_never_duplicates_and_are_scattered(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    rows = spark.range(0, 900, numPartitions=6).select(
        F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("txn_id")
    )
    marked = duplicates.mark_duplicates(rows)
    assert marked.count() == 900 and marked.where("is_duplicate").isEmpty()
    loads = rows_per_task(marked, "txn_id is null")
    assert sum(loads) == 300 and len(loads) > 1


def test_few_repeated_keys_are_broadcast_after_measuring(spark, conf, tmp_path):
    path = str(tmp_path / "t")
    skewed(spark, 3000).write.parquet(path)
    found = duplicates.duplicate_rows(spark.read.parquet(path))
    assert "SortMergeJoin" not in final_plan(found).split("Initial Plan")[0]


def test_hot_key_is_reduced_before_the_shuffle(spark, transactions):
    ranked = plan_text(latest_per_transaction(transactions(3)))
    assert ranked.count("WindowGroupLimit") == 2  # once on each side of the exchange
    unique = [rule for rule in rules.BRONZE_SUITE if rule.rule_id == 2]
    sizes = plan_text(validation.summarize_rules(transactions(3), unique))
    assert sizes.count("partial_count") == 1 and sizes.count("partial_sum") == 3


def test_one_hot_folder_is_written_by_several_tasks(spark, conf):
    conf(spark__sql__adaptive__enabled="false")
    hour = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 24)
    rows = spark.range(0, 9000, numPartitions=8).select(hour.alias("arrival_hour"))
    placed = cluster_for_write(rows, ["arrival_hour"], 4)
    tasks = placed.where("arrival_hour = 0").select(F.spark_partition_id()).distinct().count()
    assert 1 < tasks <= 4
    assert placed.count() == 9000


def test_global_rank_equals_a_plain_sort(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = spark.range(0, 5000, numPartitions=7).select(
        (F.col("id") % 37).alias("n"), F.col("id").cast("string").alias("name")
    )
    ranked = global_rank(rows, F.col("n").desc(), F.col("name"))
    expected = sorted(((r.n, r.name) for r in rows.collect()), key=lambda r: (-r[0], r[1]))
    got = {r["rank"]: (r.n, r.name) for r in ranked.collect()}
    assert [got[place] for place in range(1, 5001)] == expected


def test_rank_weights_sum_to_one(transactions):
    rows = [good(txn_id=str(n), merchant_id=f"MRC-{n % 4:06}") for n in range(10)]
    rows += [good(txn_id=f"x{n}", merchant_id="MRC-000002") for n in range(5)]
    ranked = sorted(merchant_rank_weights(transactions(rows)).collect(), key=lambda r: r["rank"])
    assert [r.merchant_id for r in ranked] == ["MRC-000002", "MRC-000000", "MRC-000001", "MRC-000003"]
    assert abs(sum(r.rank_weight for r in ranked) - 1) < 1e-12
    assert abs(ranked[0].rank_weight - 1 / (1 + 1 / 2 + 1 / 3 + 1 / 4)) < 1e-12
    assert ranked[0].observed_share == 7 / 15


def test_running_rates_over_several_blocks(spark, transactions, monkeypatch):
    monkeypatch.setattr(rates, "_POINTS_PER_BLOCK", 3)
    rows = spark.range(0, 95, numPartitions=5).select(
        F.col("id"),
        F.when(F.col("id") % 7 == 0, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(F.col("id") % 4 == 0, "2024-01-01").otherwise("2024-01-15T00").alias("txn_timestamp"),
        F.lit("2024-01-15T00:00:00.000Z").alias("arrival_timestamp"),
    )
    result = sorted(running_rates(rows, "id", every=10).collect(), key=lambda r: r.published)
    assert [r.published for r in result] == list(range(10, 100, 10))
    for row in result:
        failed = sum(1 for n in range(row.published) if n % 7 == 0)
        late = sum(1 for n in range(row.published) if n % 4 == 0)
        assert (row.failed, row.late) == (failed, late)
        exact = Fraction(100 * failed, row.published)
        assert row.failure_rate == float(int(exact * 10 + Fraction(1, 2))) / 10
