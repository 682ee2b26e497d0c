from __future__ import annotations

import pytest
from payment_rows import good, plan_text
from pyspark.sql import functions as F

from paystrata import dimensions as dims
from paystrata.functions import ids, payments
from paystrata.operators import assignment, enrichment, gold, rates, routing, shares


def by(df, key):
    return {row[key]: row for row in df.collect()}


@pytest.mark.parametrize("dim", dims.DIMENSIONS.values(), ids=lambda dim: dim.name)
def test_dimension_tables(spark, dim):
    rows = dim.table(spark).orderBy("position").collect()
    assert [tuple(row)[1:] for row in rows] == [
        tuple(list(v) if isinstance(v, tuple) else v for v in row) for row in dim.rows
    ]


def test_dimension_sizes_and_weights():
    sizes = {name: len(dim.rows) for name, dim in dims.DIMENSIONS.items()}
    assert sizes == {
        "segment": 4, "merchant_category": 8, "gateway": 3, "processor": 4,
        "payment_method": 4, "failure_reason": 7, "location": 11, "hour_weight": 24,
    }
    assert round(sum(weight for _, weight in dims.HOUR_WEIGHT.rows), 10) == 1.08


def test_lookups_are_broadcast_and_keep_unknown_codes(transactions):
    rows = [good(), good(txn_id="x", gateway_id="GW-009", merchant_category=None)]
    enriched = enrichment.enrich(transactions(rows))
    assert plan_text(enriched).count("BroadcastHashJoin") == 5
    assert "SortMergeJoin" not in plan_text(enriched)
    result = by(enriched, "txn_id")
    known, unknown = result[good()["txn_id"]], result["x"]
    assert (known.gateway_success_rate, known.category_avg_amount) == (0.97, 350.0)
    assert (known.settlement_hours, known.method_processor) == (0, "PRC-001")
    assert unknown.gateway_latency_ms is None and unknown.category_failure_rate is None
    assert unknown.segment_avg_amount == 800.0


def test_failure_probability(transactions):
    rows = [good(), good(txn_id="x", gateway_id="GW-009", status="FAILED")]
    scored = by(enrichment.expected_failure(transactions(rows)), "txn_id")
    expected = 0.4 * 0.02 + 0.4 * 0.025 + 0.2 * 0.03
    assert abs(scored[good()["txn_id"]].failure_probability - expected) < 1e-12
    assert scored["x"].failure_probability is None
    compared = by(enrichment.expected_versus_actual(transactions(rows)), "gateway_id")
    assert (compared["GW-009"].n_scored, compared["GW-009"].actual_failures) == (0, 1)


def test_amount_formulas(spark, transactions):
    row = enrichment.amount_scores(transactions([good(amount=575.0)])).first()
    assert row.expected_amount == 575.0 and row.amount_zscore == 0.0
    values = spark.createDataFrame([(3.0,), (10.006,), (None,)], "amount double")
    clamped = [r[0] for r in values.select(payments.clamp_amount(F.col("amount"))).collect()]
    assert clamped[:2] == [10.0, 10.01]


@pytest.mark.parametrize(
    "gateway, method, allowed",
    [
        ("GW-001", "WALLET", True),
        ("GW-002", "WALLET", False),
        ("GW-003", "NETBANKING", False),
        ("GW-003", "CARD", True),
        ("GW-004", "UPI", False),
        (None, "UPI", False),
        ("GW-001", None, False),
    ],
)
def test_gateway_eligibility(transactions, gateway, method, allowed):
    txns = transactions([good(gateway_id=gateway, payment_method=method)])
    assert routing.on_eligible_gateway(txns).count() == int(allowed)
    assert routing.on_ineligible_gateway(txns).count() == int(not allowed)


def test_gateways_per_method(spark):
    lists = by(routing.eligible_gateways(spark), "payment_method")
    assert lists["NETBANKING"].eligible_gateways == ["GW-001", "GW-002"]
    assert lists["UPI"].eligible_gateways == ["GW-001", "GW-002", "GW-003"]


@pytest.mark.parametrize(
    "processor, method, allowed",
    [
        ("PRC-001", "UPI", True),
        ("PRC-001", "WALLET", True),
        ("PRC-002", "CARD", True),
        ("PRC-003", "CARD", True),
        ("PRC-004", "NETBANKING", True),
        ("PRC-003", "UPI", False),
        ("PRC-004", "CARD", False),
    ],
)
def test_processor_routes(transactions, processor, method, allowed):
    txns = transactions([good(processor_id=processor, payment_method=method)])
    assert routing.processor_mismatches(txns).count() == int(not allowed)


def test_late_means_an_earlier_day(transactions):
    times = [
        ("2024-01-14T23:59:59.999Z", "2024-01-15T00:00:00.000Z", True),
        ("2024-01-15T00:00:00.000Z", "2024-01-15T00:00:00.000Z", False),
        ("2024-01-15T23:00:00.000Z", "2024-01-15T01:00:00.000Z", False),
    ]
    for event, arrival, late in times:
        txns = transactions([good(txn_timestamp=event, arrival_timestamp=arrival)])
        assert rates.late_arrivals(txns).count() == int(late)
    profile = shares.lateness_profile(
        transactions([good(txn_timestamp=e, arrival_timestamp=a) for e, a, _ in times])
    )
    assert {(r.days_late, r.n_txns, r.n_ahead) for r in profile.collect()} == {(1, 1, 0), (0, 2, 1)}


def test_shares_show_unknown_and_unseen_values(transactions):
    rows = [good(payment_method=m) for m in ("UPI", "UPI", "CASH", None)]
    result = by(shares.method_shares(transactions(rows)), "value")
    assert result["UPI"].observed_share == 0.5 and result["UPI"].expected_share == 0.55
    assert result["CASH"].expected_share is None
    assert (result["CARD"].n_txns, result["CARD"].observed_share) == (0, 0.0)
    assert result[None].n_txns == 1
    hours = shares.hour_shares(transactions(rows))
    assert abs(hours.agg(F.sum("expected_share")).first()[0] - 1) < 1e-12


def test_rates_of_nothing_are_null(transactions):
    row = rates.with_rates(rates.totals(transactions(1).where("false"))).first()
    assert (row.published, row.failure_rate) == (0, None)


def test_rate_rounding_is_exact(spark):
    counts = spark.createDataFrame([(403, 2000), (1, 3), (2, 3), (0, 5)], "p long, w long")
    rounded = counts.select(payments.percent_tenths(F.col("p"), F.col("w")))
    assert [r[0] for r in rounded.collect()] == [20.2, 33.3, 66.7, 0.0]


def test_ids(spark):
    row = spark.range(1).select(
        ids.padded_id("USR-", F.lit(42)),
        ids.padded_id("USR-", F.lit(1234567)),
        ids.hashed_id("TXN-", F.lit("a")),
        ids.unit_interval(F.lit("a")),
    ).first()
    assert row[0] == "USR-000042" and row[1] == "USR-1234567"
    assert row[2] == "TXN-0CC175B9C0F1"
    assert row[3] == 0x0CC175B9 / 2**32


def test_intervals_cover_everything(spark):
    for dim, key in ((dims.LOCATION, "city"), (dims.HOUR_WEIGHT, "hour")):
        rows = assignment.dimension_intervals(spark, dim, key).table.orderBy("upper").collect()
        assert rows[0].lower == 0.0 and rows[-1].upper == 1.0
        assert all(a.upper == b.lower for a, b in zip(rows, rows[1:]))


def test_assignment_follows_the_weights(spark):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    intervals = assignment.dimension_intervals(spark, dims.PAYMENT_METHOD, "method")
    drawn = assignment.assign_by_weight(rows, F.col("k"), intervals, "method")
    counts = {r.method: r["count"] for r in drawn.groupBy("method").count().collect()}
    assert sum(counts.values()) == 20_000 and None not in counts
    for method, weight, *_ in dims.PAYMENT_METHOD.rows:
        assert abs(counts[method] / 20_000 - weight) < 0.015
    assert "NestedLoop" not in plan_text(drawn)
    merchants = assignment.assign_by_weight(
        rows, F.col("k"), assignment.merchant_intervals(spark), "m", cells=1024
    )
    assert merchants.where("m is null").isEmpty() and merchants.count() == 20_000
    unknown = rows.where("k = '1'").withColumn("k", F.lit(None).cast("string"))
    assert assignment.assign_by_weight(unknown, F.col("k"), intervals, "m").first().m is None


def test_large_pools_are_joined_by_shuffle(spark, conf):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    pool = assignment.merchant_intervals(spark, 500)
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    drawn = assignment.assign_by_weight(rows, F.col("k"), pool, "m", cells=512)
    assert "ResolvedHint" not in drawn._jdf.queryExecution().analyzed().toString()
    shuffled = sorted(drawn.collect())
    conf(spark__sql__autoBroadcastJoinThreshold="10m")
    small = assignment.assign_by_weight(rows, F.col("k"), pool, "m")
    assert shuffled == sorted(small.collect())


def test_draws_from_dimensions_are_projections(spark):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    drawn = rows.withColumn("m", assignment.draw_from_dimension(F.col("k"), dims.PAYMENT_METHOD, "method"))
    plan = plan_text(drawn)
    assert "Join" not in plan and "Window" not in plan and "Exchange" not in plan
    table = assignment.dimension_intervals(spark, dims.PAYMENT_METHOD, "method")
    joined = assignment.assign_by_weight(rows, F.col("k"), table, "m")
    assert sorted(drawn.collect()) == sorted(joined.collect())
    nothing = rows.limit(1).withColumn("k", F.lit(None).cast("string"))
    assert nothing.select(assignment.draw_from_dimension(F.col("k"), dims.PAYMENT_METHOD, "method")).first()[0] is None


def test_rollups_expand_groups_not_rows(transactions):
    rows = transactions([good(amount=1.5), good(amount=2.5, payment_method=None)])
    cube = gold.route_cube(rows)
    plan = plan_text(cube)
    assert plan.index("Expand") < plan.rindex("partial_count")  # counted below the expand
    totals = cube.where("grouping_level = 7").first()
    assert (totals.n_txns, totals.amount_sum, totals.amount_max) == (2, 4.0, 2.5)
    # A NULL code is a group of its own, not a subtotal.
    nulls = cube.where("payment_method is null and merchant_category = 'grocery'")
    assert {r.grouping_level for r in nulls.collect()} == {0, 4, 2, 6}
    assert gold.route_rollup(rows).count() == 1 + 1 + 2 + 2
