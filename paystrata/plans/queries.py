"""Named queries over the driver's tables, one or more per operator.

Every query reads the whole ``events`` table of the given folder. The fixture
variants below (doubled rows, broken payloads, later versions) are derived from
that table by Spark.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata import dimensions as dims
from paystrata.functions.ids import hashed_id, unit_interval
from paystrata.functions.payments import clamp_amount
from paystrata.functions.times import days_before, event_time_text, parse_event_time
from paystrata.operators import (
    assignment,
    drift,
    duplicates,
    enrichment,
    gold,
    parse,
    ranking,
    rates,
    routing,
    shares,
    silver,
    validation,
)
from paystrata.plans import compaction, gate, incremental
from paystrata.schema import DAY_COLUMNS, INGEST_COLUMN, PARTITION_COLUMNS, TRANSACTION_COLUMNS
from paystrata.session import scratch_path, use_engine_conf
from paystrata.sinks.bronze import append_bronze
from paystrata.sinks.envelopes import publish_to_files
from paystrata.sources.bronze import in_contract_order, read_bronze, read_day
from paystrata.sources.envelopes import read_files, stream_from_files
from paystrata.sources.events import read_transactions
from paystrata.streaming import bronze as bronze_stream
from paystrata.streaming import dedupe as dedupe_stream
from paystrata.streaming import metrics as metrics_stream
from paystrata.streaming import silver as silver_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LOGICAL_DATE = "2024-01-15"


def query(function: Query) -> Query:
    """Register ``function`` under its name, run with the engine's settings."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(use_engine_conf(spark), folder)

    QUERIES[function.__name__] = run
    return function


# --- inputs derived from the events table ------------------------------------


_TABLES: dict[tuple, str] = {}


def _once(spark: SparkSession, folder: str, label: str, write: Callable[[str], None]) -> str:
    """Path of a derived table, written once per application and then reused."""
    key = (spark.sparkContext.applicationId, folder, label)
    if key not in _TABLES:
        path = scratch_path(spark, label)
        write(path)
        _TABLES[key] = path
    return _TABLES[key]


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """The transactions as messages at rest, as a topic would hold them."""
    txns = read_transactions(spark, folder)
    return read_files(
        spark, _once(spark, folder, "messages", lambda path: publish_to_files(txns, path))
    )


def doubled(spark: SparkSession, folder: str) -> DataFrame:
    """Every transaction, and each hundredth once more."""
    txns = read_transactions(spark, folder, keep=("event_id",))
    return txns.unionByName(txns.where(F.col("event_id") % 100 == 0)).drop("event_id")


def damaged_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Every message; eight in fifty are broken, each in its own way."""
    txns = read_transactions(spark, folder, keep=("event_id",))
    # The time without its fraction does not have the wire format.
    short_time = F.regexp_replace("arrival_timestamp", r"\.\d{3}Z$", "Z")
    kind = F.col("event_id") % 50
    far = F.concat(F.lit("2999"), F.substring("arrival_timestamp", 5, 20))
    key = F.col("txn_id").cast("binary")
    txns = txns.withColumns(
        {
            "message_key": key,
            "arrival_timestamp": F.when(kind == 3, short_time)
            .when(kind == 7, far)
            .otherwise(F.col("arrival_timestamp")),
            "txn_id": F.when(kind == 6, F.lit("  ")).when(kind != 5, F.col("txn_id")),
        }
    )
    text = F.to_json(F.struct(*TRANSACTION_COLUMNS), {"ignoreNullFields": "false"})
    half = F.call_function("div", F.length(text), F.lit(2)).cast("int")
    damaged = (
        F.when(kind == 0, F.substring(text, F.lit(1), half))
        .when(kind == 1, F.lit("  "))
        .when(kind == 2, F.regexp_replace(text, r'"amount":([0-9.E-]+)', '"amount":"$1"'))
        .when(kind == 4, F.lit("{}"))
        .otherwise(text)
    )
    return txns.select(
        F.col("message_key").alias("key"), damaged.cast("binary").alias("value")
    )


def drifting_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Every message; seven in twenty depart from the contract, each in its own way."""
    txns = read_transactions(spark, folder, keep=("event_id",))
    record = F.to_json(F.struct(*TRANSACTION_COLUMNS), {"ignoreNullFields": "false"})
    way = F.col("event_id") % 20

    def with_field(text: Column) -> Column:
        return F.concat(F.expr("left(message, length(message) - 1)"), F.lit(","), text, F.lit("}"))

    messages_of = txns.select(F.col("txn_id").cast("binary").alias("key"), "event_id", record.alias("message"))
    changed = (
        F.when(way == 1, with_field(F.lit('"channel":"web"')))
        .when(way == 2, with_field(F.concat(F.lit('"retries":'), (F.col("event_id") % 7).cast("string"))))
        .when(way == 3, F.regexp_replace("message", '"amount":[^,]*', '"amount":"many"'))
        .when(way == 4, F.regexp_replace("message", '"is_international":[a-z]*', '"is_international":"no"'))
        .when(way == 5, with_field(F.lit('"device":{"os":"x"}')))
        .when(way == 6, with_field(F.lit('"tags":["a","b"]')))
        .when(way == 7, F.lit("{"))
        .otherwise(F.col("message"))
    )
    return messages_of.select("key", changed.cast("binary").alias("value"))


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """Later and earlier versions of transactions already seen.

    Failures settle a day later, late arrivals have an outdated earlier version and
    one event in ten is corrected to the day before. One in ten has a version whose
    arrival cannot be read, and one in ten two of the same second, the earlier of which
    (``.99`` before ``.995``) has the greater text.
    """
    txns = read_transactions(spark, folder, keep=("event_id",))
    arrival = parse_event_time(F.col("arrival_timestamp"))
    event = parse_event_time(F.col("txn_timestamp"))

    def arriving(df: DataFrame, days: int) -> DataFrame:
        return df.withColumn(
            "arrival_timestamp", event_time_text(days_before(arrival, F.lit(-days)))
        )

    settled = arriving(rates.failed_transactions(txns), 1).withColumns(
        {"status": F.lit("SUCCESS"), "failure_reason": F.lit(None).cast("string")}
    )
    outdated = arriving(rates.late_arrivals(txns), -1).withColumn("amount", F.lit(0.0))
    redated = arriving(txns.where(F.col("event_id") % 10 == 3), 2).withColumn(
        "txn_timestamp", event_time_text(days_before(event, F.lit(1)))
    )
    unread = txns.where(F.col("event_id") % 10 == 7).withColumns(
        {"arrival_timestamp": F.lit("not a time"), "amount": F.lit(1.0)}
    )
    second = F.substring(event_time_text(days_before(arrival, F.lit(-3))), 1, 19)
    close = txns.where(F.col("event_id") % 10 == 8).withColumn(
        "spelling", F.explode(F.array(F.lit(".99Z"), F.lit(".995Z")))
    )
    close = close.withColumns(
        {
            "arrival_timestamp": F.concat(second, "spelling"),
            "amount": F.when(F.col("spelling") == ".99Z", 2.0).otherwise(3.0),
        }
    ).drop("spelling")
    parts = (settled, outdated, redated, unread, close)
    return functools.reduce(DataFrame.unionByName, parts).drop("event_id")


def versions_at_rest(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`versions`, derived once however often they are delivered."""
    path = _once(spark, folder, "versions", lambda path: versions(spark, folder).write.parquet(path))
    return spark.read.parquet(path)


def mended(txns: DataFrame) -> DataFrame:
    """All transactions; those of odd arrival days have their faults mended, so
    that these days pass the gate and the others do not."""
    odd = F.substring("arrival_timestamp", 10, 1).isin("1", "3", "5", "7", "9")
    return txns.withColumns(
        {
            "gateway_id": F.when(odd & (F.col("gateway_id") == "GW-004"), "GW-001").otherwise(
                F.col("gateway_id")
            ),
            "amount": F.when(odd, F.greatest("amount", F.lit(1.0))).otherwise(F.col("amount")),
        }
    )


def written_bronze(spark: SparkSession, folder: str) -> str:
    """Root of the bronze table."""
    bronze = parse.to_bronze(read_transactions(spark, folder))
    return _once(spark, folder, "bronze", lambda path: append_bronze(bronze, path))


def mended_bronze(spark: SparkSession, folder: str) -> str:
    """Root of a bronze table of the caller's own, to write markers to."""
    root = scratch_path(spark, "mended_bronze")
    append_bronze(parse.to_bronze(mended(read_transactions(spark, folder))), root)
    return root


def in_two_deliveries(spark: SparkSession, folder: str) -> list[DataFrame]:
    """All transactions: those up to the logical date, then the later ones."""
    txns = read_transactions(spark, folder)
    early = F.substring("arrival_timestamp", 1, 10) <= LOGICAL_DATE
    return [txns.where(early), txns.where(~early)]


def _absent_as_minus_one(df: DataFrame, *names: str) -> DataFrame:
    """Client tools disagree on how to show a NULL integer; -1 is no valid value
    of the columns this is used for."""
    return df.fillna(-1, subset=list(names))


def transactions_of(bronze: DataFrame) -> DataFrame:
    return bronze.select(*TRANSACTION_COLUMNS, *PARTITION_COLUMNS)


# --- parsing -------------------------------------------------------------------


@query
def bronze_parse(spark, folder):
    return parse.parse_transactions(messages(spark, folder)).drop(INGEST_COLUMN)


@query
def bronze_partition_counts(spark, folder):
    rows = parse.parse_transactions(messages(spark, folder))
    return rows.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def envelope_roundtrip(spark, folder):
    parsed = parse.parse_with_diagnosis(messages(spark, folder))
    text = F.col("value").cast("string")
    return parsed.select(
        F.col("key").cast("string").alias("message_key"),
        text.contains('"failure_reason":null').alias("explicit_null"),
        *TRANSACTION_COLUMNS,
    )


@query
def corrupt_quarantine(spark, folder):
    diagnosed = parse.parse_with_diagnosis(damaged_envelopes(spark, folder))
    return parse.quarantined(diagnosed).select(
        F.col("key").cast("string").alias("message_key"), "reason"
    )


@query
def field_kinds(spark, folder):
    return drift.field_kinds(drifting_envelopes(spark, folder))


@query
def message_drift(spark, folder):
    rows = drift.with_drift(drifting_envelopes(spark, folder))
    return rows.select(F.col("key").cast("string").alias("message_key"), "drift")


@query
def corrupt_bronze(spark, folder):
    """Broken messages stay in the table: as NULL rows, or with one NULL field."""
    diagnosed = parse.parse_with_diagnosis(damaged_envelopes(spark, folder))
    rows = diagnosed.select(
        F.col("key").cast("string").alias("message_key"),
        "txn_id",
        "amount",
        "status",
        "arrival_day",
        "arrival_hour",
    )
    return _absent_as_minus_one(rows, "arrival_day", "arrival_hour")


@query
def row_accounting(spark, folder):
    """Where every message went: silver, a later version's place, or the quarantine."""
    versions_ = parse.encode_envelopes(versions(spark, folder))
    diagnosed = parse.parse_with_diagnosis(damaged_envelopes(spark, folder).unionByName(versions_))
    kept = silver.latest_per_transaction(parse.addressable(parse.bronze_rows(diagnosed)))
    newest = kept.select("txn_id", F.col("arrival_timestamp").alias("kept_arrival"))
    placed = diagnosed.join(newest, "txn_id", "left")
    state = (
        F.when(F.col("reason").isin(*parse.UNADDRESSABLE), "quarantine")
        .when(newest["txn_id"].isNull(), "lost")
        .when(F.col("arrival_timestamp").eqNullSafe(F.col("kept_arrival")), "silver")
        .otherwise("replaced")
    )
    return placed.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def timestamp_variants(spark, folder):
    """Arrival texts in valid and invalid spellings, and what parses of them."""
    txns = read_transactions(spark, folder, keep=("event_id",))
    text = F.col("arrival_timestamp")
    stem = F.substring(text, 1, 19)
    spellings = [
        text,
        F.concat(F.substring(text, 1, 22), F.lit("Z")),  # two fraction digits
        F.concat(stem, F.lit("Z")),  # no fraction
        F.concat(F.substring(text, 1, 23), F.lit("000Z")),  # six digits
        F.concat(F.substring(text, 1, 23), F.lit("+05:30")),
        F.concat(F.lit("2024-1-"), F.substring(text, 9, 16)),  # one-digit month
        F.concat(F.substring(text, 1, 11), F.lit("24:00:00.000Z")),
        F.concat(F.lit("2024-02-30"), F.substring(text, 11, 14)),
        F.concat(text, F.lit(" ")),
        F.lit(""),
    ]
    kind = F.col("event_id") % len(spellings)
    variant = F.when(kind == 0, spellings[0])
    for place, spelling in enumerate(spellings[1:], start=1):
        variant = variant.when(kind == place, spelling)
    moment = parse_event_time(F.col("variant"))
    parsed = txns.select("event_id", variant.alias("variant")).select(
        "event_id",
        "variant",
        event_time_text(moment).alias("parsed"),
        F.year(moment).alias("arrival_year"),
        F.month(moment).alias("arrival_month"),
        F.dayofmonth(moment).alias("arrival_day"),
        F.hour(moment).alias("arrival_hour"),
    )
    return _absent_as_minus_one(parsed, *PARTITION_COLUMNS)


# --- bronze table and quality gate ---------------------------------------------


@query
def bronze_table(spark, folder):
    root = written_bronze(spark, folder)
    return transactions_of(read_bronze(spark, root))


@query
def day_scan(spark, folder):
    root = written_bronze(spark, folder)
    return transactions_of(read_day(spark, root, LOGICAL_DATE))


def _rounded(summary: DataFrame) -> DataFrame:
    shares_ = ("missing_percent", "unexpected_percent", "unexpected_percent_total")
    counts = ["element_count", "missing_count", "unexpected_count"]
    return _absent_as_minus_one(
        summary.withColumns({name: F.round(name, 6) for name in shares_}), *counts
    )


def _bronze(spark, folder) -> DataFrame:
    return parse.to_bronze(read_transactions(spark, folder))


@query
def rule_summary(spark, folder):
    return _rounded(validation.summarize_rules(_bronze(spark, folder)))


@query
def rule_summary_by_day(spark, folder):
    return _rounded(validation.summarize_rules(_bronze(spark, folder), by=DAY_COLUMNS))


@query
def rule_summary_doubled(spark, folder):
    rows = parse.to_bronze(doubled(spark, folder))
    return _rounded(validation.summarize_rules(rows))


@query
def rule_summary_incremental(spark, folder):
    """A table validated after each of two appends, the second with copies of earlier
    rows: the second run reads the new files only."""
    root, state = scratch_path(spark, "bronze"), scratch_path(spark, "state")
    early, late = in_two_deliveries(spark, folder)
    txns = read_transactions(spark, folder, keep=("event_id",))
    again = txns.where(F.col("event_id") % 100 == 0).drop("event_id")
    for delivery in (early, late.unionByName(again)):
        append_bronze(parse.to_bronze(delivery), root)
        summary, _, _ = incremental.validate_files(spark, root, read_bronze(spark, root), state)
    return _rounded(summary)


@query
def schema_rule(spark, folder):
    """The column rule on the written table as Spark reads it, as the engine
    arranges it, without a column and with two columns swapped."""
    rows = spark.read.parquet(written_bronze(spark, folder))
    ordered = in_contract_order(rows)
    first, second, *rest = ordered.columns
    tables = {
        "as_written": rows,
        "in_contract_order": ordered,
        "without_amount": ordered.drop("amount"),
        "first_two_swapped": ordered.select(second, first, *rest),
    }
    checked = [
        validation.check_columns(table.columns, spark).withColumn("variant", F.lit(name))
        for name, table in tables.items()
    ]
    return functools.reduce(DataFrame.unionByName, checked).select(
        "variant", "rule_id", "rule_type", "kwargs", "success"
    )


@query
def suite_statistics(spark, folder):
    return validation.suite_statistics(validation.summarize_rules(_bronze(spark, folder)))


@query
def failed_rules(spark, folder):
    summary = validation.summarize_rules(_bronze(spark, folder))
    return _rounded(validation.failed_rules(summary))


@query
def unexpected_samples(spark, folder):
    rows = parse.to_bronze(doubled(spark, folder))
    return validation.unexpected_samples(rows)


@query
def duplicate_rows(spark, folder):
    return duplicates.duplicate_rows(doubled(spark, folder))


@query
def duplicate_rows_hot(spark, folder):
    """A third of all rows under one id, looked up in the broadcast table."""
    txns = read_transactions(spark, folder, keep=("event_id",))
    one = F.when(F.col("event_id") % 3 == 0, "TXN-HOT").otherwise(F.col("txn_id"))
    return duplicates.duplicate_rows(
        txns.withColumn("txn_id", one).drop("event_id"), hot_share=0.01, hot_rows=100
    )


@query
def duplicate_marks(spark, folder):
    marked = duplicates.mark_duplicates(doubled(spark, folder))
    return marked.select("txn_id", "arrival_timestamp", "is_duplicate")


@query
def gate_report(spark, folder):
    """All days validated; the written reports read back, one row per day."""
    root = mended_bronze(spark, folder)
    reports = gate.run_gate_for_all_days(spark, root, scratch_path(spark, "reports"))
    return reports.select(
        "logical_date",
        "success",
        "statistics.evaluated_expectations",
        "statistics.successful_expectations",
        "statistics.unsuccessful_expectations",
        F.round("statistics.success_percent", 6).alias("success_percent"),
        F.array_join(
            F.transform("failed_expectations", lambda rule: rule["expectation_type"]), ","
        ).alias("failed_types"),
        F.aggregate(
            F.transform("failed_expectations", lambda rule: rule["result"]["unexpected_count"]),
            F.lit(0).cast("bigint"),
            lambda total, n: total + n,
        ).alias("unexpected_values"),
    )


@query
def gate_single_day(spark, folder):
    """The one-day gate on a day that passes, then the read."""
    root = mended_bronze(spark, folder)
    passed = gate.run_gate(spark, root, LOGICAL_DATE, scratch_path(spark, "reports"))
    day = gate.read_if_published(spark, root, LOGICAL_DATE)
    return transactions_of(day).withColumn("passed", F.lit(passed))


@query
def published_read(spark, folder):
    """The days that pass, as validated: rows appended afterwards do not show."""
    root = mended_bronze(spark, folder)
    gate.run_gate_for_all_days(spark, root, scratch_path(spark, "reports"))
    append_bronze(parse.to_bronze(read_transactions(spark, folder)), root)
    return transactions_of(gate.read_published(spark, root))


# --- rates, shares and profiles ------------------------------------------------


@query
def late_arrivals(spark, folder):
    return rates.late_arrivals(read_transactions(spark, folder))


@query
def failed_transactions(spark, folder):
    return rates.failed_transactions(read_transactions(spark, folder))


@query
def failure_late_rates(spark, folder):
    return rates.with_rates(rates.totals(read_transactions(spark, folder)))


@query
def rates_per_1000(spark, folder):
    """The sequence starts at 17 and has two gaps after every number."""
    txns = read_transactions(spark, folder, keep=("event_id",))
    return rates.running_rates(txns.withColumn("sequence", F.col("event_id") * 3 + 17), "sequence")


def _rounded_shares(compared: DataFrame) -> DataFrame:
    names = ("observed_share", "expected_share", "share_difference")
    return compared.withColumns({name: F.round(name, 6) for name in names})


@query
def share_vs_weight_segment(spark, folder):
    return _rounded_shares(shares.segment_shares(read_transactions(spark, folder)))


@query
def share_vs_weight_category(spark, folder):
    return _rounded_shares(shares.category_shares(read_transactions(spark, folder)))


@query
def share_vs_weight_method(spark, folder):
    return _rounded_shares(shares.method_shares(read_transactions(spark, folder)))


@query
def share_vs_weight_reason(spark, folder):
    return _rounded_shares(shares.reason_shares(read_transactions(spark, folder)))


@query
def share_vs_weight_city(spark, folder):
    return _rounded_shares(shares.city_shares(read_transactions(spark, folder)))


@query
def share_vs_weight_hour(spark, folder):
    return _rounded_shares(shares.hour_shares(read_transactions(spark, folder)))


@query
def lateness_profile(spark, folder):
    return shares.lateness_profile(read_transactions(spark, folder))


@query
def merchant_zipf(spark, folder):
    ranked = ranking.merchant_rank_weights(read_transactions(spark, folder))
    return ranked.withColumns(
        {name: F.round(name, 6) for name in ("observed_share", "rank_weight")}
    )


# --- lookups and formulas ------------------------------------------------------


@query
def enrich_dims(spark, folder):
    enriched = enrichment.enrich(read_transactions(spark, folder))
    return _absent_as_minus_one(enriched, "gateway_latency_ms", "settlement_hours")


@query
def gateway_violations(spark, folder):
    return routing.on_ineligible_gateway(read_transactions(spark, folder))


@query
def gateway_eligible(spark, folder):
    return routing.on_eligible_gateway(read_transactions(spark, folder))


@query
def methods_to_gateways(spark, folder):
    choice = routing.gateway_choice(read_transactions(spark, folder))
    return choice.withColumn("eligible_gateways", F.array_join("eligible_gateways", ","))


@query
def processor_mismatch(spark, folder):
    return routing.processor_mismatches(read_transactions(spark, folder))


@query
def expected_failure(spark, folder):
    scored = enrichment.expected_failure(read_transactions(spark, folder))
    return scored.select(
        "txn_id", F.round("failure_probability", 6).alias("failure_probability")
    )


@query
def expected_vs_actual(spark, folder):
    compared = enrichment.expected_versus_actual(read_transactions(spark, folder))
    return compared.withColumn("expected_failures", F.round("expected_failures", 6))


@query
def amount_zscore(spark, folder):
    scored = enrichment.amount_scores(read_transactions(spark, folder))
    return scored.select(
        "txn_id", "amount", "expected_amount", F.round("amount_zscore", 6).alias("amount_zscore")
    )


@query
def amount_clamp(spark, folder):
    txns = read_transactions(spark, folder)
    return txns.select("txn_id", "amount", clamp_amount(F.col("amount")).alias("clamped"))


@query
def weighted_assignment(spark, folder):
    """Each row drawn a segment, category, method, reason, city and hour."""
    txns = read_transactions(spark, folder).select("txn_id")
    draws = {
        "segment": (dims.SEGMENT, "segment", lambda row: row["weight"] * row["txn_frequency"]),
        "category": (dims.MERCHANT_CATEGORY, "category", None),
        "method": (dims.PAYMENT_METHOD, "method", None),
        "reason": (dims.FAILURE_REASON, "reason", None),
        "city": (dims.LOCATION, "city", None),
        "hour": (dims.HOUR_WEIGHT, "hour", None),
    }
    drawn = {
        f"drawn_{name}": assignment.draw_from_dimension(
            F.concat(F.lit(f"{name}:"), F.col("txn_id")), dim, value, weigh
        )
        for name, (dim, value, weigh) in draws.items()
    }
    return txns.withColumn("draw_id", hashed_id("TXN-", F.col("txn_id"))).withColumns(drawn)


@query
def segment_assignment(spark, folder):
    """Each row drawn a segment through the table lookup that pools use."""
    txns = read_transactions(spark, folder).select("txn_id")
    key = F.concat(F.lit("segment:"), F.col("txn_id"))
    return assignment.assign_by_weight(
        txns, key, assignment.frequency_intervals(spark), "drawn_segment"
    )


@query
def merchant_assignment(spark, folder):
    """Each row drawn a merchant by rank weight."""
    txns = read_transactions(spark, folder).select("txn_id")
    number = F.round(unit_interval(F.col("txn_id")), 9)
    return assignment.assign_by_weight(
        txns.withColumn("uniform", number),
        F.col("txn_id"),
        assignment.merchant_intervals(spark),
        "drawn_merchant",
        cells=1024,
    )


# --- silver and gold -----------------------------------------------------------


@query
def silver_dedupe(spark, folder):
    """Repeated ids first; only the rows that compete are ranked."""
    rows = doubled(spark, folder).unionByName(versions(spark, folder))
    return silver.latest_versions(rows, scratch_path(spark, "repeated"))


@query
def silver_dedupe_ranked(spark, folder):
    """Every row ranked."""
    rows = doubled(spark, folder).unionByName(versions(spark, folder))
    return silver.latest_per_transaction(rows)


@query
def silver_upsert(spark, folder):
    """A first load, then a batch of other versions, delivered twice."""
    path = scratch_path(spark, "silver")
    silver.upsert_silver(read_transactions(spark, folder), path)
    batch = versions_at_rest(spark, folder)
    for _ in range(2):
        silver.upsert_silver(batch, path)
    rows = silver.read_silver(spark, path).drop("updated_at")
    return rows.withColumn("event_date", F.col("event_date").cast("string"))


def _rounded_gold(rolled: DataFrame) -> DataFrame:
    return rolled.withColumns(
        {"amount_sum": F.round("amount_sum", 2), "failure_rate": F.round("failure_rate", 6)}
    )


@query
def gold_routes(spark, folder):
    return _rounded_gold(gold.route_summary(read_transactions(spark, folder)))


@query
def gold_rollup(spark, folder):
    return _rounded_gold(gold.route_rollup(read_transactions(spark, folder)))


@query
def gold_cube(spark, folder):
    return _rounded_gold(gold.route_cube(read_transactions(spark, folder)))


@query
def silver_changes(spark, folder):
    """What the second of two upserts changed: rows before and rows after."""
    path = scratch_path(spark, "silver")
    for batch in (read_transactions(spark, folder), versions(spark, folder)):
        silver.upsert_silver(batch, path)
    return silver.changed_rows(spark, path).select("sign", *TRANSACTION_COLUMNS)


@query
def gold_incremental(spark, folder):
    """The route cube after three upserts, brought up to date after each of them."""
    path, cube = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    for batch in (*in_two_deliveries(spark, folder), versions(spark, folder)):
        silver.upsert_silver(batch, path)
        gold.update_gold(spark, path, cube)
    return _rounded_gold(gold.read_gold(spark, cube))


@query
def gold_daily(spark, folder):
    return _rounded_gold(gold.daily_summary(_bronze(spark, folder)))


# --- streams ---------------------------------------------------------------------


@query
def stream_bronze(spark, folder):
    """Messages through the file sink, with a restart between two deliveries."""
    inbox, root, checkpoint = _places(spark, "inbox", "bronze", "checkpoint")
    for delivery in in_two_deliveries(spark, folder):
        publish_to_files(delivery, inbox)
        bronze_stream.start_bronze_files(
            stream_from_files(spark, inbox), root, checkpoint, available_now=True
        ).awaitTermination()
    return transactions_of(read_bronze(spark, root))


@query
def stream_quarantine(spark, folder):
    """Damaged messages through the batch callback: the quarantine output."""
    inbox, root, side, checkpoint = _places(
        spark, "inbox", "bronze", "quarantine", "checkpoint"
    )
    damaged_envelopes(spark, folder).write.parquet(inbox)
    bronze_stream.start_bronze_batches(
        stream_from_files(spark, inbox),
        root,
        checkpoint,
        quarantine=side,
        available_now=True,
    ).awaitTermination()
    return spark.read.parquet(side).select(
        F.col("key").cast("string").alias("message_key"), "reason"
    )


@query
def stream_replay(spark, folder):
    """The same micro-batch delivered twice leaves one copy of its rows."""
    batch, root = messages(spark, folder), scratch_path(spark, "bronze")
    for _ in range(2):
        bronze_stream.write_bronze_batch(batch, "replay-0", root)
    return transactions_of(read_bronze(spark, root))


@query
def bronze_compacted(spark, folder):
    """Two halves and a small batch, merged; the small one replayed and another, merged
    again after the folders that no longer count were removed."""
    txns, root = read_transactions(spark, folder, keep=("event_id",)), scratch_path(spark, "bronze")
    place = F.col("event_id") % 100
    number = F.when(place == 97, 2).when(place == 99, 3).otherwise(place % 2)

    def deliver(wanted: int) -> None:
        # By hour, as the rows of a topic come: each task writes hours of its own.
        rows = txns.where(number == wanted).repartition(8, F.substring("arrival_timestamp", 1, 13))
        bronze_stream.write_bronze_batch(parse.encode_envelopes(rows), f"stream-{wanted}", root)

    for wanted in (0, 1, 2):
        deliver(wanted)
    compaction.compact_bronze(spark, root)
    for wanted in (2, 3):
        deliver(wanted)
    compaction.compact_bronze(spark, root, grace=dt.timedelta(0))
    return transactions_of(read_bronze(spark, root))


@query
def stream_dedupe(spark, folder):
    """Messages from the far future first, then all, then a hundredth of them again."""
    inbox, path, checkpoint = _places(spark, "inbox", "deduplicated", "checkpoint")
    txns = read_transactions(spark, folder, keep=("event_id",))
    far = txns.where(F.col("event_id") % 1000 == 7).withColumns(
        {"txn_id": F.concat("txn_id", F.lit("F")), "arrival_timestamp": F.lit("2999-01-01T00:00:00.000Z")}
    )
    for delivery in (far, txns, txns.where(F.col("event_id") % 100 == 0)):
        publish_to_files(delivery, inbox)
        bronze = parse.parse_transactions(stream_from_files(spark, inbox))
        dedupe_stream.start_append(
            dedupe_stream.deduplicate_stream(bronze, "2 hours"),
            path,
            checkpoint,
            available_now=True,
        ).awaitTermination()
    return transactions_of(spark.read.parquet(path))


@query
def stream_silver(spark, folder):
    """Half of the versions before their transactions and half after them, in four
    deliveries with a restart between any two."""
    inbox, path, checkpoint = _places(spark, "inbox", "silver", "checkpoint")
    txns, changed = read_transactions(spark, folder), versions(spark, folder)
    half = F.crc32("txn_id") % 2 == 0
    for delivery in (changed.where(half), txns.where(~half), changed.where(~half), txns.where(half)):
        publish_to_files(delivery, inbox)
        silver_stream.start_silver(
            parse.parse_transactions(stream_from_files(spark, inbox)),
            path,
            checkpoint,
            "2 hours",
            available_now=True,
        ).awaitTermination()
    rows = silver.read_silver(spark, path).drop("updated_at")
    return rows.withColumn("event_date", F.col("event_date").cast("string"))


@query
def stream_rates(spark, folder):
    """Running totals over two deliveries, resumed in between, and then anew from a
    fresh checkpoint, which starts at zero and ends at the same totals."""
    inbox, path, checkpoint, fresh = _places(spark, "inbox", "totals", "checkpoint", "checkpoint")

    def run(place: str) -> None:
        metrics_stream.start_totals(
            parse.parse_transactions(stream_from_files(spark, inbox)),
            path,
            place,
            available_now=True,
        ).awaitTermination()

    for delivery in in_two_deliveries(spark, folder):
        publish_to_files(delivery, inbox)
        run(checkpoint)
    run(fresh)
    return metrics_stream.latest_totals(metrics_stream.read_totals(spark, path))


def _places(spark, *labels):
    return (scratch_path(spark, label) for label in labels)
