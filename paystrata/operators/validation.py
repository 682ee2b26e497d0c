"""Evaluating a rule suite over a table, for the whole table or per group.

Cost: all row rules share one scan and one hash aggregate, whose map side
reduces every task's rows to one record per group before the shuffle. Each
uniqueness rule adds one aggregation over its column alone. Both reduce a hot
key on the map side, so no task ever sees an unreduced group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paystrata.operators.rules import BRONZE_SUITE, COLUMNS_IN_ORDER, NOT_NULL, UNIQUE, Rule
from paystrata.operators.rules import columns_in_order

SAMPLE_SIZE = 20
SUMMARY_COLUMNS = (
    "rule_id",
    "rule_type",
    "column",
    "kwargs",
    "success",
    "element_count",
    "missing_count",
    "missing_percent",
    "unexpected_count",
    "unexpected_percent",
    "unexpected_percent_total",
    "error",
)


def _count(value: Column | None) -> Column:
    return (F.lit(None) if value is None else value).cast("bigint")


def _outcome(
    rule: Rule,
    *,
    elements: Column | None = None,
    missing: Column | None = None,
    unexpected: Column | None = None,
    holds: bool | None = None,
    error: str | None = None,
) -> Column:
    return F.struct(
        F.lit(rule.rule_id).alias("rule_id"),
        F.lit(rule.rule_type).alias("rule_type"),
        F.lit(rule.column).cast("string").alias("column"),
        F.lit(rule.kwargs).alias("kwargs"),
        _count(elements).alias("element_count"),
        _count(missing).alias("missing_count"),
        _count(unexpected).alias("unexpected_count"),
        F.lit(holds).cast("boolean").alias("holds"),
        F.lit(error).cast("string").alias("error"),
    )


def summarize_rules(
    df: DataFrame, suite: Sequence[Rule] = BRONZE_SUITE, by: Sequence[str] = ()
) -> DataFrame:
    """One row per rule (and per group of ``by``), ordered columns as in
    :data:`SUMMARY_COLUMNS`. A rule over a missing column fails with an error;
    on an empty table all column rules hold and percentages are NULL."""
    return finished_summary(rule_counts(df, suite, by), by)


def rule_counts(
    df: DataFrame, suite: Sequence[Rule] = BRONZE_SUITE, by: Sequence[str] = ()
) -> DataFrame:
    """What :func:`summarize_rules` counts, before verdicts and percentages."""
    grouping = [rule for rule in suite if _needs_grouping(df, rule)]
    others = [rule for rule in suite if rule not in grouping]
    parts = [_uniqueness(df, rule, by) for rule in grouping]
    if others:
        parts.append(_one_pass(df, others, by))
    return reduce(DataFrame.unionByName, parts)


def finished_summary(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The summary that counts (of :func:`rule_counts`) give."""
    elements, missing = F.col("element_count"), F.col("missing_count")
    unexpected = F.col("unexpected_count")
    present = elements - F.coalesce(missing, F.lit(0))
    finished = counts.withColumns(
        {
            "success": F.coalesce("holds", unexpected == 0),
            "missing_percent": _percent(missing, elements),
            "unexpected_percent": _percent(unexpected, present),
            "unexpected_percent_total": _percent(unexpected, elements),
        }
    )
    return finished.select(*by, *SUMMARY_COLUMNS)


def merged_counts(counts: DataFrame) -> DataFrame:
    """Counts of parts of a table as those of the whole; what a uniqueness rule counts
    must be what each part adds (:func:`uniqueness_added`)."""
    return counts.groupBy("rule_id", "rule_type", "column", "kwargs").agg(
        *(F.sum(name).alias(name) for name in ("element_count", "missing_count", "unexpected_count")),
        F.bool_and("holds").alias("holds"),
        F.max("error").alias("error"),
    )


def uniqueness_added(sizes: DataFrame, before: DataFrame | None, rule: Rule) -> DataFrame:
    """Counts that new rows add to a uniqueness rule.

    ``sizes`` are the new rows' values with their numbers (``value``, ``n``), ``before``
    those of all earlier parts, in which a value may occur several times. Only earlier
    values that occur again are grouped; the earlier ones are not shuffled where the
    new ones are small enough to broadcast.
    """
    if before is None:
        known = sizes.withColumn("m", F.lit(0).cast("bigint"))
    else:
        again = before.join(sizes.select("value"), "value", "left_semi")
        known = sizes.join(again.groupBy("value").agg(F.sum("n").alias("m")), "value", "left").fillna(0, ["m"])
    n, m = F.col("n"), F.col("m")
    repeated = F.when(n + m > 1, n + m).otherwise(0) - F.when(m > 1, m).otherwise(0)
    is_null = F.col("value").isNull()
    totals = known.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum(F.when(is_null, n)), F.lit(0)).alias("_nulls"),
        F.coalesce(F.sum(F.when(~is_null, repeated)), F.lit(0)).alias("_bad"),
    )
    outcome = _outcome(rule, elements=F.col("_rows"), missing=F.col("_nulls"), unexpected=F.col("_bad"))
    return totals.select(F.inline(F.array(outcome)))


def check_columns(
    present: Sequence[str], spark: SparkSession, suite: Sequence[Rule] = BRONZE_SUITE
) -> DataFrame:
    """The outcome of the suite's column rules for a table with these columns; the
    data is not read."""
    rows = [
        (rule.rule_id, rule.rule_type, rule.kwargs, columns_in_order(list(present), rule.params["column_list"]))
        for rule in suite
        if rule.rule_type == COLUMNS_IN_ORDER
    ]
    return spark.createDataFrame(rows, "rule_id int, rule_type string, kwargs string, success boolean")


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.lit(100.0) * part / whole)


def _needs_grouping(df: DataFrame, rule: Rule) -> bool:
    return rule.rule_type == UNIQUE and rule.column in df.columns


def _one_pass(df: DataFrame, rules: Sequence[Rule], by: Sequence[str]) -> DataFrame:
    """Counts of all rules that need no regrouping, from a single aggregate."""
    ready = [rule for rule in rules if rule.is_row_rule and rule.column in df.columns]
    with_nulls = sorted({rule.column for rule in ready if rule.rule_type != NOT_NULL})
    totals = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.col(name).isNull()).alias(f"_null_{name}") for name in with_nulls),
        *(F.count_if(rule.unexpected()).alias(f"_bad_{rule.rule_id}") for rule in ready),
    )
    outcomes = []
    for rule in rules:
        if rule.rule_type == COLUMNS_IN_ORDER:
            holds = columns_in_order(df.columns, rule.params["column_list"])
            outcomes.append(_outcome(rule, holds=holds))
        elif rule not in ready:
            outcomes.append(_outcome(rule, holds=False, error="column_missing"))
        else:
            # For a not-null rule the NULLs are the unexpected values.
            missing = None if rule.rule_type == NOT_NULL else F.col(f"_null_{rule.column}")
            outcomes.append(
                _outcome(
                    rule,
                    elements=F.col("_rows"),
                    missing=missing,
                    unexpected=F.col(f"_bad_{rule.rule_id}"),
                )
            )
    return totals.select(*by, F.inline(F.array(*outcomes)))


def _group_sizes(df: DataFrame, rule: Rule, by: Sequence[str]) -> DataFrame:
    return (
        df.select(*by, F.col(rule.column).alias("_value"))
        .groupBy(*by, "_value")
        .agg(F.count(F.lit(1)).alias("_size"))
    )


def _uniqueness(df: DataFrame, rule: Rule, by: Sequence[str]) -> DataFrame:
    """Every member of a group of equal non-null values counts as unexpected."""
    size, is_null = F.col("_size"), F.col("_value").isNull()
    totals = _group_sizes(df, rule, by).groupBy(*by).agg(
        F.coalesce(F.sum(size), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum(F.when(is_null, size)), F.lit(0)).alias("_nulls"),
        F.coalesce(F.sum(F.when(~is_null & (size > 1), size)), F.lit(0)).alias("_bad"),
    )
    outcome = _outcome(
        rule, elements=F.col("_rows"), missing=F.col("_nulls"), unexpected=F.col("_bad")
    )
    return totals.select(*by, F.inline(F.array(outcome)))


def _statistics() -> list[Column]:
    evaluated, successful = F.count(F.lit(1)), F.count_if("success")
    return [
        evaluated.alias("evaluated_expectations"),
        successful.alias("successful_expectations"),
        (evaluated - successful).alias("unsuccessful_expectations"),
        (F.lit(100.0) * successful / evaluated).alias("success_percent"),
    ]


def suite_statistics(summary: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Evaluated, successful and unsuccessful rules, and the verdict."""
    return summary.groupBy(*by).agg(*_statistics(), F.bool_and("success").alias("success"))


def failed_rules(summary: DataFrame) -> DataFrame:
    return summary.where(~F.col("success"))


def unexpected_samples(
    df: DataFrame,
    suite: Sequence[Rule] = BRONZE_SUITE,
    by: Sequence[str] = (),
    size: int = SAMPLE_SIZE,
) -> DataFrame:
    """The ``size`` most frequent unexpected values per rule, ties by value.

    Row rules share one scan that emits only broken (rule, value) pairs, which
    are counted on the map side. The rank filter is pushed below the shuffle by
    Spark (window group limit), so a rule with countless distinct bad values
    sends at most ``size`` of them per task.
    """
    present = [rule for rule in suite if rule.column in df.columns]
    row_rules = [rule for rule in present if rule.is_row_rule]
    counted = [broken_values(df, row_rules, by)] if row_rules else []
    counted += [
        _group_sizes(df, rule, by)
        .where(F.col("_value").isNotNull() & (F.col("_size") > 1))
        .select(
            *by,
            F.lit(rule.rule_id).alias("rule_id"),
            F.col("_value").cast("string").alias("value"),
            F.col("_size").alias("n"),
        )
        for rule in present
        if rule.rule_type == UNIQUE
    ]
    if not counted:
        empty = df.select(*by, F.lit(0).alias("rule_id"), F.lit("").alias("value"))
        return empty.withColumns({"n": F.lit(0).cast("bigint"), "place": F.lit(0)}).where("false")
    return most_frequent(reduce(DataFrame.unionByName, counted), by, size)


def broken_values(df: DataFrame, row_rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """``rule_id``, ``value``, ``n``: how often each unexpected value of the rules occurs."""
    pairs = F.array(
        *(
            F.when(
                rule.unexpected(),
                F.struct(
                    F.lit(rule.rule_id).alias("rule_id"),
                    F.col(rule.column).cast("string").alias("value"),
                ),
            )
            for rule in row_rules
        )
    )
    return (
        df.select(*by, F.inline(F.filter(pairs, lambda pair: pair.isNotNull())))
        .groupBy(*by, "rule_id", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def most_frequent(counted: DataFrame, by: Sequence[str] = (), size: int = SAMPLE_SIZE) -> DataFrame:
    """The first ``size`` values per rule, with their ``place``."""
    ranking = Window.partitionBy(*by, "rule_id").orderBy(
        F.col("n").desc(), F.col("value").asc_nulls_first()
    )
    return counted.withColumn("place", F.row_number().over(ranking)).where(F.col("place") <= size)


def suite_report(summary: DataFrame, samples: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One report per group: verdict, statistics and the failed rules.

    Every array is bounded: at most one entry per rule, each with at most
    :data:`SAMPLE_SIZE` sample values.
    """
    keys = [*by, "rule_id"]
    sampled = samples.groupBy(*(F.col(name).alias(f"_{name}") for name in keys)).agg(
        F.array_sort(
            F.collect_list(F.struct("place", "value", F.col("n").alias("count")))
        ).alias("_samples")
    )
    # A group may be keyed by NULL.
    same_group = reduce(
        Column.__and__, (F.col(name).eqNullSafe(F.col(f"_{name}")) for name in keys)
    )
    result = F.struct(
        "element_count",
        "missing_count",
        "missing_percent",
        "unexpected_count",
        "unexpected_percent",
        "unexpected_percent_total",
        F.transform(
            F.col("_samples"),
            lambda entry: F.struct(
                entry["value"].alias("value"), entry["count"].alias("count")
            ),
        ).alias("partial_unexpected_counts"),
        "error",
    )
    failure = F.struct(
        "rule_id",
        F.col("rule_type").alias("expectation_type"),
        "kwargs",
        result.alias("result"),
    )
    failures = F.array_sort(F.collect_list(F.when(~F.col("success"), failure)))
    joined = summary.join(sampled, same_group, "left")
    return joined.groupBy(*by).agg(
        F.bool_and("success").alias("success"),
        F.struct(*_statistics()).alias("statistics"),
        F.transform(failures, lambda entry: entry.dropFields("rule_id")).alias(
            "failed_expectations"
        ),
    )
