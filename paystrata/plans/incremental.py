"""Incremental validation: a run reads only the files that no earlier run has read.

What a run finds in its new files is kept as a load: counts per rule, how often each
broken value occurs, and how often each value of a unique column occurs. Counts add
up over loads; a uniqueness rule counts what the new values add to all earlier ones,
so that copies in different batches are found. The state names the files it covers;
if one of them is gone or has changed, or the rules have, it begins anew.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.functions.times import parse_logical_date
from paystrata.operators import validation
from paystrata.operators.rules import BRONZE_SUITE, UNIQUE, Rule
from paystrata.plans import gate
from paystrata.session import materialized, scratch_path
from paystrata.sinks import reports
from paystrata.sources import files, versions
from paystrata.sources.bronze import DayNotFound, read_day, read_listed

logger = logging.getLogger(__name__)

#: From this many loads on, a run merges their value counts into one.
MOST_LOADS = 16

_VALUES = "rule_id int, value string, n bigint"


def validate_files(
    spark: SparkSession,
    root: str,
    snapshot: DataFrame,
    state_path: str,
    suite: Sequence[Rule] = BRONZE_SUITE,
    scratch: str | None = None,
) -> tuple[DataFrame, DataFrame, dict[str, list[int]]]:
    """Rule summary, report and files of ``snapshot`` (rows of the table at ``root``; runs jobs).

    Equal to a full validation of the snapshot. Only files that the state at
    ``state_path`` does not cover are opened; the values of unique columns are kept
    there, so the state is about as large as those columns. One run at a time per state.
    """
    manifest = gate.manifest_of(snapshot)
    earlier = versions.listed(spark, state_path)
    rules = [[rule.rule_id, rule.rule_type, rule.column, rule.kwargs] for rule in suite]
    state = versions.content(spark, earlier[-1]) if earlier else {}
    covered = state.get("files", {})
    if state.get("rules") != rules or any(manifest.get(name) != entry for name, entry in covered.items()):
        if earlier:
            logger.warning("files or rules have changed: validating all of %s again", root)
        covered, loads = {}, []
    else:
        loads = state["loads"]
    named = {load for version in earlier[-2:] for load in versions.content(spark, version)["loads"]}
    versions.remove_unnamed(spark, state_path, "loads/*", {f"loads/{load}" for load in named})

    new = [name for name in manifest if name not in covered]
    if new or not loads:
        rows = read_listed(spark, root, new) if new else snapshot
        load = uuid.uuid4().hex
        _write_load(rows, suite, _load(state_path, load), [_load(state_path, one) for one in loads])
        loads = [*loads, load]
        if len(loads) >= MOST_LOADS:
            loads = [_merge_loads(spark, state_path, loads)]
        versions.publish(spark, state_path, earlier, {"rules": rules, "files": manifest, "loads": loads})

    paths = [_load(state_path, load) for load in loads]
    counts = spark.read.parquet(*(f"{path}/counts" for path in paths))
    summary = validation.finished_summary(validation.merged_counts(counts))
    summary = materialized(summary, scratch or scratch_path(spark, "rule_summary"))
    failing = [row.rule_id for row in summary.where(~F.col("success")).select("rule_id").collect()]
    samples = validation.most_frequent(_unexpected(spark, paths, suite, failing))
    return summary, validation.suite_report(summary, samples), manifest


def _load(state_path: str, load: str) -> str:
    return f"{state_path.rstrip('/')}/loads/{load}"


def _write_load(rows: DataFrame, suite: Sequence[Rule], path: str, before: list[str]) -> None:
    spark = rows.sparkSession
    unique = [rule for rule in suite if rule.rule_type == UNIQUE and rule.column in rows.columns]
    others = [rule for rule in suite if rule not in unique]
    parts = [validation.rule_counts(rows, others)] if others else []
    sizes = [
        rows.groupBy(F.lit(rule.rule_id).alias("rule_id"), F.col(rule.column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        for rule in unique
    ]
    if sizes:
        reduce(DataFrame.unionByName, sizes).write.parquet(f"{path}/ids")
    for rule in unique:
        of_rule = F.col("rule_id") == rule.rule_id
        mine = spark.read.schema(_VALUES).parquet(f"{path}/ids").where(of_rule)
        known = _values(spark, before, "ids").where(of_rule) if before else None
        parts.append(validation.uniqueness_added(mine, known, rule))
    row_rules = [rule for rule in others if rule.is_row_rule and rule.column in rows.columns]
    if row_rules:
        validation.broken_values(rows, row_rules).write.parquet(f"{path}/values")
    reduce(DataFrame.unionByName, parts).coalesce(1).write.parquet(f"{path}/counts")


def _values(spark: SparkSession, paths: Sequence[str], kind: str) -> DataFrame:
    """Values of all loads; one may occur in several."""
    there = [f"{path}/{kind}" for path in paths if files.exists(spark, f"{path}/{kind}")]
    if not there:
        return spark.createDataFrame([], _VALUES)
    return spark.read.schema(_VALUES).parquet(*there)


def _merge_loads(spark: SparkSession, state_path: str, loads: list[str]) -> str:
    """One load instead of many."""
    merged = uuid.uuid4().hex
    paths, target = [_load(state_path, load) for load in loads], _load(state_path, merged)
    for kind in ("ids", "values"):
        values = _values(spark, paths, kind).groupBy("rule_id", "value").agg(F.sum("n").alias("n"))
        values.write.parquet(f"{target}/{kind}")
    counts = spark.read.parquet(*(f"{path}/counts" for path in paths))
    validation.merged_counts(counts).coalesce(1).write.parquet(f"{target}/counts")
    return merged


def _unexpected(spark: SparkSession, paths: list[str], suite: Sequence[Rule], failing: list[int]) -> DataFrame:
    """Broken values of the failing rules, counted over all loads."""
    unique = {rule.rule_id for rule in suite if rule.rule_type == UNIQUE}

    def counted(kind: str, rule_ids: list[int]) -> DataFrame:
        values = _values(spark, paths, kind).where(F.col("rule_id").isin(rule_ids))
        return values.groupBy("rule_id", "value").agg(F.sum("n").alias("n"))

    broken = counted("values", [n for n in failing if n not in unique])
    repeated = counted("ids", [n for n in failing if n in unique]).where("value IS NOT NULL AND n > 1")
    return broken.unionByName(repeated)


def state_root(reports_root: str, logical_date: str) -> str:
    date = parse_logical_date(logical_date)
    return f"{reports_root.rstrip('/')}/quality_state/bronze/year={date.year}/month={date.month}/day={date.day}"


def run_gate_incrementally(
    spark: SparkSession,
    root: str,
    logical_date: str,
    reports_root: str,
    suite: Sequence[Rule] = BRONZE_SUITE,
) -> bool:
    """As :func:`paystrata.plans.gate.run_gate`, with the same report and marker, but
    files that an earlier run of the day has validated are not read again."""
    date = parse_logical_date(logical_date)
    scratch = scratch_path(spark, "gate")
    try:
        reports.remove_marker(spark, root, date)
        day = read_day(spark, root, logical_date)
        if day.isEmpty():
            raise DayNotFound(f"no bronze rows for {logical_date} below {root}")
        state = state_root(reports_root, logical_date)
        _, report, manifest = validate_files(spark, root, day, state, suite, scratch)
        return gate.conclude(spark, root, reports_root, date, report, manifest)
    except Exception:
        logger.exception("quality gate failed for %s", logical_date)
        raise
    finally:
        files.delete(spark, scratch)
