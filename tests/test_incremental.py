from __future__ import annotations

import json
from pathlib import Path

import pytest
from payment_rows import good

from paystrata.operators import parse
from paystrata.plans import gate, incremental
from paystrata.sinks.bronze import append_bronze
from paystrata.sources.bronze import DayNotFound

DAY = "2024-01-15"


@pytest.fixture
def roots(tmp_path):
    return str(tmp_path / "bronze"), str(tmp_path / "out")


def row(number, **changes):
    return good(txn_id=f"TXN-{number:012X}", **changes)


def report(reports):
    path = Path(reports) / "quality_reports/bronze/year=2024/month=1/day=15/validation_report.json"
    return {k: v for k, v in json.loads(path.read_text()).items() if k != "validated_at"}


def opened(monkeypatch):
    """How many files each run reads."""
    seen, real = [], incremental.read_listed

    def watched(spark, root, names):
        seen.append(sorted(names))
        return real(spark, root, names)

    monkeypatch.setattr(incremental, "read_listed", watched)
    return seen


def same_as_full(spark, root, reports):
    passed = incremental.run_gate_incrementally(spark, root, DAY, reports)
    assert gate.run_gate(spark, root, DAY, reports + "-full") is passed
    assert report(reports) == report(reports + "-full")
    published = gate.read_if_published(spark, root, DAY)
    assert (published is not None) is passed
    return report(reports), published


def test_second_run_reads_new_files_and_equals_a_full_run(spark, transactions, roots, monkeypatch):
    root, reports = roots
    seen = opened(monkeypatch)
    append_bronze(parse.to_bronze(transactions([row(n) for n in range(6)])), root)
    _, day = same_as_full(spark, root, reports)
    assert day.count() == 6
    append_bronze(parse.to_bronze(transactions([row(n) for n in range(6, 9)])), root)
    _, day = same_as_full(spark, root, reports)
    assert day.count() == 9
    assert len(seen[0]) == 1 and len(seen[1]) == 1 and seen[0] != seen[1]
    same_as_full(spark, root, reports)
    assert len(seen) == 2  # nothing new, nothing read


def test_copies_across_batches_and_broken_values_add_up(spark, transactions, roots):
    root, reports = roots
    first = [row(1), row(2), row(2), row(3, gateway_id="GW-009"), row(4, amount=None), good(txn_id=None)]
    second = [row(1), row(2), row(5, gateway_id="GW-009"), row(6, gateway_id="GW-777"), good(txn_id=None)]
    third = [row(1), row(7), row(3)]
    for batch, repeated in ((first, 2), (second, 5), (third, 8)):
        append_bronze(parse.to_bronze(transactions(batch)), root)
        found, _ = same_as_full(spark, root, reports)
        (unique,) = [f for f in found["failed_expectations"] if f["expectation_type"].endswith("be_unique")]
        assert unique["result"]["unexpected_count"] == repeated


@pytest.mark.parametrize("change", ["gone", "touched", "rules"])
def test_changed_files_or_rules_begin_anew(spark, transactions, roots, monkeypatch, change):
    root, reports = roots
    for start in (0, 10):
        append_bronze(parse.to_bronze(transactions([row(start + n) for n in range(3)])), root)
    incremental.run_gate_incrementally(spark, root, DAY, reports)
    seen = opened(monkeypatch)
    one, other = sorted(Path(root).rglob("*.parquet"))
    if change == "gone":
        one.unlink()
    elif change == "touched":
        one.touch()
    else:
        incremental.run_gate_incrementally(spark, root, DAY, reports, suite=gate.BRONZE_SUITE[:5])
        assert len(seen.pop()) == 2
    same_as_full(spark, root, reports)
    assert len(seen[-1]) == (1 if change == "gone" else 2)


def test_many_loads_are_merged(spark, transactions, roots, monkeypatch, tmp_path):
    monkeypatch.setattr(incremental, "MOST_LOADS", 3)
    root, reports = roots
    for n in range(5):
        append_bronze(parse.to_bronze(transactions([row(n), row(0, amount=-1.0)])), root)
        found, _ = same_as_full(spark, root, reports)
    loads = Path(incremental.state_root(reports, DAY)) / "loads"
    assert len(list(loads.iterdir())) < 5
    assert {f["result"]["unexpected_count"] for f in found["failed_expectations"]} == {6, 5}


def test_a_run_that_dies_is_repeated(spark, transactions, roots, monkeypatch):
    root, reports = roots
    append_bronze(parse.to_bronze(transactions([row(1)])), root)
    with monkeypatch.context() as patch:
        patch.setattr(incremental.versions, "publish", _lost)
        with pytest.raises(RuntimeError):
            incremental.run_gate_incrementally(spark, root, DAY, reports)
    assert gate.read_if_published(spark, root, DAY) is None
    append_bronze(parse.to_bronze(transactions([row(2)])), root)
    assert same_as_full(spark, root, reports)[1].count() == 2


def test_missing_day_raises(spark, transactions, roots):
    root, reports = roots
    append_bronze(parse.to_bronze(transactions(1)), root)
    with pytest.raises(DayNotFound):
        incremental.run_gate_incrementally(spark, root, "2024-01-16", reports)


def _lost(*_):
    raise RuntimeError("driver lost")
