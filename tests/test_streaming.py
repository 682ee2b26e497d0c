from __future__ import annotations

import pytest
from payment_rows import good
from pyspark.sql import functions as F

from paystrata.operators import parse
from paystrata.schema import ENVELOPE_SCHEMA
from paystrata.sinks.envelopes import publish_to_files
from paystrata.sources.bronze import read_bronze
from paystrata.sources.envelopes import stream_from_files
from paystrata.sinks.bronze import append_bronze
from paystrata.streaming.bronze import (
    start_bronze_batches,
    start_bronze_files,
    start_quarantine_files,
    write_bronze_batch,
)
from paystrata.streaming.dedupe import deduplicate_stream, start_append
from paystrata.streaming.metrics import latest_totals, read_totals, start_totals


def drain(query):
    query.awaitTermination()
    return query


def paths(tmp_path, *names):
    return [str(tmp_path / name) for name in names]


def test_restart_continues_where_it_stopped(spark, transactions, tmp_path):
    source, root, checkpoint = paths(tmp_path, "in", "bronze", "ck")

    def run():
        return drain(
            start_bronze_files(
                stream_from_files(spark, source), root, checkpoint, available_now=True
            )
        )

    publish_to_files(transactions(10), source)
    first = run()
    assert first.lastProgress.observedMetrics["bronze"].rows == 10
    publish_to_files(transactions([good(txn_id=f"TXN-B{n:011X}") for n in range(5)]), source)
    run()
    run()  # nothing new
    table = read_bronze(spark, root)
    assert table.count() == table.select("txn_id").distinct().count() == 15


def test_stream_equals_batch(spark, transactions, tmp_path):
    source, root, checkpoint = paths(tmp_path, "in", "bronze", "ck")
    rows = transactions([good(), good(txn_id=None), good(arrival_timestamp="x")])
    publish_to_files(rows, source)
    stream = stream_from_files(spark, source)
    drain(
        start_bronze_files(stream, root, checkpoint, available_now=True, files_per_partition=2)
    )
    batch = parse.parse_transactions(parse.encode_envelopes(rows)).drop("pipeline_timestamp")
    assert read_bronze(spark, root).drop("pipeline_timestamp").exceptAll(batch).isEmpty()
    assert read_bronze(spark, root).count() == 3


def test_ingest_time_is_one_per_batch(spark, transactions, tmp_path):
    source, root, checkpoint = paths(tmp_path, "in", "bronze", "ck")
    publish_to_files(transactions(50).repartition(4), source)
    drain(start_bronze_files(stream_from_files(spark, source), root, checkpoint, available_now=True))
    assert read_bronze(spark, root).select("pipeline_timestamp").distinct().count() == 1


def test_batches_report_counts_and_fill_the_quarantine(spark, transactions, tmp_path):
    source, root, side, checkpoint = paths(tmp_path, "in", "bronze", "side", "ck")
    publish_to_files(transactions(7), source)
    broken = spark.createDataFrame([(b"k", b"oops"), (None, b"{}")], ENVELOPE_SCHEMA)
    broken.write.mode("append").parquet(source)
    seen = []
    drain(
        start_bronze_batches(
            stream_from_files(spark, source),
            root,
            checkpoint,
            quarantine=side,
            available_now=True,
            on_batch=lambda number, counts: seen.append((number, counts)),
        )
    )
    assert seen == [(0, {"rows": 9, "unroutable": 2, "unsound": 2})]
    assert read_bronze(spark, root).count() == 9
    quarantine = spark.read.parquet(side)
    assert sorted(r.reason for r in quarantine.collect()) == ["malformed_json", "no_fields"]
    assert sorted(bytes(r.value) for r in quarantine.collect()) == [b"oops", b"{}"]


def test_replayed_batch_leaves_one_copy(spark, transactions, tmp_path):
    (root, side) = paths(tmp_path, "bronze", "side")
    batch = parse.encode_envelopes(transactions([good(), good(arrival_timestamp="x")]))
    for _ in range(2):
        counts = write_bronze_batch(batch, "q-0", root, quarantine=side)
    assert counts == {"rows": 2, "unroutable": 1, "unsound": 1}
    assert read_bronze(spark, root).count() == 2
    assert spark.read.parquet(side).count() == 1
    write_bronze_batch(batch, "q-1", root, quarantine=side)
    assert read_bronze(spark, root).count() == 4


def test_replay_after_a_lost_commit(spark, transactions, tmp_path):
    """The batch ran but its commit record is lost: the restart runs it again."""
    source, root, checkpoint = paths(tmp_path, "in", "bronze", "ck")
    publish_to_files(transactions(6), source)

    def run():
        drain(
            start_bronze_batches(
                stream_from_files(spark, source), root, checkpoint, available_now=True
            )
        )

    run()
    for name in ("0", ".0.crc"):
        (tmp_path / "ck/commits" / name).unlink()
    run()
    assert read_bronze(spark, root).count() == 6


def test_new_stream_does_not_overwrite_an_older_one(spark, transactions, tmp_path):
    source, root = paths(tmp_path, "in", "bronze")
    publish_to_files(transactions(3), source)
    for checkpoint in paths(tmp_path, "ck1", "ck2"):
        drain(
            start_bronze_batches(
                stream_from_files(spark, source), root, checkpoint, available_now=True
            )
        )
    assert read_bronze(spark, root).count() == 6


def test_empty_batch_writes_nothing(spark, transactions, tmp_path):
    (root,) = paths(tmp_path, "bronze")
    batch = parse.encode_envelopes(transactions(1)).where("false")
    assert write_bronze_batch(batch, "q-0", root)["rows"] == 0
    assert not list((tmp_path / "bronze").glob("arrival_year=*"))


def test_copies_in_later_batches_are_dropped(spark, transactions, tmp_path):
    source, out, checkpoint = paths(tmp_path, "in", "out", "ck")

    def run():
        stream = parse.parse_transactions(stream_from_files(spark, source))
        drain(
            start_append(
                deduplicate_stream(stream, "2 days"),
                out,
                checkpoint,
                partition_by=["arrival_day"],
                available_now=True,
            )
        )

    far = good(txn_id="TXN-FAR", arrival_timestamp="2999-01-01T00:00:00.000Z")
    publish_to_files(transactions([far]), source)
    run()  # a time inside a message does not move the clock
    publish_to_files(transactions(4), source)
    run()
    publish_to_files(transactions(6), source)
    publish_to_files(transactions([good(txn_id=None), good(txn_id=" ")]), source)
    run()
    assert spark.read.parquet(out).count() == 6


def test_totals_accumulate_over_triggers(spark, transactions, tmp_path):
    source, out, checkpoint = paths(tmp_path, "in", "out", "ck")

    def run():
        stream = parse.parse_transactions(stream_from_files(spark, source))
        drain(start_totals(stream, out, checkpoint, available_now=True))

    publish_to_files(transactions(3), source)
    run()
    late = good(status="FAILED", txn_timestamp="2024-01-12T00:00:00.000Z")
    publish_to_files(transactions([late]), source)
    run()
    recorded = read_totals(spark, out)
    assert [r.published for r in recorded.collect()] == [4]  # one record however many triggers
    newest = latest_totals(recorded).first()
    assert (newest.published, newest.failed, newest.late) == (4, 1, 1)
    assert (newest.failure_rate, newest.late_rate) == (25.0, 25.0)
    # A stream over two messages with a checkpoint of its own counts two.
    other = str(tmp_path / "other")
    publish_to_files(transactions(2), other)
    stream = parse.parse_transactions(stream_from_files(spark, other))
    drain(start_totals(stream, out, str(tmp_path / "ck2"), available_now=True))
    assert latest_totals(read_totals(spark, out)).first().published == 2
    assert sorted(r.published for r in read_totals(spark, out).collect()) == [2, 4]


def test_the_two_kinds_of_writers_are_not_mixed(spark, transactions, tmp_path):
    source, logged, plain, checkpoint = paths(tmp_path, "in", "logged", "plain", "ck")
    publish_to_files(transactions(2), source)
    stream = stream_from_files(spark, source)
    drain(start_bronze_files(stream, logged, checkpoint, available_now=True))
    bronze = parse.to_bronze(transactions(2))
    with pytest.raises(ValueError, match="commit log"):
        append_bronze(bronze, logged)
    with pytest.raises(ValueError, match="commit log"):
        write_bronze_batch(parse.encode_envelopes(transactions(2)), "q-0", logged)
    append_bronze(bronze, plain)
    with pytest.raises(ValueError, match="commit log"):
        start_bronze_files(stream, plain, checkpoint + "2", available_now=True)
    write_bronze_batch(parse.encode_envelopes(transactions(3)), "q-0", str(tmp_path / "new"))


def test_quarantine_of_the_file_sink(spark, transactions, tmp_path):
    source, side, checkpoint = paths(tmp_path, "in", "side", "ck")
    publish_to_files(transactions(4), source)
    bad = spark.createDataFrame([(b"k", b"oops"), (b"l", None)], ENVELOPE_SCHEMA)
    bad.write.mode("append").parquet(source)
    for _ in range(2):
        stream = stream_from_files(spark, source)
        drain(start_quarantine_files(stream, side, checkpoint, available_now=True))
    rows = spark.read.parquet(side).collect()
    assert sorted((bytes(r.key), r.reason) for r in rows) == [
        (b"k", "malformed_json"), (b"l", "empty_payload")
    ]
