from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from paystrata import session
from paystrata.operators.gold import read_gold
from paystrata.operators.parse import parse_transactions, to_bronze
from paystrata.operators.silver import read_silver
from paystrata.plans import jobs
from paystrata.sinks import envelopes as sink
from paystrata.sinks.bronze import append_bronze
from paystrata.sinks.envelopes import publish_to_files
from paystrata.sources import envelopes as source
from paystrata.sources.envelopes import stream_from_files


def test_kafka_source_options():
    assert source.kafka_source_options("host:1") == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "payments.transactions",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    bounded = source.kafka_source_options("host:1", "t", max_offsets_per_trigger=5, min_partitions=9)
    assert bounded["maxOffsetsPerTrigger"] == "5" and bounded["minPartitions"] == "9"


def test_kafka_sink_options():
    assert sink.kafka_sink_options("host:1", "t") == {
        "kafka.bootstrap.servers": "host:1",
        "topic": "t",
        "kafka.acks": "1",
        "kafka.retries": "3",
        "kafka.batch.size": "16384",
        "kafka.linger.ms": "10",
    }


def test_kafka_needs_its_connector(spark, transactions):
    with pytest.raises(Exception, match="(?i)kafka"):
        source.stream_from_kafka(spark, "host:1")
    with pytest.raises(Exception, match="(?i)kafka"):
        sink.publish_to_kafka(transactions(1), "host:1")


def test_object_store_conf():
    conf = session.object_store_conf("eu-west-1")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "s3.eu-west-1.amazonaws.com"
    assert conf["spark.hadoop.fs.s3a.impl"].endswith("S3AFileSystem")


def test_engine_settings_are_on(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


class FakeSession:
    """Just the settings :func:`shared_dir` looks at."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})


def test_shared_folder_comes_from_the_cluster():
    cluster = FakeSession("spark://host:7077", "hdfs:///shared/")
    assert session.shared_dir(cluster) == "hdfs:///shared"
    first, second = (session.scratch_path(cluster, "x") for _ in range(2))
    assert first.startswith("hdfs:///shared/") and first != second


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession("spark://host:7077"))
    local = FakeSession("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)


def test_materialized_rows_are_fixed_and_have_a_size(spark, tmp_path):
    df = session.materialized(spark.range(10).withColumn("x", F.rand()), str(tmp_path / "t"))
    assert sorted(df.collect()) == sorted(df.collect())
    assert "Range" not in df._jdf.queryExecution().executedPlan().toString()
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 100_000


def test_command_line():
    args = jobs.parser().parse_args(
        ["bronze", "--bootstrap", "h:1", "--root", "r", "--checkpoint", "c", "--files-per-partition", "4"]
    )
    assert (args.run, args.interval, args.files_per_partition) == (jobs.bronze, "30 seconds", 4)
    args = jobs.parser().parse_args(["gate", "--root", "r", "--reports", "q", "--date", "2024-01-15"])
    assert args.run is jobs.check
    assert jobs.parser().parse_args(["gate", "--root", "r", "--reports", "q", "--all-days"]).all_days
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["gate", "--root", "r", "--reports", "q"])
    assert args.s3_region is None and args.shuffle_partitions is None


def test_gate_job(spark, transactions, tmp_path):
    root, reports = str(tmp_path / "bronze"), str(tmp_path)
    append_bronze(to_bronze(transactions(2)), root)
    arguments = ["gate", "--root", root, "--reports", reports, "--date", "2024-01-15"]
    assert jobs.main(arguments) == 0
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    to_silver = ["silver", "--root", root, "--silver", silver, "--date", "2024-01-15"]
    assert jobs.main(to_silver) == 0 and read_silver(spark, silver).count() == 2
    assert jobs.main(["gold", "--silver", silver, "--gold", gold]) == 0
    assert read_gold(spark, gold).where("grouping_level = 7").first().n_txns == 2
    append_bronze(to_bronze(transactions(1)), root, rebalance=False)
    assert jobs.main(arguments) == 1
    assert jobs.main(to_silver) == 1
    assert jobs.main(["gate", "--root", root, "--reports", reports, "--all-days"]) == 1


def test_stream_job_stops_after_its_batch_and_reports_failure(spark, transactions, tmp_path):
    inbox = str(tmp_path / "in")
    publish_to_files(transactions(3), inbox)
    stream = parse_transactions(stream_from_files(spark, inbox))
    query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "a")).start()
    stop = threading.Event()
    threading.Timer(3, stop.set).start()
    assert jobs.follow(query, stop) == 0 and not query.isActive
    broken = stream.select(F.raise_error(F.lit("broken")).alias("x"))
    query = broken.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "b")).start()
    assert jobs.follow(query, threading.Event()) == 1
