"""Message envelopes (``key``, ``value``) from a topic or from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paystrata.schema import ENVELOPE_SCHEMA

# Topic and where a new subscription starts.
DEFAULT_TOPIC = "payments.transactions"
STARTING_OFFSETS = "earliest"


def kafka_source_options(
    bootstrap_servers: str,
    topic: str = DEFAULT_TOPIC,
    *,
    starting_offsets: str = STARTING_OFFSETS,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the subscription.

    The two optional ones matter at scale: the first bounds a micro-batch when
    a backlog is replayed, the second splits a hot topic partition over tasks.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def stream_from_kafka(spark: SparkSession, bootstrap_servers: str, **options) -> DataFrame:
    """Unbounded envelopes of one topic; needs the Kafka connector on the classpath."""
    return (
        spark.readStream.format("kafka")
        .options(**kafka_source_options(bootstrap_servers, **options))
        .load()
    )


def stream_from_files(
    spark: SparkSession, path: str, *, max_bytes_per_trigger: str | None = None
) -> DataFrame:
    """Unbounded envelopes from a folder of Parquet files (backfill, tests).

    ``max_bytes_per_trigger`` (such as ``"64g"``) bounds a micro-batch when a
    large folder is drained.
    """
    reader = spark.readStream.schema(ENVELOPE_SCHEMA)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Batch twin of :func:`stream_from_files`."""
    return spark.read.schema(ENVELOPE_SCHEMA).parquet(path)
