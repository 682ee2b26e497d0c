"""Keyed JSON messages to a topic or to files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from paystrata.operators.parse import encode_envelopes
from paystrata.sources.envelopes import DEFAULT_TOPIC

# Producer settings.
PRODUCER_OPTIONS = {
    "kafka.acks": "1",
    "kafka.retries": "3",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "10",
}


def kafka_sink_options(
    bootstrap_servers: str, topic: str = DEFAULT_TOPIC, **overrides: str
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "topic": topic,
        **PRODUCER_OPTIONS,
        **overrides,
    }


def publish_to_kafka(txns: DataFrame, bootstrap_servers: str, topic: str = DEFAULT_TOPIC) -> None:
    """Publish a batch; messages of one transaction share a topic partition."""
    (
        encode_envelopes(txns)
        .write.format("kafka")
        .options(**kafka_sink_options(bootstrap_servers, topic))
        .save()
    )


def start_publishing_to_kafka(
    txns: DataFrame, bootstrap_servers: str, checkpoint: str, topic: str = DEFAULT_TOPIC
) -> StreamingQuery:
    return (
        encode_envelopes(txns)
        .writeStream.format("kafka")
        .options(**kafka_sink_options(bootstrap_servers, topic))
        .option("checkpointLocation", checkpoint)
        .start()
    )


def publish_to_files(txns: DataFrame, path: str) -> None:
    """File double of the topic."""
    encode_envelopes(txns).write.mode("append").parquet(path)
