"""Streaming deduplication by transaction id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from paystrata.operators.parse import addressable
from paystrata.schema import INGEST_COLUMN
from paystrata.streaming.triggers import TRIGGER_INTERVAL, with_trigger

def deduplicate_stream(bronze: DataFrame, delay: str) -> DataFrame:
    """First copy of each transaction within ``delay`` of its ingestion.

    The clock is the ingest time (``pipeline_timestamp``), which this side sets: no
    time inside a message can move it, so none makes other rows late. State holds
    the ids of the last ``delay`` only. Rows without an id or with an arrival time
    ahead of their ingestion are left out; they are in the quarantine, as ``no_id``
    and ``implausible_time``.
    """
    return (
        addressable(bronze)
        .withWatermark(INGEST_COLUMN, delay)
        .dropDuplicatesWithinWatermark(["txn_id"])
    )


def start_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    partition_by: Sequence[str] = (),
    interval: str = TRIGGER_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to a Parquet table, exactly once."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return with_trigger(writer, interval=interval, available_now=available_now).start()
