"""Trigger choice shared by all streaming queries."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter

# Fixed value: how often the bronze stream writes.
TRIGGER_INTERVAL = "30 seconds"


def with_trigger(
    writer: DataStreamWriter, *, interval: str = TRIGGER_INTERVAL, available_now: bool = False
) -> DataStreamWriter:
    """Run every ``interval``, or drain what is there and stop."""
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)
