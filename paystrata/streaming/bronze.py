"""The bronze stream: envelopes in, hourly-partitioned Parquet out.

Two sinks, both safe against replays:

* :func:`start_bronze_files` uses Spark's file sink. Its commit log makes each
  micro-batch appear once; read the table through its root. Its quarantine is a
  query of its own, :func:`start_quarantine_files`.
* :func:`start_bronze_batches` runs a callback per micro-batch, which can also
  write a quarantine and report counts. Each batch overwrites only its own
  ``ingest_batch`` folders, so delivering it twice leaves one copy.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paystrata.functions.layout import cluster_for_write
from paystrata.operators.parse import (
    bronze_rows,
    parse_transactions,
    parse_with_diagnosis,
    quarantined,
)
from paystrata.schema import BATCH_COLUMN, PARTITION_COLUMNS
from paystrata.sources.bronze import require_writer
from paystrata.streaming.triggers import TRIGGER_INTERVAL, with_trigger

logger = logging.getLogger(__name__)

OBSERVATION = "bronze"


def _counts():
    return F.count(F.lit(1)).alias("rows"), F.count_if(F.col("arrival_year").isNull()).alias(
        "unroutable"
    )


def start_bronze_files(
    envelopes: DataFrame,
    root: str,
    checkpoint: str,
    *,
    interval: str = TRIGGER_INTERVAL,
    available_now: bool = False,
    files_per_partition: int | None = None,
) -> StreamingQuery:
    """Append every message to the table, exactly once.

    Without ``files_per_partition`` the plan has no shuffle. Set it when many
    input partitions would each leave a small file in the current hour. Row
    counts of each batch appear in the query's progress (no extra job).
    """
    require_writer(envelopes.sparkSession, root, commit_log=True)
    rows = parse_transactions(envelopes).observe(OBSERVATION, *_counts())
    if files_per_partition is not None:
        rows = cluster_for_write(rows, PARTITION_COLUMNS, files_per_partition)
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*PARTITION_COLUMNS)
        .option("path", root)
        .option("checkpointLocation", checkpoint)
    )
    return with_trigger(writer, interval=interval, available_now=available_now).start()


def start_quarantine_files(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    *,
    interval: str = TRIGGER_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Append unsound messages, exactly once: the companion of the file sink."""
    writer = (
        quarantined(parse_with_diagnosis(envelopes))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return with_trigger(writer, interval=interval, available_now=available_now).start()


def write_bronze_batch(
    batch: DataFrame,
    batch_tag: str,
    root: str,
    *,
    quarantine: str | None = None,
    files_per_partition: int | None = None,
) -> dict[str, int]:
    """Write one micro-batch of envelopes; returns its counts.

    The counts are observed while the rows are written, for logs and metrics;
    a retried task may be counted again. Nothing is persisted: messages are read
    and parsed once, and once more for the quarantine if the first pass has seen
    any that belong there. A tag is ``<stream>-<number>`` with rising numbers.
    """
    require_writer(batch.sparkSession, root, commit_log=False)
    counts = Observation()
    diagnosed = parse_with_diagnosis(batch)
    unsound = F.count_if(F.col("reason").isNotNull()).alias("unsound")
    rows = bronze_rows(diagnosed.observe(counts, *_counts(), unsound))
    if files_per_partition is not None:
        rows = cluster_for_write(rows, PARTITION_COLUMNS, files_per_partition)
    overwrite_batch(rows, batch_tag, root, PARTITION_COLUMNS)
    seen = counts.get
    if quarantine is not None and seen["unsound"]:
        overwrite_batch(quarantined(diagnosed), batch_tag, quarantine, ())
    return seen


def overwrite_batch(df: DataFrame, batch_tag: str, path: str, partitions) -> None:
    """Write the folders of one batch; those of the same tag are replaced."""
    (
        df.withColumn(BATCH_COLUMN, F.lit(batch_tag))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions, BATCH_COLUMN)
        .parquet(path)
    )


def start_bronze_batches(
    envelopes: DataFrame,
    root: str,
    checkpoint: str,
    *,
    quarantine: str | None = None,
    interval: str = TRIGGER_INTERVAL,
    available_now: bool = False,
    files_per_partition: int | None = None,
    on_batch: Callable[[int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Write micro-batches through a callback; see :func:`write_bronze_batch`.

    ``on_batch`` receives the batch number and its counts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # The query's id is kept in its checkpoint: it survives restarts, and a
        # stream started over from scratch never overwrites an older one's rows.
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        counts = write_bronze_batch(
            batch,
            f"{query_id}-{batch_id}",
            root,
            quarantine=quarantine,
            files_per_partition=files_per_partition,
        )
        if counts["rows"] == 0:
            logger.info("batch %d is empty, nothing written", batch_id)
        else:
            logger.info("batch %d: %d rows written to %s", batch_id, counts["rows"], root)
        if on_batch is not None:
            on_batch(batch_id, counts)

    writer = envelopes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return with_trigger(writer, interval=interval, available_now=available_now).start()
