"""Silver fed by a stream: the latest version per transaction, upserted per trigger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paystrata.operators.parse import addressable
from paystrata.operators.silver import upsert_silver, version_order
from paystrata.schema import INGEST_COLUMN, TRANSACTION_COLUMNS
from paystrata.session import materialized, scratch_path
from paystrata.sources import files
from paystrata.streaming.triggers import TRIGGER_INTERVAL, with_trigger


def latest_in_stream(bronze: DataFrame, delay: str) -> DataFrame:
    """The latest version of each transaction among those ingested in the same ``delay``.

    To be written in update mode: a trigger returns the ids it has received, each with
    the winner so far, in the order of ``silver.latest_per_transaction``. Versions are
    reduced on the map side, so a hot id sends one row per task. The clock is the
    ingest time, and a group ends ``delay`` after it; the state holds the ids of about
    two delays. Silver itself decides between groups, so no version is forgotten.

    The ingest times must not run back by more than ``delay``, else rows come too late
    for their group and are dropped by Spark. Those of ``parse_transactions`` are the
    triggers' own times, which rise.
    """
    winner = F.min_by(F.struct(*TRANSACTION_COLUMNS), version_order())
    return (
        addressable(bronze)
        .withWatermark(INGEST_COLUMN, delay)
        .groupBy(F.window(INGEST_COLUMN, delay), F.col("txn_id").alias("_id"))
        .agg(winner.alias("_row"))
        .select("_row.*")
    )


def start_silver(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    delay: str,
    *,
    interval: str = TRIGGER_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Upsert a stream of bronze rows into the silver table at ``path``.

    A trigger that is repeated after a failure upserts the same rows again, which
    changes nothing; triggers without rows publish no version. One stream per table.
    """
    spark = bronze.sparkSession

    def upsert(batch: DataFrame, batch_id: int) -> None:
        place = scratch_path(spark, "stream-batch")
        try:
            # Written once, as evaluating the batch moves its state; and read by the outer
            # session, because streams turn adaptive execution off in theirs.
            written = materialized(batch, place)
            rows = spark.read.schema(written.schema).parquet(place)
            if not rows.isEmpty():
                upsert_silver(rows, path)
        finally:
            files.delete(spark, place)

    writer = (
        latest_in_stream(bronze, delay)
        .writeStream.foreachBatch(upsert)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    return with_trigger(writer, interval=interval, available_now=available_now).start()
