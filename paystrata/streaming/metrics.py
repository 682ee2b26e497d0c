"""Running failure and late-arrival metrics over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paystrata.operators.rates import totals, with_rates
from paystrata.sources import files
from paystrata.streaming.triggers import TRIGGER_INTERVAL, with_trigger

MEASURES = ("published", "failed", "late", "failure_rate", "late_rate")
TOTALS_SCHEMA = (
    "query_id STRING, batch_id BIGINT, recorded_at TIMESTAMP, "
    "published BIGINT, failed BIGINT, late BIGINT, failure_rate DOUBLE, late_rate DOUBLE"
)


def start_totals(
    txns: DataFrame,
    path: str,
    checkpoint: str,
    *,
    interval: str = TRIGGER_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Record totals and rates since the start at ``path``, replaced at every trigger.

    The state is a single row, and so is what is recorded: one small file per query.
    The query's id, kept in its checkpoint, names the file, so a restarted query goes
    on with its own, and a query with a new checkpoint leaves the older one's alone.
    """

    def record(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        row = (
            with_rates(batch)
            .select(
                F.lit(query_id).alias("query_id"),
                F.lit(batch_id).cast("bigint").alias("batch_id"),
                F.current_timestamp().alias("recorded_at"),
                "*",
            )
            .select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))
            .first()  # a single row of totals
        )
        files.write_text(spark, f"{path.rstrip('/')}/{query_id}.json", row.record)

    writer = (
        totals(txns)
        .writeStream.outputMode("complete")
        .foreachBatch(record)
        .option("checkpointLocation", checkpoint)
    )
    return with_trigger(writer, interval=interval, available_now=available_now).start()


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """One row per query that has recorded totals at ``path``."""
    return spark.read.schema(TOTALS_SCHEMA).json(f"{path.rstrip('/')}/*.json")


def latest_totals(recorded: DataFrame) -> DataFrame:
    """Of :func:`read_totals`, the totals recorded last."""
    return recorded.agg(F.max_by(F.struct(*MEASURES), "recorded_at").alias("newest")).select("newest.*")
