"""Global positions under a total order, and rank weights built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paystrata.session import materialized, scratch_path

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low bits


def global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Number the rows 1, 2, 3, … under ``order``, which must have no ties.

    A window without partitions would sort everything in one task. Here a range
    sort spreads the rows, each gets its place inside its partition, and the
    partitions' sizes (one record per partition, so safe to broadcast) give the
    offsets. The sorted rows are written to the shared folder, because sizes and
    places must come from one and the same sort; this runs a job.
    """
    slot = F.monotonically_increasing_id()
    ordered = materialized(
        df.orderBy(*order).withColumn("_slot", slot), scratch_path(df.sparkSession, "ranked")
    )
    part = F.shiftright("_slot", _ROW_BITS)
    place = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + place + 1)
        .select(*df.columns, name)
    )


def merchant_rank_weights(txns: DataFrame) -> DataFrame:
    """Merchants by traffic, with observed share and the share 1/rank predicts."""
    counts = txns.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("n_txns"))
    ranked = global_rank(
        counts, F.col("n_txns").desc(), F.col("merchant_id").asc_nulls_first()
    )
    rows = ranked.agg(F.sum("n_txns")).scalar()
    harmonic = ranked.agg(F.sum(F.lit(1.0) / F.col("rank"))).scalar()
    return ranked.withColumns(
        {
            "observed_share": F.col("n_txns") / rows,
            "rank_weight": (F.lit(1.0) / F.col("rank")) / harmonic,
        }
    )
