"""Which gateway and which processor may carry which payment method."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata import dimensions as dims


def gateway_methods(spark: SparkSession) -> DataFrame:
    """Allowed (gateway_id, payment_method) pairs."""
    return dims.GATEWAY.table(spark).select(
        "gateway_id", F.explode("supported_methods").alias("payment_method")
    )


def processor_methods(spark: SparkSession) -> DataFrame:
    """Allowed (processor_id, payment_method) pairs.

    They follow each method's mapping, not the processors' own method lists:
    wallets settle through a processor whose list does not name them.
    """
    mapped = dims.PAYMENT_METHOD.table(spark).select(
        F.col("processor").alias("processor_id"), F.col("method").alias("payment_method")
    )
    method, processor = dims.CARD_ALTERNATIVE
    card = (
        dims.PAYMENT_METHOD.table(spark)
        .where(F.col("method") == method)
        .select(F.lit(processor).alias("processor_id"), F.col("method").alias("payment_method"))
    )
    return mapped.unionByName(card)


def on_eligible_gateway(txns: DataFrame) -> DataFrame:
    pairs = gateway_methods(txns.sparkSession)
    return txns.join(pairs, ["gateway_id", "payment_method"], "left_semi").select(*txns.columns)


def on_ineligible_gateway(txns: DataFrame) -> DataFrame:
    """Rows whose gateway is unknown, missing or does not support the method."""
    pairs = gateway_methods(txns.sparkSession)
    return txns.join(pairs, ["gateway_id", "payment_method"], "left_anti").select(*txns.columns)


def eligible_gateways(spark: SparkSession) -> DataFrame:
    """Sorted list of gateways per payment method."""
    return gateway_methods(spark).groupBy("payment_method").agg(
        F.array_sort(F.collect_set("gateway_id")).alias("eligible_gateways")
    )


def gateway_choice(txns: DataFrame) -> DataFrame:
    """Traffic per payment method next to the gateways that could carry it."""
    used = txns.groupBy("payment_method").agg(F.count(F.lit(1)).alias("n_txns"))
    return used.join(eligible_gateways(txns.sparkSession), "payment_method", "left")


def processor_mismatches(txns: DataFrame) -> DataFrame:
    """Rows whose processor is not one the method may settle through."""
    pairs = processor_methods(txns.sparkSession)
    return txns.join(pairs, ["processor_id", "payment_method"], "left_anti").select(*txns.columns)
