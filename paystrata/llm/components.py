"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import discard, written


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root``: every node that has a link, with its component's smallest node.

    Large-star and small-star steps in turn: each round points the larger
    neighbours of every node, then the node and its smaller neighbours, to the
    smallest of them. The table never grows beyond the links, minima are reduced
    on the map side, and the number of rounds grows with the logarithm of the
    nodes. Each round's links are written to the shared folder, those of the round before
    removed. Links with a null
    end and links of a node to itself are ignored.
    """
    real = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = written(real.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(lowest, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u")
        before, edges = edges, written(
            small.select("u", F.col("low").alias("v"))
            .union(small.where(F.col("v") != F.col("low")).select("v", "low"))
            .distinct(),
            "links",
        )
        discard(before)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
