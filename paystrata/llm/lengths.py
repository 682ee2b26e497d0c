"""Token counts from an exact length histogram.

Documents are aggregated by encoded length. Suffix sums over the histogram then
answer, for every context limit, how many documents and tokens there are, which
length a quantile has and how many tokens are left after cutting at the limit.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_BUCKET = 1024  # lengths per bucket in the two-level sums


def encoded_lengths(docs: DataFrame, ranks_path: str, pattern: str, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and ``n_tokens``, the length of the whole text's encoding.

    Byte-level BPE with the ranks of a tiktoken file; strings of special tokens
    are ordinary text. A null or empty text has no tokens.
    """
    with open(ranks_path, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        pairs = (line.split() for line in ranks.value.splitlines() if line)
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        for texts in batches:
            yield pd.Series([len(encoding.encode_ordinary(t or "")) for t in texts], dtype="int64")

    return docs.select(*keep, n_tokens(F.col(text)).alias("n_tokens"))


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``n_tokens``, ``n_docs``: one row per length that occurs; null lengths do not count."""
    return (
        lengths.where(F.col("n_tokens").isNotNull())
        .groupBy("n_tokens")
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with sums over all documents at least as long.

    Columns: ``n_tokens`` (the context limit), ``n_docs`` of exactly that length,
    ``docs_at_least``, ``tokens_at_least`` (their tokens), ``truncated_total``
    (tokens of all documents, each cut at the limit), ``quantile`` (share of
    documents not longer). Sums run inside buckets of lengths and over the
    buckets' totals, so no task has more than the buckets or one bucket. An empty
    histogram gives an empty table.
    """
    bucket = F.floor(F.col("n_tokens") / _BUCKET)
    rows = histogram.select("n_tokens", "n_docs", bucket.alias("bucket"))
    after = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("bucket").agg(
        F.sum("n_docs").alias("docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("tokens")
    )
    longer = totals.select(
        "bucket",
        F.coalesce(F.sum("docs").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("tokens").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("docs").over(Window.partitionBy()).alias("all_docs"),
        F.sum("tokens").over(Window.partitionBy()).alias("all_tokens"),
    )
    inside = Window.partitionBy("bucket").orderBy(F.desc("n_tokens"))
    docs = F.sum("n_docs").over(inside) + F.col("docs_after")
    tokens = F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside) + F.col("tokens_after")
    return rows.join(longer, "bucket").select(
        "n_tokens",
        "n_docs",
        docs.alias("docs_at_least"),
        tokens.alias("tokens_at_least"),
        (F.col("all_tokens") - tokens + docs * F.col("n_tokens")).alias("truncated_total"),
        ((F.col("all_docs") - docs + F.col("n_docs")) / F.col("all_docs")).alias("quantile"),
    )


def truncated_total(sums: DataFrame, limit: int) -> Column:
    """Scalar subquery: tokens left when every document is cut at ``limit``.

    The next longer length that occurs has the documents to cut; without one
    nothing is cut.
    """
    below = sums.where(F.col("n_tokens") < limit)
    above = sums.where(F.col("n_tokens") >= limit)
    kept = below.agg(F.coalesce(F.sum(F.col("n_tokens") * F.col("n_docs")), F.lit(0))).scalar()
    cut = above.agg(F.coalesce(F.max("docs_at_least"), F.lit(0))).scalar()
    return kept + cut * F.lit(limit)


def quantile_length(sums: DataFrame, share: float) -> Column:
    """Scalar subquery: the shortest length that at least ``share`` of the documents stay within."""
    return sums.where(F.col("quantile") >= share).agg(F.min("n_tokens")).scalar()
