"""Mixing sources to target weights by fitting a subset-sum budget.

Documents are counted by exact length. Whole passes over a source cover most of
its target; the rest is a bounded knapsack over the lengths: an even share of each
length, then dynamic programming over sums for what rounding left. Which documents
of a length are taken is decided by a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paystrata.llm.common import WORD, written

#: Documents of one source and length are ranked in buckets of about this many.
BUCKET_ROWS = 4096
#: Words that the dynamic programme first decides on; it gets sixteen times as many
#: whenever it misses the budget, until it decides on all of it.
EXACT_WORDS = 1 << 16
#: Bits of all its sets of sums together (256 MB), the bound on its memory.
MOST_BITS = 1 << 31


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, *, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """``source``, ``source_size`` with ``target`` (words to take).

    Sources in code point order, null last, get ``weights`` in turn. Targets are
    proportional to them and sum up to ``share`` of all sizes; none exceeds
    ``cap`` times its source's size, and what exceeds it goes to the others by
    weight. ``totals`` has one record per source. The sources whose size per
    weight is smallest are capped first, so the common level of the others
    follows from prefix sums in that order.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    rows = totals.select("source", "source_size", weight.cast("double").alias("weight"))
    limit = F.col("source_size") * F.lit(float(cap))
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    before, rest = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    budget = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    # The level if all sources before this one are capped; it holds from the first
    # source that it does not cap.
    open_level = (budget - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    ranked = rows.withColumn("limit", limit).withColumn("level", F.col("limit") / F.col("weight")).withColumn("open", open_level)
    level = F.min(F.when(F.col("open") <= F.col("level"), F.struct("level", "open"))).over(Window.partitionBy())["open"]
    target = F.least(F.col("limit"), F.coalesce(F.col("weight") * level, F.col("limit")))
    return ranked.select("source", "source_size", target.alias("target"))


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """How many documents of each length to take so that the words come to ``budget``.

    The result never exceeds the budget. It is the closest that any choice comes to it
    as long as ``MOST_BITS`` hold the sets of sums (one bit per word of the budget for
    each power of two of each length's count); beyond that, the closest one found.
    """
    total = int((sizes * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(sizes), np.int64)
    if budget >= total:
        return counts.copy()
    words, best, least = EXACT_WORDS, None, None
    while True:
        taken, left = _even_share(sizes, counts, budget, words)
        missed = _completed(sizes, counts, taken, left, seed)
        if least is None or missed < least:
            best, least = taken, missed
        if not missed or words >= min(budget, MOST_BITS):
            return best
        words *= 16


def _even_share(sizes: np.ndarray, counts: np.ndarray, budget: int, words: int) -> tuple[np.ndarray, int]:
    """An even share of each length, and the words left to decide on: about ``words``,
    or twice the longest document where that is less and ``words`` the first try."""
    if words >= budget:
        return np.zeros(len(sizes), np.int64), budget
    total = int((sizes * counts).sum())
    taken = np.array([int(c) * budget // total for c in counts], np.int64)
    left = budget - int((taken * sizes).sum())
    order = np.argsort(-sizes, kind="stable")
    for i in order:  # at most one more of each length, until the programme can take over
        if left <= words:
            break
        if 0 < sizes[i] <= left and taken[i] < counts[i]:
            taken[i] += 1
            left -= int(sizes[i])
    # Give back short documents, so that the programme has a choice.
    choice = min(2 * int(sizes.max()), words) if words == EXACT_WORDS else words
    for i in order[::-1]:
        if left >= choice:
            break
        if sizes[i] > 0:
            back = min(int(taken[i]), -(-(choice - left) // int(sizes[i])))
            taken[i] -= back
            left += back * int(sizes[i])
    return taken, left


def _completed(sizes: np.ndarray, counts: np.ndarray, taken: np.ndarray, left: int, seed: int) -> int:
    """Add documents to ``taken`` that come as close to ``left`` words as can be; what is missed."""
    # Bit s of ``sums`` says that the items so far can add up to s.
    sums, mask, steps = 1, (1 << (left + 1)) - 1, []
    for i in np.random.default_rng(seed).permutation(len(sizes)):
        size, spare, block = int(sizes[i]), int(counts[i] - taken[i]), 1
        if not 0 < size <= left:
            continue
        spare = min(spare, left // size)
        while spare > 0 and not sums >> left & 1:  # 1, 2, 4, … copies as one item
            if (len(steps) + 1) * left > MOST_BITS and steps:
                break
            copies = min(block, spare)
            steps.append((i, copies, sums))
            sums = (sums | sums << size * copies) & mask
            spare -= copies
            block *= 2
        if sums >> left & 1:
            break
    reached = sums.bit_length() - 1
    missed = left - reached
    for i, copies, earlier in reversed(steps):
        if not earlier >> reached & 1:
            taken[i] += copies
            reached -= int(sizes[i]) * copies
    return missed


def mix_sources(
    docs: DataFrame,
    *,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    cap: int = 2,
    seed: int = 7,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id``, ``source``, ``keep``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    ``copies`` (0 to ``cap``) says how often the mix has the document, ``taken``
    how many words that makes. A null source is a source of its own, a null or
    empty text has size 0 and is never taken. Repeated rows count and are chosen
    one by one; rows alike in id, source and size are interchangeable. An empty
    table gives an empty table, as do sources without words targets of 0. Reruns
    agree: the choice depends on the seed, ids and sizes only.
    """
    size = word_count(F.col("text"))
    sized = written(
        docs.select("doc_id", *keep, "source", size.alias("size")).withColumn(
            "place", F.xxhash64(F.lit(seed), "doc_id", "source", "size")
        ),
        "mix-sizes",
    )
    histogram = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    totals = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(totals, weights=weights, share=share, cap=cap)

    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        sizes, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
        total, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
        passes = min(cap, int(target // total)) if total else 0
        # Rounding may leave a hair over the last pass.
        budget = int(round(target - passes * total)) if passes < cap else 0
        return rows[["source", "size", "n", "source_size", "target"]].assign(
            passes=np.where(sizes > 0, passes, 0), more=fit_budget(sizes, counts, budget, seed)
        )

    per_length = (
        histogram.alias("h")
        .join(targets.alias("t"), F.col("h.source").eqNullSafe(F.col("t.source")))
        .select("h.source", "h.size", "h.n", "t.source_size", "t.target")
    )
    # One group per source, with one row per distinct length: the longest text
    # bounds it, however many documents there are.
    quotas = written(
        per_length.groupBy("source").applyInPandas(
            fitted, "source string, size long, n long, source_size long, target double, passes long, more long"
        ),
        "mix-quotas",
    )
    buckets = F.ceil(F.col("n") / BUCKET_ROWS).cast("long")
    placed = (
        sized.alias("d")
        .join(
            quotas.alias("q"),
            F.col("d.source").eqNullSafe(F.col("q.source")) & (F.col("d.size") == F.col("q.size")),
        )
        .select("d.*", "q.source_size", "q.target", "q.passes", "q.more", F.pmod("d.place", buckets).alias("bucket"))
    )
    group = ("source", "size", "bucket")
    earlier = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        placed.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(*group, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    )
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("place", "doc_id"))
    chosen = (
        placed.withColumn("rank", rank)
        .alias("p")
        .join(
            before.alias("b"),
            F.col("p.source").eqNullSafe(F.col("b.source"))
            & (F.col("p.size") == F.col("b.size"))
            & (F.col("p.bucket") == F.col("b.bucket")),
        )
        .withColumn("copies", F.col("passes") + F.when(F.col("before") + F.col("rank") <= F.col("more"), 1).otherwise(0))
    )
    return chosen.select(
        "p.doc_id", "p.source", *(f"p.{name}" for name in keep), "p.size", "p.source_size", "p.target", "copies",
        (F.col("copies") * F.col("p.size")).alias("taken"),
    )
