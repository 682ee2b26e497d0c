"""Hard negatives by Kronecker-packed inner products.

Components become whole numbers. To score a block of candidates, the j-th components
of several candidates, made non-negative by a bias, are packed into separated fields
of one wide integer; multiplying it by an anchor's j-th component and adding up over j
gives the products of all packed candidates at once, as no field can reach the next.
Fields are as wide as the largest possible sum. As long as at least one field fits into
the 53 bits that a double holds exactly, the wide integers are doubles and the sums a
matrix product; beyond that they are Python integers. Either way scores are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paystrata.llm.common import is_finite_vector, shuffle_width, written

#: Candidates per block at most, and components: a task holds one block at a time.
BLOCK_ROWS, BLOCK_CELLS = 1 << 17, 1 << 23
#: A small table is cut into blocks of at least this many rows, one per task.
LEAST_ROWS = 2048
#: Scores that a task holds at once.
SCORES = 1 << 22
#: Bits of a double's whole numbers, and fields of a wider integer.
DOUBLE_BITS, WIDE_FIELDS = 53, 32

_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def whole_components(column: pa.Array, width: int, scale: float) -> np.ndarray:
    """Lists as rows of whole numbers (held in doubles); shorter ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    with np.errstate(over="ignore"):
        values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    top = np.finfo(np.float64).max
    out[np.arange(width) < sizes[:, None]] = np.clip(values, -top, top)
    return out


def _magnitudes(rows: np.ndarray) -> np.ndarray:
    """Size class of each row: rows of one class differ little in bits, so that one
    with huge components does not widen the fields of all."""
    return np.frexp(np.abs(rows).max(1, initial=0))[1] // 12


class Packed:
    """Candidates of one size class, packed for any field width asked for."""

    def __init__(self, rows: np.ndarray) -> None:
        self.n, self.width = rows.shape
        self.bias = int(np.abs(rows).max(initial=0))
        self.rows = rows
        self.wide: dict[int, np.ndarray] = {}

    def _planes(self, bits: int, fields: int) -> np.ndarray:
        """Wide integers: field k of row g is candidate k * rows + g."""
        if bits not in self.wide:
            per = -(-self.n // fields)
            exact = fields * bits <= DOUBLE_BITS
            biased = self.rows + self.bias if exact else _integers(self.rows) + self.bias
            out = np.zeros((per, self.width), np.float64 if exact else object)
            for k in range(fields):
                plane = biased[k * per : (k + 1) * per]
                out[: len(plane)] += plane * (2 ** (k * bits) if exact else 1 << (k * bits))
            self.wide[bits] = out
        return self.wide[bits]

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products of anchors (of one size class) and all candidates; a product
        beyond a long is the nearest long."""
        shift = int(np.abs(anchors).max(initial=0))
        if not shift or not self.bias:
            return np.zeros((len(anchors), self.n), np.int64)
        bits = (self.width * 2 * shift * 2 * self.bias).bit_length()
        exact = bits <= DOUBLE_BITS
        fields = DOUBLE_BITS // bits if exact else min(WIDE_FIELDS, self.n)
        planes = self._planes(bits, fields)
        if exact:
            wide = ((anchors + shift) @ planes.T).astype(np.int64)
            a_sums, c_sums = anchors.sum(1).astype(np.int64), self.rows.sum(1).astype(np.int64)
            out = np.empty((len(anchors), self.n), np.int64)
        else:
            whole = _integers(anchors)
            wide = (whole + shift) @ planes.T
            a_sums, c_sums = whole.sum(1), _integers(self.rows).sum(1)
            out = np.empty((len(anchors), self.n), object)
        per, mask = len(planes), (1 << bits) - 1
        for k in range(fields):
            part = out[:, k * per : (k + 1) * per]
            part[:] = (wide[:, : part.shape[1]] >> (k * bits)) & mask
        out -= self.bias * a_sums[:, None] + shift * c_sums + self.width * shift * self.bias
        return out if exact else np.clip(out, _LEAST, _MOST).astype(np.int64)


def _integers(rows: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in rows], object).reshape(rows.shape)


class Scorer:
    """Candidates in their given order, packed by size class."""

    def __init__(self, rows: np.ndarray) -> None:
        classes = _magnitudes(rows)
        self.n = len(rows)
        self.parts = [(at, Packed(rows[at])) for at in (np.flatnonzero(classes == c) for c in np.unique(classes))]

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        out = np.empty((len(anchors), self.n), np.int64)
        classes = _magnitudes(anchors)
        for c in np.unique(classes):
            who = np.flatnonzero(classes == c)
            for at, packed in self.parts:
                out[np.ix_(who, at)] = packed.scores(anchors[who])
        return out


def best_places(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` of ``places`` (ascending) with the highest scores; ties to the first."""
    if len(places) > 4 * k:
        least = np.partition(scores[places], len(places) - k)[len(places) - k]
        places = places[scores[places] >= least]
    falling = ~(scores[places].view(np.uint64) ^ np.uint64(1 << 63))
    return places[np.argsort(falling, kind="stable")[:k]]


class Block:
    """Candidates of one block, by id and row."""

    def __init__(self, batches: list[pa.RecordBatch], width: int, scale: float) -> None:
        ids, rows, labels = (
            np.concatenate([b.column(name).to_numpy() for b in batches]) for name in ("id", "row", "label")
        )
        vectors = np.concatenate([whole_components(b.column("vector"), width, scale) for b in batches])
        order = np.lexsort((rows, ids))
        self.ids, self.rows, self.labels, self.vectors = ids[order], rows[order], labels[order], vectors[order]
        self.by_label: dict[int, tuple[np.ndarray, Scorer]] = {}
        self.all: Scorer | None = None

    def of_label(self, label: int) -> tuple[np.ndarray, Scorer]:
        if label not in self.by_label:
            places = np.flatnonzero(self.labels == label)
            self.by_label[label] = places, Scorer(self.vectors[places])
        return self.by_label[label]


class Anchors:
    """A batch of anchors."""

    def __init__(self, batch: pa.RecordBatch, width: int, scale: float) -> None:
        self.ids, self.rows, self.labels = (batch.column(name).to_numpy() for name in ("id", "row", "label"))
        self.vectors = whole_components(batch.column("vector"), width, scale)
        self.goals = batch.column("goals").to_pylist()


def _positives(block: Block, anchors: Anchors, k: int) -> Iterator[tuple]:
    """Each anchor's ``k`` best rows of its label in the block."""
    for label in np.unique(anchors.labels):
        places, scorer = block.of_label(label)
        if not len(places):
            continue
        who = np.flatnonzero(anchors.labels == label)
        step = max(1, SCORES // len(places))
        for a in range(0, len(who), step):
            part = who[a : a + step]
            for i, scores in zip(part, scorer.scores(anchors.vectors[part])):
                others = np.flatnonzero(block.rows[places] != anchors.rows[i])
                for at in best_places(scores, others, k):
                    found = places[at]
                    yield int(anchors.rows[i]), int(anchors.ids[i]), int(block.ids[found]), int(block.rows[found]), int(scores[at])


def _negatives(block: Block, anchors: Anchors, k: int, low: int, high: int) -> Iterator[tuple]:
    """For each positive the ``k`` best rows of other labels in its window of scores."""
    if block.all is None:
        block.all = Scorer(block.vectors)
    step = max(1, SCORES // max(1, len(block.ids)))
    for a in range(0, len(anchors.ids), step):
        for i, scores in enumerate(block.all.scores(anchors.vectors[a : a + step]), a):
            other = block.labels != anchors.labels[i]
            # low * positive <= 100 * score <= high * positive, in whole numbers
            windows = [
                (g, -(-low * g["score"] // 100), high * g["score"] // 100) for g in anchors.goals[i]
            ]
            windows = [(g, max(lo, _LEAST), min(hi, _MOST)) for g, lo, hi in windows if lo <= hi]
            if not windows:
                continue
            places = np.flatnonzero(other & (scores >= min(lo for _, lo, _ in windows)))
            for g, lo, hi in windows:
                inside = places[(scores[places] >= lo) & (scores[places] <= hi)]
                for at in best_places(scores, inside, k):
                    yield (
                        int(anchors.rows[i]), int(anchors.ids[i]), g["place"], g["positive_id"], g["score"],
                        int(block.ids[at]), int(scores[at]),
                    )


def _scan(
    look: Callable[[Block, Anchors], Iterator[tuple]], names: tuple[str, ...], width: int, scale: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted rows: per block first the candidates, which stay, then the anchors, which stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = batch.column("block").to_numpy()
            kinds = batch.column("is_anchor").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                part = batch.slice(a, b - a)
                if numbers[a] != key:
                    key, waiting, block = numbers[a], [], None
                if not kinds[a]:
                    waiting.append(part)
                    continue
                if block is None:
                    if not waiting:
                        continue
                    block, waiting = Block(waiting, width, scale), []
                found = list(look(block, Anchors(part, width, scale)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=list(names))

    return run


def hard_negatives(
    vectors: DataFrame,
    *,
    positives: int = 5,
    negatives: int = 3,
    every: int = 50,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: float = 256.0,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    A component x counts as floor(``scale`` * x), a row's score is its inner product
    with the anchor; higher scores come first, ties go to the smaller id. Anchors are
    the rows whose id is divisible by ``every``; an anchor's positives are its first
    ``positives`` other rows of its label. Per positive, of the rows of other labels
    whose score lies between ``low_percent`` and ``high_percent`` of the positive's,
    the first ``negatives`` are returned. Fewer rows give fewer answers, an empty table
    none; a negative positive score leaves no window.

    Rows with a null id, label or vector, or with null or non-finite components take no
    part. Labels are whole numbers. A row that repeats an id is another row; shorter
    vectors count as ending in zeros; other columns are ignored. A score beyond a long
    counts as the nearest long.

    Every block of candidates moves once and meets all anchors, which are copied once
    per block: with R rows to a block, n rows and m anchors, n + m * n / R rows move in
    each of the two passes. Blocks are dealt by a hash of the row, so neither a frequent
    label nor a frequent id makes one larger.
    """
    spark = vectors.sparkSession
    usable = vectors.where(
        is_finite_vector(F.col(embedding)) & F.col(vec_id).isNotNull() & F.col(label).isNotNull()
    )
    rows = usable.select(
        F.col(vec_id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.col(embedding).alias("vector"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = written(rows, "whole-vectors")
    width, n = rows.agg(F.coalesce(F.max(F.size("vector")), F.lit(0)), F.count(F.lit(1))).first()
    goals = "array<struct<place:long,positive_id:long,score:long>>"
    block_rows = max(1, min(block_rows, BLOCK_CELLS // max(1, width)))
    n_blocks = max(1, -(-n // block_rows), min(shuffle_width(spark), -(-n // LEAST_ROWS)))
    block = F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int")
    candidates = rows.select(
        block.alias("block"), F.lit(False).alias("is_anchor"), "id", "row", "label", "vector", F.lit(None).cast(goals).alias("goals")
    )

    def against_all(anchors: DataFrame) -> DataFrame:
        copies = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).select(
            "block", F.lit(True).alias("is_anchor"), "id", "row", "label", "vector", "goals"
        )
        return candidates.unionByName(copies).repartition(shuffle_width(spark), "block").sortWithinPartitions("block", "is_anchor")

    anchors = rows.where(F.col("id") % every == 0)
    seen = ("row", "id", "positive_id", "positive_row", "score")
    same = against_all(anchors.withColumn("goals", F.lit(None).cast(goals))).mapInArrow(
        _scan(lambda b, a: _positives(b, a, positives), seen, width, scale),
        "row long, id long, positive_id long, positive_row long, score long",
    )
    first = Window.partitionBy("row").orderBy(F.desc("score"), "positive_id", "positive_row")
    chosen = same.withColumn("place", F.row_number().over(first).cast("long")).where(F.col("place") <= positives)
    chosen = chosen.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "score"))).alias("goals"))
    asked = written(anchors.join(chosen, "row").withColumn("goals", F.col("goals").cast(goals)), "anchor-goals")

    names = ("row", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score")
    other = against_all(asked).mapInArrow(
        _scan(lambda b, a: _negatives(b, a, negatives, low_percent, high_percent), names, width, scale),
        "row long, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    best = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (
        other.withColumn("rank", F.row_number().over(best).cast("int"))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
