"""Exact top-k inner products of norm-sorted vectors.

Vectors are sorted by descending length into blocks and rotated by the singular
vectors of the whole table, so that the first coordinates carry most of a product.
For a query, the sum over the first coordinates plus the Cauchy-Schwarz bound on
the rest says whether a vector can still enter its answers; once the product of
the lengths alone falls below its k-th score, the rest of the vectors is skipped.
All surviving scores are computed in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paystrata.llm.common import is_finite_vector, shuffle_width, written

#: Vectors per block at most, and components: a task holds one block at a time.
BLOCK_ROWS, BLOCK_CELLS = 1 << 15, 1 << 23
#: A small table is cut into blocks of at least this many vectors, one per task.
LEAST_ROWS = 1024
#: Longest vectors against which every query gets its first bound.
HEAD_ROWS = 4096


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of whole numbers; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _gram(rows: DataFrame, width: int) -> np.ndarray:
    """Sum of the outer products of all vectors; one matrix per task, added by Spark."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            values = _matrix(batch.column("q"), width).astype(np.float64)
            total += values.T @ values
        flat = total.reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(flat.size)), pa.array(flat)], names=["place", "value"])

    sums = rows.select("q").mapInArrow(add, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(width * width)
    for place, value in sums.collect():  # width x width numbers
        out[place] = value
    return out.reshape(width, width)


_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class _Exact:
    """Inner products in whole numbers: by matrix product while doubles hold them, else
    in longs, and where they could leave these, in Python's integers, cut to a long."""

    @classmethod
    def all(cls, queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Rows are taken by size class, so that a few large ones do not slow the others."""
        classes = [np.frexp(_largest(rows))[1] // 12 for rows in (queries, vectors)]
        out = np.zeros((len(queries), len(vectors)), np.int64)
        for c in np.unique(classes[0]):
            for d in np.unique(classes[1]):
                i, j = np.flatnonzero(classes[0] == c), np.flatnonzero(classes[1] == d)
                whole = len(i) == len(queries) and len(j) == len(vectors)
                if whole:
                    return cls._alike(queries, vectors)
                out[np.ix_(i, j)] = cls._alike(queries[i], vectors[j])
        return out

    @staticmethod
    def _alike(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        reach = _largest(queries).max() * _largest(vectors).max() * queries.shape[1]
        if reach < 2**52:
            return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
        if reach < 2**62:
            return queries @ vectors.T
        return np.clip(queries.astype(object) @ vectors.astype(object).T, _LEAST, _MOST).astype(np.int64)

    @staticmethod
    def pairs(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        wide = np.flatnonzero(_largest(queries) * _largest(vectors) * queries.shape[1] >= 2**62)
        out = np.einsum("ij,ij->i", queries, vectors)  # wraps in the wide rows
        for at in wide:
            out[at] = min(max(sum(int(a) * int(b) for a, b in zip(queries[at], vectors[at])), _LEAST), _MOST)
        return out


def _largest(rows: np.ndarray) -> np.ndarray:
    """Largest component of each row, as a double (longs have no absolute of their least)."""
    return np.abs(rows.astype(np.float64)).max(1, initial=0)


class _Chunk:
    """Queries of one chunk and their best answers in one block."""

    def __init__(self, queries: pa.Table, width: int, rotation: np.ndarray, k: int) -> None:
        self.k, self.width, self.rotation = k, width, rotation
        self.keys, self.rows = queries.column("id").to_numpy(), queries.column("row").to_numpy()
        self.q = _matrix(queries.column("q"), width)
        self.bound = queries.column("bound").to_numpy().astype(np.float64)
        self.rotated = self.q.astype(np.float64) @ rotation
        self.norm = np.linalg.norm(self.rotated, axis=1)
        self.head = width if width < 8 else max(4, width // 4)
        self.rest = np.sqrt(np.maximum(0, self.norm**2 - (self.rotated[:, : self.head] ** 2).sum(1)))
        n = len(self.rows)
        self.best = np.zeros((n, 0), np.int64), np.zeros((n, 0), np.int64), np.zeros((n, 0), bool)
        self.open = True

    def look(self, vectors: pa.RecordBatch) -> None:
        """Vectors in descending length."""
        v = _matrix(vectors.column("q"), self.width)
        ids, rows = vectors.column("id").to_numpy(), vectors.column("row").to_numpy()
        rotated = v.astype(np.float64) @ self.rotation
        norm = np.linalg.norm(rotated, axis=1)
        # What rounding may add to any of the sums below.
        slack = 1e-9 * (1 + self.norm * norm.max(initial=0))
        active = np.flatnonzero(self.norm * norm.max(initial=0) + slack >= self.bound)
        if not active.size:
            self.open = False  # the vectors to come are not longer
            return
        rest = np.sqrt(np.maximum(0, norm**2 - (rotated[:, : self.head] ** 2).sum(1)))
        partial = self.rotated[active, : self.head] @ rotated[:, : self.head].T
        may = partial + self.rest[active, None] * rest >= (self.bound - slack)[active, None]
        may &= self.rows[active, None] != rows  # not the query's own row
        if may.sum() * 4 > may.size:
            scores = _Exact.all(self.q[active], v)
            keep = may & (scores >= self.bound[active, None])
            at, who = np.nonzero(keep)
            found = scores[at, who]
        else:
            at, who = np.nonzero(may)
            found = _Exact.pairs(self.q[active[at]], v[who])
            good = found >= self.bound[active[at]]
            at, who, found = at[good], who[good], found[good]
        if at.size:
            self._merge(active[at], found, ids[who])

    def _merge(self, query: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        """Keep the k best per query: higher score first, then smaller id."""
        old_score, old_vec, old_used = self.best
        n, have = old_score.shape
        q = np.concatenate([np.repeat(np.arange(n), have)[old_used.reshape(-1)], query])
        s = np.concatenate([old_score[old_used], score])
        v = np.concatenate([old_vec[old_used], vec])
        order = np.lexsort((v, ~s, q))  # ~s falls as s rises, without overflow
        q, s, v = q[order], s[order], v[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        top = place < self.k
        q, s, v, place = q[top], s[top], v[top], place[top]
        out = np.zeros((n, self.k), np.int64), np.zeros((n, self.k), np.int64), np.zeros((n, self.k), bool)
        for target, values in zip(out, (s, v, True)):
            target[q, place] = values
        self.best = out
        full = out[2][:, -1]
        self.bound[full] = np.maximum(self.bound[full], out[0][full, -1])

    def answers(self) -> pa.RecordBatch | None:
        score, vec, used = self.best
        who, _ = np.nonzero(used)
        if not who.size:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(self.rows[who]), pa.array(self.keys[who]), pa.array(vec[used]), pa.array(score[used])],
            names=["row", "query_id", "vec_id", "score"],
        )


def _search(width: int, rotation: np.ndarray, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows: per block first the vectors, longest first, which stay; then the
    queries, which stream by, a batch at a time."""
    key, vectors = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        blocks = batch.column("block").to_numpy()
        kinds = batch.column("is_query").to_numpy()
        edges = np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            part = batch.slice(a, b - a)
            if blocks[a] != key:
                key, vectors = blocks[a], []
            if not kinds[a]:
                vectors.append(part)
                continue
            chunk = _Chunk(pa.Table.from_batches([part]), width, rotation, k)
            for rows in vectors:
                chunk.look(rows)
                if not chunk.open:
                    break
            if (answer := chunk.answers()) is not None:
                yield answer


def top_inner_products(
    vectors: DataFrame,
    *,
    k: int = 5,
    every: int = 50,
    scale: float = 256.0,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    head_rows: int = HEAD_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's ``k`` best other rows.

    A component x counts as floor(``scale`` * x). Queries are the rows whose id is
    divisible by ``every``, candidates all rows but the query's own (a row that
    repeats its id is another row). Ties go to the smaller id. Vectors that are null
    or hold null or non-finite components take no part, nor do rows with a null id;
    shorter vectors count as ending in zeros. Fewer candidates give fewer answers,
    an empty table none. A component or score beyond a long counts as the nearest long.

    Every vector moves once, to its block; a query moves to the blocks whose longest
    vector can reach its bound, and streams by the block's vectors there.
    """
    spark = vectors.sparkSession
    whole = F.transform(F.col(embedding), lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))
    usable = vectors.where(is_finite_vector(F.col(embedding)) & F.col(vec_id).isNotNull())
    rows = usable.select(F.col(vec_id).cast("long").alias("id"), whole.alias("q")).withColumn(
        "norm", F.sqrt(F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    )
    ordered = rows.repartitionByRange(F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id")
    ordered = written(ordered.withColumn("row", F.monotonically_increasing_id()), "norm-sorted")
    width, n = ordered.agg(F.coalesce(F.max(F.size("q")), F.lit(0)), F.count(F.lit(1))).first()
    if not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    _, basis = np.linalg.eigh(_gram(ordered, width))
    rotation = np.ascontiguousarray(basis[:, ::-1])

    # A block is a run of rows of one sorted partition; its number counts runs in
    # order of length.
    run = min(block_rows, BLOCK_CELLS // width, max(LEAST_ROWS, -(-n // shuffle_width(spark))))
    run = max(1, run)
    low_bits = F.lit((1 << 33) - 1)
    run_key = F.struct(F.shiftright("row", 33).alias("part"), F.floor(F.col("row").bitwiseAND(low_bits) / run).alias("run"))
    lengths = ordered.groupBy(run_key.alias("run")).agg(F.max("norm").alias("longest")).orderBy("run").collect()
    numbers = spark.createDataFrame(
        [(r.run, b, r.longest) for b, r in enumerate(lengths)],
        "run struct<part: long, run: bigint>, block int, longest double",
    )
    longest = [r.longest for r in lengths]
    blocked = ordered.withColumn("run", run_key).join(F.broadcast(numbers), "run").drop("run")

    # First bounds: the k-th best score among the longest vectors.
    head_table = ordered.orderBy(F.desc("norm"), "row").limit(head_rows).select("row", "q").toArrow()
    head = _matrix(head_table.column("q"), width)
    head_ids = head_table.column("row").to_numpy()
    shared = spark.sparkContext.broadcast((head, head_ids))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, ids = shared.value
        top = np.array(longest)
        for batch in batches:
            q = _matrix(batch.column("q"), width)
            own = batch.column("row").to_numpy()
            norm = batch.column("norm").to_numpy()
            scores = _Exact.all(q, vectors).astype(np.float64)
            scores[own[:, None] == ids] = -np.inf
            low = -np.sort(-scores, 1)[:, k - 1] if scores.shape[1] >= k else np.full(len(q), -np.inf)
            # Blocks whose longest vector can reach the bound: a prefix of them.
            need = np.array([
                np.count_nonzero(length * top + 1e-9 * (1 + length * top) >= least) for length, least in zip(norm, low)
            ])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), batch.column("q"), pa.array(low), pa.array(need.astype(np.int32))],
                names=["id", "row", "q", "bound", "reach"],
            )

    asked = ordered.where(F.col("id") % every == 0).select("id", "row", "q", "norm")
    bounded = asked.mapInArrow(bound, "id long, row long, q array<long>, bound double, reach int")
    bounded = written(bounded.where("reach > 0"), "query-bounds")
    asked = bounded.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("reach") - 1))).select(
        "block", F.lit(1).alias("is_query"), F.lit(0.0).alias("norm"), "id", "row", "q", "bound"
    )
    stored = blocked.select("block", F.lit(0).alias("is_query"), "norm", "id", "row", "q", F.lit(0.0).alias("bound"))
    both = stored.unionByName(asked).repartition(shuffle_width(spark), "block")
    found = both.sortWithinPartitions("block", "is_query", F.desc("norm")).mapInArrow(
        lambda it: _search(width, rotation, k, it), "row long, query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
