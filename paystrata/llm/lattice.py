"""Near-duplicate vectors by lattice hashing.

Each table projects the unit vectors to eight random directions and rounds the
projection to the closest point of the E8 lattice: the cell. A vector is a member
of its own cell and visits the neighbouring cells its projection lies closest to.
Vectors that meet in a cell are verified by their cosine in double precision.

A pair may meet in several cells. Every task can tell, because a cell follows from
the vector and the table alone, which meeting comes first, and only that one counts
it. So pairs are never listed: a task returns, for each vector of a cell, how many
links it counted and one vector it is connected with.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import is_finite_vector, shuffle_width, written
from paystrata.llm.components import connected_components
from paystrata.llm.grouped import groups, smallest_reachable

#: Rows of a cell compared by one task at once; a larger cell is a grid of such blocks.
CELL_ROWS = 2048


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: the offsets of neighbouring points."""
    pairs = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            pairs.append(v)
    halves = [v for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(pairs + [np.array(v) for v in halves])


def _nearest_d8(z: np.ndarray) -> np.ndarray:
    """Closest integer point with an even sum: round, and if the sum is odd round the
    coordinate with the largest error the other way."""
    near = np.rint(z)
    error = z - near
    worst = np.abs(error).argmax(1)
    row = np.arange(len(z))
    other = near.copy()
    other[row, worst] += np.where(error[row, worst] >= 0, 1, -1)
    return np.where((near.sum(1) % 2 != 0)[:, None], other, near)


def nearest_point(z: np.ndarray) -> np.ndarray:
    """Closest E8 point: E8 is D8 together with D8 shifted by one half."""
    whole, half = _nearest_d8(z), _nearest_d8(z - 0.5) + 0.5
    closer = ((z - whole) ** 2).sum(1) <= ((z - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


@dataclass(frozen=True)
class Lattice:
    """Parameters of the hash; a task derives all tables from them.

    ``scale`` sets how fine the cells are: at 0.75, eight tables and three visited
    neighbours find nine of ten pairs whose cosine is just 0.9, and practically all
    from 0.95 on.
    """

    tables: int = 8
    neighbours: int = 3
    scale: float = 0.75
    seed: int = 17

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """Cell numbers, shape (rows, tables, 1 + neighbours); a vector's own first.

        Sums are formed by ``einsum``, row by row: other than matrix products, their
        last bits do not depend on which rows are computed together.
        """
        offsets = minimal_vectors()
        weights = np.random.default_rng(self.seed).integers(1, 1 << 62, 8).astype(np.uint64) | np.uint64(1)
        out = np.empty((len(unit), self.tables, 1 + self.neighbours), np.int64)
        for t in range(self.tables):
            directions = np.random.default_rng([self.seed, t]).normal(size=(unit.shape[1], 8))
            z = np.einsum("ij,jk->ik", unit, directions) * self.scale
            point = nearest_point(z)
            # Closest other points: offsets that agree most with what rounding left.
            closeness = np.einsum("ij,kj->ik", z - point, offsets)
            order = np.argsort(-closeness, 1, kind="stable")[:, : self.neighbours]
            all_points = np.concatenate([point[:, None], point[:, None] + offsets[order]], 1)
            doubled = np.rint(all_points * 2).astype(np.int64).astype(np.uint64)
            mixed = (doubled * weights).sum(2, dtype=np.uint64)
            mixed ^= mixed >> np.uint64(29) ^ np.uint64(unit.shape[1])  # other lengths, other cells
            out[:, t] = (mixed * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)
        return out


def _unit(blobs: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors in double precision; tiny and huge ones keep their direction."""
    rows = np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), -1).astype(np.float64)
    rows /= np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _first_here(codes: np.ndarray, i: np.ndarray, j: np.ndarray, ids: np.ndarray, table: int, cell: int) -> np.ndarray:
    """Which pairs (i, j) meet here, in this cell of this table, for the first time.

    Meetings are ordered by table; within a table first as members of one cell,
    then with the smaller id visiting the other's cell, then the reverse.
    """
    low, high = np.where(ids[i] < ids[j], i, j), np.where(ids[i] < ids[j], j, i)
    earlier = np.zeros(len(i), bool)
    for t in range(table):
        earlier |= (codes[low, t] == codes[high, t, :1]).any(1) | (codes[high, t] == codes[low, t, :1]).any(1)
    own_low, own_high = codes[low, table, 0], codes[high, table, 0]
    together = own_low == own_high
    low_visits = (codes[low, table, 1:] == own_high[:, None]).any(1)
    here = np.where(together, own_low == cell, np.where(low_visits, own_high == cell, own_low == cell))
    return here & ~earlier


def _counted(lattice: Lattice, least: float, kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each vector of a cell that has links: their number (if first met here) and one connection."""
    out: list[tuple[np.ndarray, ...]] = []
    for rows in groups(batches, "t", "cell", "left", "right"):
        if rows.num_rows < 2:
            continue
        table, cell, left, right = (rows.column(k)[0].as_py() for k in ("t", "cell", "left", "right"))
        ids, own, chunk, copies = (rows.column(k).to_numpy() for k in ("class", "own", "chunk", "copies"))
        unit = _unit(rows.column("vector").to_pylist(), kind)
        # At least one of a pair is a member; blocks off the diagonal compare across.
        cosine = unit @ unit.T
        linked = np.triu(cosine >= least, 1) & (own[:, None] | own[None, :])
        if left != right:
            linked &= chunk[:, None] != chunk[None, :]
        i, j = np.nonzero(linked)
        if not len(i):
            continue
        used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        a, b = at[: len(i)], at[len(i) :]
        first = _first_here(lattice.cells(unit[used]), a, b, ids[used], table, cell)
        weight = copies[used]
        links = np.bincount(a[first], weight[b[first]], len(used)) + np.bincount(b[first], weight[a[first]], len(used))
        out.append((ids[used], links.astype(np.int64), smallest_reachable(ids[used], a, b)))
        if sum(len(x[0]) for x in out) >= 10_000:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def _batch(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(column)) for column in zip(*parts)]
    return pa.RecordBatch.from_arrays(columns, names=["class", "links", "root"])


def near_duplicates(
    vectors: DataFrame,
    *,
    least: float = 0.9,
    lattice: Lattice | None = None,
    cell_rows: int = CELL_ROWS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept``: one row per vector.

    Vectors link from cosine ``least`` on. Vectors that are null, empty, zero or
    have null or non-finite components link with nothing and are their own
    component; so do vectors of different lengths with each other. Equal vectors are
    compared once, as a class with a number of copies; rows that repeat an id are
    vectors of their own. A null id counts as larger than any; it is kept only if
    nothing else is in its component. An empty table gives an empty table.
    """
    lattice = lattice or Lattice()
    doubles = F.transform(F.col(embedding), lambda x: x.cast("double"))
    usable = is_finite_vector(F.col(embedding)) & F.exists(F.col(embedding), lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.when(usable, doubles).alias("vector"))
    # Copies are reduced on the map side; a class gets its number in a written table.
    classes = written(
        rows.where(F.col("vector").isNotNull())
        .groupBy("vector")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("smallest"))
        .withColumn("class", F.monotonically_increasing_id()),
        "vector-classes",
    )

    # Vectors travel in the precision they came in; all arithmetic is in doubles.
    single = dict(vectors.dtypes)[embedding] == "array<float>"
    kind = "<f4" if single else "<f8"
    placed_schema = "t int, cell long, class long, own boolean, copies long, vector binary"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            ids, copies = batch.column("class").to_numpy(), batch.column("copies").to_numpy()
            for size in np.unique(sizes):
                mine = np.flatnonzero(sizes == size)
                values = np.ascontiguousarray(flat[starts[mine][:, None] + np.arange(size)], kind)
                blobs = [v.tobytes() for v in values]
                cells = lattice.cells(_unit(blobs, kind))
                for t in range(lattice.tables):
                    for k in range(1 + lattice.neighbours):
                        n = len(mine)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(n, t, np.int32)),
                                pa.array(cells[:, t, k]),
                                pa.array(ids[mine]),
                                pa.array(np.full(n, k == 0)),
                                pa.array(copies[mine]),
                                pa.array(blobs, pa.binary()),
                            ],
                            names=["t", "cell", "class", "own", "copies", "vector"],
                        )

    placed = classes.select("class", "copies", "vector").mapInArrow(place, placed_schema)
    # Cells with more rows than a task should compare at once become a grid of
    # blocks; the optimizer knows the size of the written list.
    large = written(
        placed.groupBy("t", "cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_rows)
        .select("t", "cell", F.ceil(F.col("n") * 2 / cell_rows).cast("int").alias("chunks")),
        "large-cells",
    )
    chunks = F.coalesce("chunks", F.lit(1))
    gridded = (
        placed.join(large, ["t", "cell"], "left")
        .withColumn("chunk", F.pmod(F.xxhash64("class"), chunks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .select(
            "t", "cell", F.least("chunk", "other").alias("left"), F.greatest("chunk", "other").alias("right"),
            "chunk", "class", "own", "copies", "vector",
        )
    )
    keys = ("t", "cell", "left", "right")
    met = gridded.repartition(shuffle_width(vectors.sparkSession), *keys).sortWithinPartitions(*keys)
    counted = written(
        met.mapInArrow(lambda it: _counted(lattice, least, kind, it), "class long, links long, root long"), "vector-links"
    )
    links = counted.groupBy("class").agg(F.sum("links").alias("links"))
    roots = connected_components(counted, "class", "root")
    labelled = (
        classes.select("class", "vector", "copies", "smallest")
        .join(links, "class", "left")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    smallest = labelled.groupBy("root").agg(F.min("smallest").alias("component"))
    answers = labelled.join(smallest, "root").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component"
    )
    return rows.join(answers, "vector", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component", "vec_id")).alias("kept"),
    )
