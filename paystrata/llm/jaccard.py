"""Exact Jaccard join of word shingle sets, for links and their components.

Sets are put in an order of rare shingles first, and each contributes the few
shingles of its prefix to an index of lists: two sets similar enough share one. In
a short list the pairs that sizes and shared prefixes allow become candidates. In
a long list, which near copies make, sets are not paired: all join the group of
one member, the pivot. There a set's overlaps with the others follow from the
pivot's: only what differs from the pivot is compared,

    |x & y| = |x & s| + |y & s| - |s| + |(s - x) & (s - y)| + |(x - s) & (y - s)|

and sets already known to be connected are skipped. Results are links that span
the components, as many as there are sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import discard, shuffle_width, written
from paystrata.llm.components import connected_components
from paystrata.llm.grouped import groups, smallest_reachable

#: Lists with more sets than this get a pivot instead of pairs.
SHORT_LIST = 32
#: Sets of a group that one task compares at once; larger groups are compared in blocks.
GROUP_SETS = 256
#: Counters of the sketch that orders shingles by frequency; 4 MB per task, 1 MB when shared.
COUNTERS = 1 << 20
_PART = 1 << 14


class Shingler:
    """Distinct shingles of a text as sorted 64-bit hashes."""

    def __init__(self, words: int) -> None:
        import xxhash

        class Hashes(dict):
            def __missing__(self, word: bytes) -> int:
                if len(self) > 300_000:  # bounds the worker's memory
                    self.clear()
                value = self[word] = xxhash.xxh3_64_intdigest(word)
                return value

        self.words, self.hashes = words, Hashes()

    def __call__(self, text: str | None) -> np.ndarray:
        """A-Z in lower case; fewer words than a shingle has make one shingle."""
        tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not tokens:
            return np.zeros(0, np.uint64)
        size = min(self.words, len(tokens))
        hashed = np.fromiter(map(self.hashes.__getitem__, tokens), np.uint64, len(tokens))
        count = len(tokens) - size + 1
        value = np.full(count, np.uint64(size))
        for k in range(size):
            value = (value ^ (value >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashed[k : k + count]
        return np.unique(value * np.uint64(0xBF58476D1CE4E5B9) ^ (value >> np.uint64(32)))


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(44)).astype(np.int64)  # the upper 20 bits


def node_key(text: Column, word: int) -> Column:
    """60 bits of a text's SHA-256, the ``word``-th such piece."""
    digits = F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1 + 15 * word, 15)
    return F.conv(digits, 16, 10).cast("long")


def _set_sizes(docs: DataFrame, words: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, digest, n_shingles) per document, and how frequent shingles are.

    Frequencies are counted over all documents in a table of fixed size, so equal
    counters may stand for several shingles. They only order the shingles: any
    order gives the same links, a better one shorter lists.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts = Shingler(words), np.zeros(COUNTERS, np.int64)
        names = ["doc_id", "digest", "n_shingles", "part", "cells"]
        for batch in batches:
            sets = [shingler(t) for t in batch.column("text").to_pylist()]
            if not sets:
                continue
            counts += np.bincount(_counter(np.concatenate(sets)), minlength=COUNTERS)
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("digest"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                ],
                names=names,
            )
        parts = [counts[at : at + _PART].astype("<i4").tobytes() for at in range(0, COUNTERS, _PART)] if counts.any() else []
        if parts:
            n = len(parts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()),
                    pa.array(range(n), pa.int32()), pa.array(parts, pa.binary()),
                ],
                names=names,
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, cells in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
                sums[part] = sums.get(part, 0) + np.frombuffer(cells, "<i4").astype(np.int64)
        if sums:
            # The number of binary digits is all that the order uses.
            levels = [np.frexp(v.astype(np.float64))[1].astype(np.uint8).tobytes() for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], names=["part", "cells"])

    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest")
    both = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest, "text").mapInArrow(
            read, "doc_id long, digest binary, n_shingles long, part int, cells binary"
        ),
        "shingle-sets",
    )
    sketch = both.where("part IS NOT NULL").select("part", "cells").repartition("part").mapInArrow(add, "part int, cells binary")
    levels = np.zeros(COUNTERS, np.uint8)
    for part, cells in sketch.collect():
        levels[part * _PART : (part + 1) * _PART] = np.frombuffer(cells, np.uint8)
    return both.where("part IS NULL").select("doc_id", "digest", "n_shingles"), levels


def _index(docs: DataFrame, key: Column, words: int, percent: int, levels: np.ndarray) -> DataFrame:
    """(token, node, size): the prefix of every set, rare shingles first."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, level, seen = Shingler(words), shared.value, set()
        for batch in batches:
            tokens, nodes, sizes = [], [], []
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
                if node in seen:  # a copy of a text this task has had
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(node)
                shingles = shingler(text)
                n = len(shingles)
                keep = n - -(-percent * n // 100) + 1
                order = np.lexsort((shingles, level[_counter(shingles)]))[:keep] if n else []
                tokens.append(shingles[order].view(np.int64) if n else np.zeros(0, np.int64))
                nodes.append(np.full(len(tokens[-1]), node, np.int64))
                sizes.append(np.full(len(tokens[-1]), n, np.int32))
            if tokens:
                columns = [pa.array(np.concatenate(c)) for c in (tokens, nodes, sizes)]
                yield pa.RecordBatch.from_arrays(columns, names=["token", "node", "size"])

    return docs.select(key.alias("node"), "text").mapInArrow(read, "token long, node long, size int")


def _members(index: DataFrame, percent: int, short_list: int) -> DataFrame:
    """(pivot, node): sets to be compared with each other, pair by pair or as a group.

    Sizes fall into classes such that similar sets are in the same class or in
    neighbouring ones; a list is cut accordingly.
    """
    # Most tokens have one set only. Reduced on the map side, so a frequent token is
    # one row per task; the join that follows splits a hot token if need be.
    several = index.groupBy("token").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("sets")
    )
    # Lists are stored in pieces of bounded length, without another shuffle. Copies
    # of a text count in ``sets``, so a list may be taken for long too early.
    piece = F.when(F.col("sets") <= short_list, 0).otherwise(F.pmod(F.xxhash64("node"), F.ceil(F.col("sets") / short_list)))
    lists = written(
        index.join(several.where("low <> high").select("token", "sets"), "token")
        .groupBy("token", piece.alias("piece"))
        .agg(F.first("sets").alias("sets"), F.collect_set(F.struct("node", "size")).alias("members")),
        "shingle-lists",
    )

    # At most short_list sets each, so their pairs are few.
    one = lists.where(F.col("sets") <= short_list).select("members", F.explode("members").alias("x"))
    pairs = one.select("x", F.explode("members").alias("y")).select(
        F.col("x.node").alias("pivot"), F.col("y.node").alias("node"),
        F.least("x.size", "y.size").alias("small"), F.greatest("x.size", "y.size").alias("large"),
    )
    alike = (F.col("pivot") < F.col("node")) & (F.col("small") * 100 >= F.col("large") * percent)
    # Shared shingles outside the prefixes are at most the rest of a set, so the
    # prefixes must share the others. Two sets that also share a long list meet in
    # its group, whatever their number here says.
    overlap = F.ceil((F.col("small") + F.col("large")) * percent / (100 + percent) - F.lit(1e-9))
    rest = F.ceil(F.col("large") * percent / 100 - F.lit(1e-9)) - 1
    possible = (
        pairs.where(alike)
        .groupBy("pivot", "node", "small", "large")
        .agg(F.count(F.lit(1)).alias("shared"))
        .where(F.col("shared") + rest >= overlap)
        .select("pivot", "node")
    )
    long_ = lists.where(F.col("sets") > short_list).select("token", F.inline("members"))
    size_class = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-6)
    cut = long_.select("token", "node", size_class.alias("class"))
    pivots = cut.groupBy("token", "class").agg(F.min("node").alias("pivot"))
    joined = (
        cut.withColumn("class", F.explode(F.array(F.col("class"), F.col("class") - 1)))
        .join(pivots, ["token", "class"])
        .select("pivot", "node")
    )
    members = written(possible.union(joined).where("pivot <> node").distinct(), "shingle-groups")
    discard(lists)
    return members


class _Group:
    """Sets that are compared by what differs from the first of them, the pivot."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.sets, self.percent = sets, percent
        self.size = np.array([len(s) for s in sets])
        self.with_pivot = np.array([np.isin(s, sets[0], assume_unique=True).sum() for s in sets])

    def _link(self, rows: np.ndarray, shared: np.ndarray) -> np.ndarray:
        return 100 * shared >= self.percent * (self.size[rows][:, None] + self.size[None, :] - shared)

    def pivot_links(self) -> np.ndarray:
        return self._link(np.array([0]), self.with_pivot[None, :])[0]

    def links(self, rows: np.ndarray) -> np.ndarray:
        """Which of the sets ``rows`` link with which sets, from their overlaps with the pivot."""
        pivot, sets = self.sets[0], self.sets
        # Missing from the pivot and extra to it, as one set of differences; a
        # difference that only one set has cannot be shared.
        parts = [(np.setdiff1d(pivot, s, assume_unique=True), np.setdiff1d(s, pivot, assume_unique=True)) for s in sets]
        owner = np.repeat(np.arange(len(sets)), [len(m) + len(e) for m, e in parts])
        _, column, count = np.unique(np.concatenate([v for p in parts for v in p]), return_inverse=True, return_counts=True)
        keep = count[column] > 1
        owner, column = owner[keep], (np.cumsum(count > 1) - 1)[column[keep]]
        shared = self.with_pivot[rows][:, None] + self.with_pivot[None, :] - len(pivot)
        width = int((count > 1).sum())
        for at in range(0, width, 8192):
            here = (column >= at) & (column < at + 8192)
            block = np.zeros((len(sets), min(8192, width - at)), np.float32)
            block[owner[here], column[here] - at] = 1
            shared = shared + (block[rows] @ block.T).astype(np.int64)
        return self._link(rows, shared)


def _resolve(words: int, percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, linked, text) per set of a group.

    In a whole group, b is the smallest set that a is connected with. In a block of
    a large group, b is the pivot, ``linked`` says whether the two link, and the text
    goes along for the comparisons to come.
    """
    shingler = Shingler(words)
    for group in groups(batches, "pivot", "block"):
        pivot = group.column("pivot")[0].as_py()
        whole = group.column("block")[0].as_py() < 0
        order = np.argsort(~group.column("is_pivot").to_numpy(), kind="stable")
        nodes = group.column("node").to_numpy()[order]
        texts = group.column("text").to_pylist()
        sets = [shingler(texts[i]) for i in order]
        if nodes[0] != pivot or len(nodes) < 2:
            continue
        compared = _Group(sets, percent)
        first = compared.pivot_links()
        if not whole:
            a, b, linked = nodes[1:], np.full(len(nodes) - 1, pivot), first[1:]
            kept = pa.array([texts[i] for i in order[1:]], pa.string())
        else:
            # Sets that link with the pivot are connected; only the others are compared.
            others = np.flatnonzero(~first)
            i, j = np.zeros(0, int), np.zeros(0, int)
            if len(others) and len(sets) > 2:
                i, j = np.nonzero(compared.links(others))
                i = others[i]
            near = np.flatnonzero(first)
            root = smallest_reachable(nodes, np.concatenate([i, near]), np.concatenate([j, np.zeros(len(near), int)]))
            apart = root != nodes
            a, b, linked = nodes[apart], root[apart], np.ones(int(apart.sum()), bool)
            kept = pa.nulls(len(a), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b), pa.array(linked), kept], names=["a", "b", "linked", "text"]
        )


def _across(words: int, percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the sets apart from a large group's pivot and the rest, block by block."""
    shingler = Shingler(words)
    for block in groups(batches, "pivot", "left", "right"):
        probe = block.column("probe").to_numpy(zero_copy_only=False)
        if not probe.any():
            continue
        nodes = block.column("node").to_numpy()
        sets = [shingler(t) for t in block.column("text").to_pylist()]
        rows = np.flatnonzero(probe)
        i, j = np.nonzero(_Group(sets, percent).links(rows))
        root = smallest_reachable(nodes, rows[i], j)
        apart = root != nodes
        yield pa.RecordBatch.from_arrays([pa.array(nodes[apart]), pa.array(root[apart])], names=["a", "b"])


def _links(texts: DataFrame, members: DataFrame, words: int, percent: int, group_sets: int) -> DataFrame:
    """(a, b): links that span the components of all groups."""
    spark = texts.sparkSession
    sizes = members.groupBy("pivot").agg(F.count(F.lit(1)).alias("sets"))
    blocks = F.when(F.col("sets") > group_sets, F.ceil(F.col("sets") * 2 / group_sets)).otherwise(0).cast("int")
    sizes = written(sizes.select("pivot", blocks.alias("blocks")), "group-sizes")
    placed = members.join(sizes, "pivot").withColumn(
        "block", F.when(F.col("blocks") == 0, -1).otherwise(F.pmod(F.xxhash64("node"), F.greatest("blocks", F.lit(1)))).cast("int")
    )
    own = sizes.withColumn(
        "block", F.explode(F.when(F.col("blocks") == 0, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    ).select("pivot", F.col("pivot").alias("node"), "block", F.lit(True).alias("is_pivot"))
    rows = placed.select("pivot", "node", "block", F.lit(False).alias("is_pivot")).union(own).join(texts, "node")
    keys = ("pivot", "block")
    together = rows.repartition(shuffle_width(spark), *keys).sortWithinPartitions(*keys)
    resolved = written(
        together.mapInArrow(lambda it: _resolve(words, percent, it), "a long, b long, linked boolean, text string"),
        "group-links",
    )
    links = resolved.where("linked").select("a", "b")
    if not sizes.where("blocks > 0").head(1):
        return links
    # Large groups: the sets that do not link with the pivot against all others.
    large = resolved.where("text IS NOT NULL").select(F.col("b").alias("pivot"), F.col("a").alias("node"), "linked", "text")
    apart = large.where("NOT linked")
    rest = written(
        apart.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) * 2 / group_sets).cast("int").alias("lefts")), "groups-apart"
    )
    left = (
        apart.join(rest, "pivot").join(sizes, "pivot")
        .withColumn("left", F.pmod(F.xxhash64("node"), F.col("lefts")).cast("int"))
        .withColumn("right", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("pivot", "left", "right", "node", "text", F.lit(True).alias("probe"))
    )
    right = (
        large.join(rest, "pivot").join(sizes, "pivot")
        .withColumn("right", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("left", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)))
        .select("pivot", "left", "right", "node", "text", F.lit(False).alias("probe"))
    )
    keys = ("pivot", "left", "right")
    both = left.union(right).repartition(shuffle_width(spark), *keys).sortWithinPartitions(*keys)
    return links.union(both.mapInArrow(lambda it: _across(words, percent, it), "a long, b long"))


def similar_sets(
    docs: DataFrame,
    *,
    words: int = 3,
    percent: int = 90,
    short_list: int = SHORT_LIST,
    group_sets: int = GROUP_SETS,
) -> DataFrame:
    """A row per document: ``doc_id``, ``digest`` (of the text), ``n_shingles``, ``component_id``
    and ``component``, a key that also tells apart components with the same smallest id.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets
    of ``words``-word shingles. Null and empty texts and those without words have
    no shingles and link with nothing; shorter texts are one shingle. Equal texts
    are one node. The component is the smallest document id reachable by links; a
    null id is never it unless there is no other. Rows that repeat an id are
    documents of their own; columns other than doc_id and text are ignored; an empty
    table gives an empty table.
    """
    rows, levels = _set_sizes(docs, words)
    for word in range(4):  # other bits, should two texts ever share the first
        digits = F.substring(F.hex("digest"), 1 + 15 * word, 15)
        keyed = rows.withColumn("node", F.conv(digits, 16, 10).cast("long"))
        nodes = keyed.groupBy("node").agg(
            F.min("doc_id").alias("smallest"), F.max("n_shingles").alias("n"),
            F.min(F.xxhash64("digest")).alias("low"), F.max(F.xxhash64("digest")).alias("high"),
        )
        if not nodes.where("low <> high").head(1):
            break
    key = node_key(F.col("text"), word)
    members = _members(_index(docs, key, words, percent, levels), percent, short_list)
    # One text per node; copies are reduced on the map side, and the groups join them
    # where this one shuffle of the texts has put them.
    texts = docs.groupBy(key.alias("node")).agg(F.first("text").alias("text"))
    roots = connected_components(_links(texts, members, words, percent, group_sets))
    labelled = (
        nodes.where("n > 0").select("node", "smallest").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    )
    component = labelled.groupBy("root").agg(F.min("smallest").alias("component"))
    labels = labelled.join(component, "root").select("node", "root", "component")
    return keyed.join(labels, "node", "left").select(
        "doc_id", "digest", "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"), F.col("root").alias("component"),
    )


def first_of_each(found: DataFrame) -> DataFrame:
    """(doc_id, digest) of the documents to keep: of a component the one with the smallest id.

    Equal ids are told apart by the digest, null ids come last. Documents without
    shingles belong to no component and all stay.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    grouped = found.where("component IS NOT NULL").groupBy("component").agg(first).select("first.doc_id", "first.digest")
    return grouped.union(found.where("component IS NULL").select("doc_id", "digest"))
