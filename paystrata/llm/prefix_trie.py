"""Prefix trie of conversations: shards in balanced parentheses, merged at their spines.

Every conversation becomes a path of turn digests. Paths are sorted over all tasks;
a shard is a run of them and holds their trie as balanced parentheses, an opening bit
where a node begins in preorder and a closing one where its subtree ends. A tree of
block minima over the excess (openings less closings) finds the close of every node,
which delimits its subtree: differences of cumulative arrays at both ends give members,
leaves ("()" pairs) and savings.

A node that two shards know lies on the last path of the one and on the first of the
other. Only these spines are merged: sums are added, and what several shards have
counted once each (nodes, leaves, children) is counted in the first of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paystrata.llm.common import written

#: Turns (of all conversations) after which a task begins another shard.
SHARD_TURNS = 1 << 18
#: Bits per block of the excess.
BLOCK = 64

_KEY = 16
_ROOT = bytes(_KEY)
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_NODES = (
    "shard long, node binary, parent binary, depth long, edge boolean, parent_edge boolean, on_first boolean, "
    "on_last boolean, leaf boolean, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, chars long, added long, apart long, ends string, ids string"
)
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}


class Parentheses:
    """A balanced sequence of bits with rank of leaf pairs and findclose."""

    def __init__(self, bits: np.ndarray) -> None:
        self.opens = np.flatnonzero(bits)
        self.n = len(bits)
        self.n_blocks = max(1, -(-self.n // BLOCK))
        excess = np.cumsum(np.where(bits, 1, -1), dtype=np.int64)
        low = np.iinfo(np.int64).min
        # Beyond the end everything is low, so that every search ends.
        self.excess = np.full((self.n_blocks, BLOCK), low)
        self.excess.reshape(-1)[: self.n] = excess
        pairs = np.zeros(self.n, np.int64)
        pairs[:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
        self.pairs = np.concatenate([[0], np.cumsum(pairs)])
        self.leaves = 1 << (self.n_blocks - 1).bit_length()
        self.minima = np.full(2 * self.leaves, low)
        self.minima[self.leaves : self.leaves + self.n_blocks] = self.excess.min(1)
        size = self.leaves // 2
        while size:
            self.minima[size : 2 * size] = self.minima[2 * size : 4 * size].reshape(-1, 2).min(1)
            size //= 2

    def _in_block(self, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place of the block, beyond ``after``, whose excess is at most the target; or -1."""
        out = np.empty(len(block), np.int64)
        places = np.arange(BLOCK)
        for a in range(0, len(block), 1 << 15):
            part = slice(a, a + (1 << 15))
            hit = (self.excess[block[part]] <= target[part, None]) & (places > after[part, None])
            first = hit.argmax(1)
            out[part] = np.where(hit[np.arange(len(first)), first], block[part] * BLOCK + first, -1)
        return out

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where each opening bit's closing bit is."""
        block, place = opens // BLOCK, opens % BLOCK
        target = self.excess[block, place] - 1
        found = self._in_block(block, place, target)
        far = np.flatnonzero(found < 0)
        # From the block's right neighbour up to the first subtree that is low enough ...
        at, goal = block[far] + self.leaves, target[far]
        live = np.arange(len(far))
        while live.size:
            now = at[live]
            now = np.where(now & 1, (now + 1) >> 1, now + 1)
            at[live] = now
            live = live[self.minima[now] > goal[live]]
        # ... and down in it to the first such block.
        live = np.flatnonzero(at < self.leaves)
        while live.size:
            left = 2 * at[live]
            at[live] = np.where(self.minima[left] <= goal[live], left, left + 1)
            live = live[at[live] < self.leaves]
        found[far] = self._in_block(at - self.leaves, np.full(len(far), -1), goal)
        return found

    def leaf_pairs(self, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
        return self.pairs[closes] - self.pairs[opens]


class Shard:
    """The trie of consecutive sorted paths."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.turns = 0
        self.path = b""
        self.bits = bytearray(b"\x01")
        self.ids: list[int] = []
        self.ends: list[int] = []
        self.stack = [0]
        self.keys, self.parents, self.depths, self.chars, self.starts = [_ROOT], [-1], [0], [0], [0]
        self.first = 0

    def add(self, conv_id: int, path: bytes, chars: list[int]) -> None:
        """Paths must come in order; ``chars`` are the code points of each turn's text."""
        depth, common, least = len(path) // _KEY, 0, min(len(path), len(self.path))
        if path == self.path:
            common = depth
        else:
            while common * _KEY < least:
                a = common * _KEY
                if path[a : a + _KEY] != self.path[a : a + _KEY]:
                    break
                common += 1
        closing = len(self.stack) - 1 - common
        self.bits += bytes(closing)
        del self.stack[common + 1 :]
        key = self.keys[self.stack[-1]]
        for d in range(common, depth):
            key = hashlib.blake2b(key + path[d * _KEY : (d + 1) * _KEY], digest_size=_KEY).digest()
            self.parents.append(self.stack[-1])
            self.stack.append(len(self.keys))
            self.keys.append(key)
            self.depths.append(d + 1)
            self.chars.append(chars[d])
            self.starts.append(len(self.ids))
        self.bits += b"\x01" * (depth - common)
        if not self.ids:
            self.first = depth
        self.ids.append(conv_id)
        self.ends.append(self.stack[-1])
        self.path = path
        self.turns += 1 + depth

    def rows(self) -> Iterator[pa.RecordBatch]:
        """One row per node."""
        self.bits += bytes(len(self.stack))
        tree = Parentheses(np.frombuffer(bytes(self.bits), np.uint8))
        closes = tree.findclose(tree.opens)
        n = len(self.keys)
        end = np.arange(n) + (closes - tree.opens + 1) // 2
        starts = np.array([*self.starts, len(self.ids)])
        ids = np.array([*self.ids, np.iinfo(np.int64).max])
        n_convs = starts[end] - starts[:n]
        smallest = np.minimum.reduceat(ids, np.stack([starts[:n], starts[end]], 1).reshape(-1))[::2]
        chars, parents = np.array(self.chars, np.int64), np.array(self.parents)
        on_first, on_last = np.arange(n) <= self.first, np.zeros(n, bool)
        on_last[self.stack] = True
        edge = on_first | on_last

        def within(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[end] - sums[:n]

        ends, texts = self._ends(n, edge)
        columns = {
            "shard": np.full(n, self.number),
            "node": self.keys,
            "parent": [None, *(self.keys[p] for p in self.parents[1:])],
            "depth": np.array(self.depths, np.int64),
            "edge": edge,
            "parent_edge": np.where(parents >= 0, edge[parents], False),
            "on_first": on_first,
            "on_last": on_last,
            "leaf": end - np.arange(n) == 1,
            "conv_id": smallest,
            "parent_conv_id": smallest[parents],
            "n_convs": n_convs,
            "n_children": np.bincount(parents[1:], minlength=n),
            "n_leaves": tree.leaf_pairs(tree.opens, closes),
            "chars": chars,
            "added": within(n_convs * chars),
            "apart": within(chars),
            "ends": ends,
            "ids": texts,
        }
        kinds = dict(part.split(" ") for part in _NODES.split(", "))
        table = pa.table({name: pa.array(columns[name], _ARROW[kind]) for name, kind in kinds.items()})
        yield from table.to_batches(max_chunksize=20_000)

    def _ends(self, n: int, edge: np.ndarray) -> tuple[list[str | None], list[str | None]]:
        """Per node the digest of the ids that end there; for spines the ids themselves."""
        ends: list[str | None] = [_NO_ENDS] * n
        texts: list[str | None] = [None] * n
        at = 0
        while at < len(self.ids):
            node, begin = self.ends[at], at
            while at < len(self.ids) and self.ends[at] == node:
                at += 1
            text = ",".join(map(str, self.ids[begin:at]))
            if edge[node]:
                texts[node] = text
            else:
                ends[node] = hashlib.sha256(text.encode()).hexdigest()
        return ends, texts


def _shards(limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted paths of one task, cut into shards numbered in their order."""
    number = TaskContext.get().partitionId() << 32
    shard = Shard(number)
    for batch in batches:
        chars = batch.column("chars")
        for conv_id, path, turn_chars in zip(
            batch.column("conv_id").to_pylist(), batch.column("path").to_pylist(), chars.to_pylist()
        ):
            if shard.turns >= limit:
                yield from shard.rows()
                number += 1
                shard = Shard(number)
            shard.add(conv_id, path, turn_chars)
    if shard.ids:
        yield from shard.rows()


def _joined_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest per node of its id texts, which come in order; no text is kept."""

    def row(node: bytes, state) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"node": [node], "ends": [state.hexdigest()]})

    node, state = None, None
    for batch in batches:
        for key, text in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if key != node:
                if state is not None:
                    yield row(node, state)
                node, state = key, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if state is not None:
        yield row(node, state)


def rebuilt_paths(conversations: DataFrame, *, group: int = 100, heads: int = 6) -> DataFrame:
    """``conv_id``, ``path`` (16 bytes a turn) and ``chars`` (code points a turn).

    Conversation c takes its first h turns from conversation c - c % ``group`` and the
    rest from its own after the first h; h is the CRC-32 of c as text modulo ``heads``.
    Turns are ordered by ``turn``, null first, equal ones by digest; a null role or text
    is empty; rows without a ``conv_id`` are left out. Digests replace the texts before
    anything moves. One shuffle brings each group together.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("known"),
            F.col("turn").alias("turn"),
            F.substring(F.sha2(said, 256), 1, 2 * _KEY).alias("digest"),
            F.char_length(text).alias("chars"),
        ).alias("said"),
    )
    base = (F.col("conv_id") - F.col("conv_id") % group).alias("base")
    own = (
        turns.select("*", base)
        .repartition("base")
        .groupBy("base", "conv_id")
        .agg(F.array_sort(F.collect_list("said")).alias("own"))
    )
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, heads)))
    both = own.withColumn("head", head.over(Window.partitionBy("base"))).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    )
    kept = F.slice("own", F.col("h") + 1, F.size("own"))
    path = F.when(F.col("head").isNull(), kept).otherwise(F.concat(F.slice("head", F.lit(1), F.col("h")), kept))
    return both.select("conv_id", path.alias("turns")).select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["chars"]).alias("chars"),
    )


def prefix_trie(paths: DataFrame, *, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct prefix of the paths, the empty one (root) included.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. The
    paths come from :func:`rebuilt_paths`: one row per ``conv_id``, no nulls. Equal
    conversations end at one node, however many; extra columns are ignored; an empty
    table gives no rows, conversations without turns only the root.

    Rows are dealt by path and id, so a frequent path is split between tasks. A task
    holds one shard at a time (``shard_turns`` turns, or one longer conversation at 40
    bytes a turn); texts are never held. Spines have at most twice the depth of a path
    per shard. Turns are told apart by 128 bits of SHA-256.
    """
    dealt = paths.select("conv_id", "path", "chars").repartitionByRange("path", "conv_id")
    dealt = dealt.sortWithinPartitions("path", "conv_id")
    nodes = written(dealt.mapInArrow(lambda it: _shards(shard_turns, it), _NODES), "trie-nodes")
    tops = written(_merged_spines(nodes.where("edge")), "trie-spines")

    sums = ("n_convs", "n_children", "n_leaves")
    result = ("conv_id", "depth", "parent_conv_id", *sums, "saved_tokens", "ends_sha256")
    inner = nodes.where("NOT edge").select(
        "parent", "parent_edge", "conv_id", "depth", "parent_conv_id", *sums,
        (F.col("added") - F.col("apart")).alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )
    parents = tops.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    below_spine = inner.where("parent_edge").drop("parent_conv_id").join(parents, "parent")
    spine = tops.join(parents, "parent", "left")
    return inner.where("NOT parent_edge").select(*result).unionByName(below_spine.select(*result)).unionByName(spine.select(*result))


def _merged_spines(edge: DataFrame) -> DataFrame:
    """Nodes of the first and last paths of all shards, one row each."""
    known = Window.partitionBy("node")
    own = F.col("shard") == F.min("shard").over(known)
    rows = edge.drop("ids", "ends").withColumns({"own": own, "leaf_everywhere": F.min("leaf").over(known)})
    # What the shard has counted although another one counts it, or though it is no leaf.
    again = F.when(~F.col("own"), F.col("chars")).otherwise(0)
    no_leaf = (F.col("leaf") & ~(F.col("own") & F.col("leaf_everywhere"))).cast("long")
    below = Window.partitionBy("shard").orderBy(F.desc("depth"))  # a path's nodes, the deepest first

    def beneath(value):
        on_first = F.sum(F.when(F.col("on_first"), value).otherwise(0)).over(below)
        on_last = F.sum(F.when(~F.col("on_first"), value).otherwise(0)).over(below)
        return F.when(F.col("on_first"), on_first).otherwise(0) + F.when(F.col("on_last"), on_last).otherwise(0)

    rows = rows.withColumns({"again": beneath(again), "no_leaf": beneath(no_leaf)})
    merged = rows.groupBy("node").agg(
        F.min("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("children"),
        F.sum(F.col("n_leaves") - F.col("no_leaf")).alias("n_leaves"),
        F.sum(F.col("added") - F.col("apart") + F.col("again")).alias("saved_tokens"),
    )
    repeated = rows.where(~F.col("own") & F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node"))
    repeated = repeated.agg(F.count(F.lit(1)).alias("repeated"))
    texts = edge.where(F.col("ids").isNotNull()).select("node", "shard", "ids")
    digests = texts.repartition("node").sortWithinPartitions("node", "shard").drop("shard")
    digests = digests.mapInArrow(_joined_digest, "node binary, ends string")
    return (
        merged.join(repeated, "node", "left")
        .join(digests, "node", "left")
        .withColumn("n_children", F.col("children") - F.coalesce("repeated", F.lit(0)))
        .withColumn("ends_sha256", F.coalesce("ends", F.lit(_NO_ENDS)))
        .drop("children", "repeated", "ends")
    )
