"""Removal of long byte strings that occur more than once, by sorted suffixes.

Sorting every suffix of a corpus is not needed to find strings of ``min_bytes``
that repeat. Each such string holds an anchor, the gram whose hash is the smallest
in it, and equal strings hold equal anchors at equal places. So only texts around
anchors whose gram occurs twice are compared: the suffixes that start at the
anchors, and the reversed texts before them, are sorted by deep-shallow sorting.
What two neighbours have in common on both sides then says exactly which bytes
repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import discard, shuffle_width, text_key, written
from paystrata.llm.grouped import groups

#: Length of the repeated strings, and of the grams among which anchors are chosen.
MIN_BYTES, GRAM_BYTES = 400, 100
#: Anchors that one task sorts together; groups with more are divided first.
GROUP_ANCHORS = 4096
#: Groups up to this size are compared pair by pair, larger ones offset by offset.
PAIRED = 64
#: Bits of the tables that tell which grams may repeat and which texts may be wanted.
FILTER_BITS = 1 << 27
#: Bytes that multikey quicksort looks at before blind tries take over.
SHALLOW = 16

_SEGMENT = 1 << 20  # positions of a text that are hashed together
_PLACE = np.uint64((1 << 21) - 1)
_BASE, _UNBASE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)

SPAN = "tkey binary, begin long, end long"


class AnchorFinder:
    """Anchors of a text, and strings that repeat within it at a short distance."""

    def __init__(self, min_bytes: int, gram: int) -> None:
        self.min_bytes, self.gram, self.width = min_bytes, gram, min_bytes - gram + 1
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grams(self, data: np.ndarray) -> np.ndarray:
        """Hash of every gram: differences of prefix sums, brought to a common power."""
        size = len(data)
        if size > len(self.powers):
            self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * size, np.uint64(_BASE))]))
            self.inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * size, np.uint64(_UNBASE))]))
        total = np.zeros(size + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:size], out=total[1:])
        count = size - self.gram + 1
        value = (total[self.gram :] - total[:count]) * self.inverse[:count]
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xD6E8FEB86659FD93)
        return value ^ (value >> np.uint64(32))

    def _smallest(self, grams: np.ndarray) -> np.ndarray:
        """Place of the smallest gram, the first of equals, in each window."""
        width, count = self.width, len(grams) - self.width + 1
        keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        padded = np.full(-(-len(keys) // width) * width, ~np.uint64(0))
        padded[: len(keys)] = keys
        blocks = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, 1).reshape(-1)
        behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].reshape(-1)
        least = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
        return (least & _PLACE).astype(np.int64)

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
        """(anchor positions, their gram hashes, spans known to repeat)."""
        places, hashes, spans = [], [], []
        step = _SEGMENT - self.min_bytes
        for base in range(0, max(0, len(text) - self.min_bytes + 1), step):
            data = np.frombuffer(text, np.uint8, min(len(text) - base, step + self.min_bytes - 1), base)
            grams = self._grams(data)
            smallest = self._smallest(grams)
            alive = np.ones(len(smallest), bool)
            anchors = np.unique(smallest)
            # A short period makes many anchors with one gram. Its strings repeat
            # here; only the first of each stays to be compared with other texts.
            near = (np.diff(anchors) < self.width) & (grams[anchors[1:]] == grams[anchors[:-1]])
            for shift in np.unique(np.diff(anchors)[near]).tolist():
                unequal = np.concatenate([[0], np.cumsum(data[:-shift] != data[shift:])])
                if len(unequal) <= self.min_bytes:
                    continue
                same = np.flatnonzero(unequal[self.min_bytes :] == unequal[: -self.min_bytes])
                if same.size:
                    alive[same + shift] = False
                    for run in np.split(same, np.flatnonzero(np.diff(same) != 1) + 1):
                        spans.append((base + int(run[0]), base + int(run[-1]) + shift + self.min_bytes))
            anchors = np.unique(smallest[alive])
            places.append(anchors + base)
            hashes.append(grams[anchors])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), []
        place, first = np.unique(np.concatenate(places), return_index=True)
        return place, np.concatenate(hashes)[first], spans


class _Trie:
    """Blind trie: inner nodes hold only the depth at which their strings part."""

    def __init__(self, strings: list[bytes], first: int) -> None:
        self.strings = strings
        self.root: int | tuple[int, dict] = first

    def insert(self, new: int) -> None:
        text = self.strings[new]
        # Go down without comparing, to any leaf that agrees at the branching bytes.
        node, path = self.root, []
        while not isinstance(node, int):
            path.append(node)
            depth, children = node
            byte = text[depth] if depth < len(text) else -1
            node = children.get(byte) if byte in children else next(iter(children.values()))
        depth = common_prefix(text, self.strings[node])
        # One comparison tells where the new string parts from the trie.
        parent, below = None, self.root
        for inner in path:
            if inner[0] >= depth:
                below = inner
                break
            parent = inner
            byte = text[inner[0]] if inner[0] < len(text) else -1
            below = inner[1].get(byte)
        byte = text[depth] if depth < len(text) else -1
        if below is not None and not isinstance(below, int) and below[0] == depth:
            equal = below[1].get(byte)
            if equal is None:
                below[1][byte] = new
            else:  # the same string again: a node whose strings all end here
                below[1][-2 - len(below[1])] = new
            return
        other = self.strings[node]
        children = {other[depth] if depth < len(other) else -1: below}
        children[-2 if byte in children else byte] = new
        if parent is None:
            self.root = (depth, children)
        else:
            parent[1][text[parent[0]] if parent[0] < len(text) else -1] = (depth, children)

    def ordered(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, int):
                out.append(node)
            else:
                stack.extend(node[1][byte] for byte in sorted(node[1], reverse=True))
        return out


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:  # a[:low] == b[:low], a[:high] != b[:high]
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def deep_shallow_sort(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Positions of the strings in sorted order.

    Multikey quicksort splits by a few bytes at a time; what is equal down to the
    shallow depth has a long common prefix and is ordered by a blind trie.
    """
    out: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        part, depth = stack.pop()
        if len(part) < 2:
            out.extend(part)
        elif depth >= shallow:
            trie = _Trie(strings, part[0])
            for position in part[1:]:
                trie.insert(position)
            out.extend(trie.ordered())
        else:
            keys = [strings[p][depth : depth + 4] for p in part]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            less = [p for p, key in zip(part, keys) if key < pivot]
            same = [p for p, key in zip(part, keys) if key == pivot]
            more = [p for p, key in zip(part, keys) if key > pivot]
            # The stack takes them in reverse; strings that end here are equal.
            stack += [(more, depth), (same, depth + 4 if len(pivot) == 4 else shallow), (less, depth)]
    return out


def _ranked(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order, and the length neighbours in it have in common."""
    order = deep_shallow_sort(strings)
    shared = [common_prefix(strings[a], strings[b]) for a, b in zip(order[:-1], order[1:])]
    return np.array(order), np.array(shared, np.int64)


def _pairwise(order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Common prefix of any two strings: the least between their places."""
    m = len(order)
    out = np.zeros((m, m), np.int64)
    for i in range(m - 1):
        least = np.minimum.accumulate(shared[i:])
        out[order[i], order[i + 1 :]] = least
        out[order[i + 1 :], order[i]] = least
    return out


def repeated_spans(
    left: list[bytes], right: list[bytes], low: int, high: int, min_bytes: int
) -> list[tuple[int, int, int]]:
    """(member, begin, end) relative to the anchor: what members share with others.

    ``left`` are the reversed bytes before the anchors, ``right`` those from them on.
    Only strings that start ``low`` to ``high`` bytes before the anchor count.
    """
    after, before = _ranked(right), _ranked(left)
    m = len(left)
    if m <= PAIRED:
        ahead, back = _pairwise(*after), _pairwise(*before)
        # A string that starts o bytes before the anchor is shared if o bytes before
        # and min_bytes - o after it are.
        most, least = np.minimum(back, high), np.maximum(min_bytes - ahead, low)
        shared = least <= most
        np.fill_diagonal(shared, False)
        i, j = np.nonzero(shared)
        return list(zip(i.tolist(), (-most[i, j]).tolist(), (min_bytes - least[i, j]).tolist()))
    covered = np.zeros((m, high - low + 1), bool)
    behind, beyond = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    for offset in range(low, high + 1):
        # Strings are equal if their parts on both sides are in the same classes.
        classes = np.zeros((2, m), np.int64)
        for row, (order, common), need in ((0, after, min_bytes - offset), (1, before, offset)):
            classes[row][order] = np.concatenate([[0], np.cumsum(common < need)])
        valid = np.flatnonzero((behind >= offset) & (beyond >= min_bytes - offset))
        _, which, count = np.unique(classes[0][valid] * m + classes[1][valid], return_inverse=True, return_counts=True)
        covered[valid, offset - low] = count[which] > 1
    edge = np.diff(np.pad(covered, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    i, first = np.nonzero(edge == 1)
    _, after_last = np.nonzero(edge == -1)
    return [(a, -(low + z - 1), min_bytes - (low + b)) for a, b, z in zip(i.tolist(), first.tolist(), after_last.tolist())]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs; spans that touch are one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = out[-1][0], end
        else:
            out.append((begin, end))
    return out


def _span_batch(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    keys, begins, ends = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(begins, pa.int64()), pa.array(ends, pa.int64())], names=["tkey", "begin", "end"]
    )


def _compare(min_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple[bytes, int, int]] = []
    for group in groups(batches, "key", "low", "high"):
        if group.num_rows < 2:
            continue
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        keys, places, left, right = (group.column(c).to_pylist() for c in ("tkey", "pos", "left", "right"))
        found: dict[int, list[tuple[int, int]]] = {}
        for member, begin, end in repeated_spans([x[::-1] for x in left], right, low, high, min_bytes):
            found.setdefault(member, []).append((begin, end))
        for member, spans in found.items():
            out += [(keys[member], places[member] + a, places[member] + b) for a, b in _merged(spans)]
        if len(out) > 10_000:
            yield _span_batch(out)
            out = []
    if out:
        yield _span_batch(out)


_ITEM = "key binary, tkey binary, pos long, left binary, right binary, low int, high int"


def _divide(min_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Halve the range of offsets; each half gets the bytes that all its strings share as key.

    ``hull`` names the bytes that any of its strings covers: where those occur twice,
    the whole half repeats, and no comparison is needed.
    """
    for batch in batches:
        rows = []
        for tkey, pos, left, right, low, high in zip(
            *(batch.column(c).to_pylist() for c in ("tkey", "pos", "left", "right", "low", "high"))
        ):
            middle = (low + high) // 2
            for a, b in ((low, middle), (middle + 1, high)):
                if a > b or max(a, min_bytes - len(right)) > min(b, len(left)):
                    continue  # no string of this range fits into the text
                mark = b"%d,%d:" % (a, b)
                core = left[len(left) - a :] + right[: min_bytes - b]
                hull = None
                if len(left) >= b and len(right) >= min_bytes - a:
                    hull = hashlib.blake2b(mark + left[len(left) - b :] + right[: min_bytes - a], digest_size=16).digest()
                rows.append((hull, hashlib.blake2b(mark + core, digest_size=16).digest(), tkey, pos, left, right, a, b))
        if rows:
            kinds = [pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                names=["hull", "key", "tkey", "pos", "left", "right", "low", "high"],
            )


def _all_spans(items: DataFrame, min_bytes: int, group_anchors: int) -> DataFrame:
    """Spans of all groups of anchors; groups too large for a task are divided by content."""
    spark = items.sparkSession
    found = None
    while True:
        counts = items.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        crowded = written(counts.where(F.col("n") > group_anchors).select("key"), "crowded-anchors")
        some = bool(crowded.head(1))
        small = items.join(crowded, "key", "left_anti") if some else items
        keys = ("key", "low", "high")
        spans = (
            small.repartition(shuffle_width(spark), *keys).sortWithinPartitions(*keys)
            .mapInArrow(lambda it: _compare(min_bytes, it), SPAN)
        )
        found = spans if found is None else found.union(spans)
        if not some:
            return found
        # Moved first: items may come from Python themselves, and two such steps in one
        # task take two Python processes, which stay with their executor.
        apart = items.join(crowded, "key", "left_semi").repartition(shuffle_width(spark), "tkey", "pos", "low")
        halves = written(apart.mapInArrow(lambda it: _divide(min_bytes, it), f"hull binary, {_ITEM}"), "anchor-halves")
        repeated = halves.where("hull IS NOT NULL").groupBy("hull").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hull")
        whole = halves.join(repeated, "hull", "left_semi")
        found = found.union(
            whole.select("tkey", (F.col("pos") - F.col("high")).alias("begin"), (F.col("pos") + min_bytes - F.col("low")).alias("end"))
        )
        # A half whose hull repeats is settled, but others may share a part of it
        # only, so one of each stays to be compared with.
        first = whole.groupBy("hull").agg(F.min(F.struct("key", "tkey", "pos", "left", "right", "low", "high")).alias("one"))
        rest = halves.join(repeated, "hull", "left_anti").select("key", "tkey", "pos", "left", "right", "low", "high")
        items = written(rest.union(first.select("one.*")), "anchor-items")


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """``FILTER_BITS`` bits (16 MB whatever the data); those are set on which a value of ``hash`` falls."""
    bit = F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1))
    part, position = F.shiftright(bit, 15).cast("int"), bit.bitwiseAND(F.lit((1 << 15) - 1)).cast("int")
    parts = hashes.groupBy(part.alias("part")).agg(F.bitmap_construct_agg(position).alias("bits")).collect()
    table = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in parts:
        table[row.part << 12 : (row.part + 1) << 12] = np.frombuffer(row.bits, np.uint8)
    return table


def _passing(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes fall on a bit of ``_bitmap`` that is set: all it was made of, and few others."""
    at = hashes & (FILTER_BITS - 1)
    return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0


def _may_hold(hashes: DataFrame) -> Callable[[Column], Column]:
    """A test of hashes that all of ``hashes`` pass, and the fewer others the fewer bits are set.

    Rows that fail it need not move to meet the others. The bitmap is small and fixed in
    size, so it may be broadcast.
    """
    bits = hashes.sparkSession.sparkContext.broadcast(_bitmap(hashes))

    @F.pandas_udf("boolean")
    def passing(value: pd.Series) -> pd.Series:
        return pd.Series(_passing(bits.value, value.to_numpy()))

    return passing


def texts_in(keys: DataFrame) -> Callable[[Column], Column]:
    """A test of text keys that all of ``keys`` (tkey) pass, and few others."""
    test = _may_hold(keys.select(F.xxhash64("tkey").alias("hash")))
    return lambda tkey: test(F.xxhash64(tkey))


def repeats(
    docs: DataFrame, *, min_bytes: int = MIN_BYTES, gram: int = GRAM_BYTES, group_anchors: int = GROUP_ANCHORS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, texts, spans): what repeats in ``docs`` (doc_id, text).

    ``documents``: doc_id, tkey (names the text), n_bytes, copies (rows with the same
    text), sha256 (of the whole text). ``spans``: tkey and spans (array of begin, end, in
    no order and possibly overlapping: bytes covered by strings of ``min_bytes`` that
    start anywhere else too), for the texts that have any; ``texts``: the same and text
    (bytes). Copies of a text are one text here; as documents they repeat as a whole. A
    null text counts as empty. Shorter texts have nothing to remove. Rows that repeat an id are documents of their own.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("tkey"), text.alias("text"))
    long_enough = keyed.where(F.octet_length("text") >= min_bytes)
    anchor_schema = "gram long, tkey binary, pos long, end long"

    # Anchors of texts that may have copies have the end -2, all others -1.
    copied = long_enough.groupBy("tkey").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(copied.select(F.xxhash64("tkey").alias("hash"))))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, seen = AnchorFinder(min_bytes, gram), set()
        for batch in batches:
            grams, keys, places, ends = [], [], [], []
            marks = np.where(_passing(bits.value, batch.column("hash").to_numpy()), -2, -1)
            for tkey, value, mark in zip(batch.column("tkey").to_pylist(), batch.column("text").to_pylist(), marks):
                if tkey in seen:  # a copy of a text this task has had
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(tkey)
                at, hashes, spans = finder(value.encode("utf-8", "surrogatepass"))
                grams.append(hashes.view(np.int64))
                places.append(at)
                ends.append(np.full(len(at), mark))
                if spans:
                    grams.append(np.zeros(len(spans), np.int64))
                    places.append(np.array([b for b, _ in spans]))
                    ends.append(np.array([e for _, e in spans]))
                keys += [tkey] * (len(at) + len(spans))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(grams)), pa.array(keys, pa.binary()),
                        pa.array(np.concatenate(places).astype(np.int64)), pa.array(np.concatenate(ends).astype(np.int64)),
                    ],
                    names=["gram", "tkey", "pos", "end"],
                )

    found = written(long_enough.select("tkey", "text", F.xxhash64("tkey").alias("hash")).mapInArrow(find, anchor_schema), "anchors")
    anchors = found.where("end < 0").select("gram", "tkey", "pos", "end")
    own = found.where("end >= 0").select("tkey", F.col("pos").alias("begin"), "end")
    # Grams that occur at two places; equal rows of copies are one place, which only
    # anchors of copies need to name. Reduced on the map side, and the join splits a gram
    # that many texts have.
    place = F.when(F.col("end") == -2, F.xxhash64("tkey", "pos"))
    places = anchors.groupBy("gram").agg(F.count_if(F.col("end") == -1).alias("n"), F.min(place).alias("a"), F.max(place).alias("b"))
    twice = places.where("n > 1 OR n = 1 AND a IS NOT NULL OR a <> b").select("gram")
    twice = written(twice, "repeated-grams")
    # Most grams occur once; their anchors need not move to meet the repeated ones.
    likely = _may_hold(twice.select(F.col("gram").alias("hash")))
    repeated = anchors.where(likely("gram")).join(twice, "gram")
    # A set per text, bounded by the text's length.
    marks = repeated.groupBy("tkey").agg(F.collect_set(F.struct("pos", "gram")).alias("marks"))
    selves = own.distinct().groupBy("tkey").agg(F.collect_list(F.struct("begin", "end")).alias("own"))
    marked = written(marks.join(selves, "tkey", "full"), "marked-texts")
    # One row per text that has either, and only those texts move; copies are reduced on
    # the map side.
    texts = long_enough.where(texts_in(marked)("tkey")).groupBy("tkey").agg(F.first("text").alias("text"))
    wanted = written(
        texts.join(marked, "tkey").select("tkey", F.col("text").cast("binary").alias("text"), "marks", "own"), "anchored-texts"
    )
    discard(found, twice, marked)

    def surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = min_bytes - gram
        for batch in batches:
            for tkey, value, marked in zip(*(batch.column(c).to_pylist() for c in ("tkey", "text", "marks"))):
                # A long text has many anchors: a batch of them at a time.
                for start in range(0, len(marked), 2000):
                    some = marked[start : start + 2000]
                    n, at = len(some), [m["pos"] for m in some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([m["gram"].to_bytes(8, "big", signed=True) for m in some], pa.binary()),
                            pa.array([tkey] * n, pa.binary()),
                            pa.array(at, pa.int64()),
                            pa.array([value[max(0, a - reach) : a] for a in at], pa.binary()),
                            pa.array([value[a : a + min_bytes] for a in at], pa.binary()),
                            pa.array(np.zeros(n, np.int32)),
                            pa.array(np.full(n, reach, np.int32)),
                        ],
                        names=["key", "tkey", "pos", "left", "right", "low", "high"],
                    )

    items = wanted.where("marks IS NOT NULL").select("tkey", "text", "marks").mapInArrow(surroundings, _ITEM)
    spans = written(_all_spans(items, min_bytes, group_anchors), "repeated-spans")
    listed = spans.groupBy("tkey").agg(F.collect_set(F.struct("begin", "end")).alias("shared"))
    empty = F.array().cast("array<struct<begin: bigint, end: bigint>>")
    both = F.concat(F.coalesce("own", empty), F.coalesce("shared", empty))
    runs = wanted.where("own IS NOT NULL").select("tkey", "own").join(listed, "tkey", "full").select("tkey", both.alias("spans"))
    copies = keyed.groupBy("tkey").agg(F.count(F.lit(1)).alias("copies"))
    documents = (
        keyed.select("doc_id", "tkey", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256"))
        .join(copies, "tkey", "left")
    )
    return documents, wanted.select("tkey", "text").join(runs, "tkey"), runs


def kept_bytes(
    texts: DataFrame, *, whole_characters: bool = False, min_words: int = 0, keep: tuple[str, ...] = ("tkey",)
) -> DataFrame:
    """``keep``, ``n_removed``, ``n_spans``, ``kept`` (the other bytes, joined) of ``texts``.

    With ``whole_characters`` spans shrink to the characters that lie inside them, so
    that what is kept is valid UTF-8. Merged spans of fewer than ``min_words`` words, or
    parts of words, stay. Null ``spans`` are none, and of a null text null is kept.
    """
    kinds = (pa.int64(), pa.int64(), pa.binary())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(*(batch.column(c).to_pylist() for c in ("text", "spans"))):
                if text is None:
                    rows.append((0, 0, None))
                    continue
                parts, at, removed, n = [], 0, 0, 0
                for begin, end in _merged([(s["begin"], s["end"]) for s in spans or ()]):
                    if whole_characters:
                        while begin < end and text[begin] & 0xC0 == 0x80:
                            begin += 1
                        while end > begin and end < len(text) and text[end] & 0xC0 == 0x80:
                            end -= 1
                    if end > begin and len(text[begin:end].split()) >= min_words:
                        parts.append(text[at:begin])
                        at, removed, n = end, removed + end - begin, n + 1
                rows.append((removed, n, b"".join([*parts, text[at:]])))
            if rows:
                made = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), *made], names=[*keep, "n_removed", "n_spans", "kept"]
                )

    kept = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in keep)
    return texts.mapInArrow(cut, f"{kept}, n_removed long, n_spans long, kept binary")


def remove_repeats(
    docs: DataFrame, *, min_bytes: int = MIN_BYTES, gram: int = GRAM_BYTES, group_anchors: int = GROUP_ANCHORS
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``: a row per document."""
    documents, texts, _ = repeats(docs, min_bytes=min_bytes, gram=gram, group_anchors=group_anchors)
    kept = kept_bytes(texts).select("tkey", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= min_bytes)
    zero = F.lit(0).cast("long")
    return documents.join(kept, "tkey", "left").select(
        "doc_id",
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(copied, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    )
