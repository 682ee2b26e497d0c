"""Toxicity: a convolutional text classifier over hashed word embeddings.

Every word has the sum of three rows of one embedding table, chosen by hashes of the word
and of its first four and six letters, so that inflected words share what their stems
have learned, and words that share one row by chance are still told apart. Filters over one, two and
three neighbouring words are applied at every place of the whole text, each filter keeps
its largest response (max pooling), and a logistic layer turns the responses into the
probability of label 1. Everything is trained here, in numpy, by adaptive gradient
steps; through the maxima only the winning places receive gradients.

All labelled rows are learned from: they are dealt to shards by a hash of the id, the
first shard gives a model to start from, then in every pass tasks train copies of the
model on all shards, and what the copies have learned is averaged.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paystrata.llm.common import written

#: About how many labelled rows, and characters of their texts, a shard has. There are
#: as many shards as all rows need; one is held by a task at a time.
SHARD_ROWS, SHARD_CHARS = 4_096, 16_000_000
#: Passes over all shards after the first shard has been fitted.
PASSES = 2
#: Tasks that shards are dealt to in a pass, at least; two per core, if those are more.
LEAST_TASKS = 12
#: Of a shard's rows, in order of their ids, every fifth sets the thresholds and fits nothing.
CALIBRATION = 5
#: Thresholds are told apart to this part of a score.
SCORE_STEPS = 10_000
#: What copies have learned is added up in whole numbers of this unit, so that the sum
#: does not depend on the order in which tasks end.
_UNIT = 2.0**-32
#: Bits of the table that tells which ids may have a label.
FILTER_BITS = 1 << 26
#: Scores from here on count as toxic where no language is known.
THRESHOLD = 0.5
#: A language with fewer toxic calibration rows takes the threshold of all languages.
LEAST_TOXIC = 5

ROW_BITS, DIMS = 17, 16
ROWS = 1 << ROW_BITS
#: Letters of a word that choose its rows; None: all.
STEMS = (None, 4, 6)
WIDTHS, FILTERS = (1, 2, 3), 16
_PAD = ROWS  # a row of zeros after the table
_WORD = re.compile(r"\w+")
#: Words whose responses are held at once.
_STRETCH = 8192


def in_fold(doc_id: Column, modulus: int = 5, remainder: int = 0) -> Column:
    """Rows whose CRC-32 of the id as text leaves ``remainder``; a null id is none."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


class Words:
    """Words of a text as their rows of the table."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        """One number per word: its rows, packed."""
        words = _WORD.findall((text or "").lower())
        if len(self.known) > 200_000:  # bounds the worker's memory
            self.known.clear()
        known, out = self.known, []
        for word in words:
            rows = known.get(word)
            if rows is None:
                rows = 0
                for seed, letters in enumerate(STEMS):
                    part = word[:letters].encode("utf-8", "surrogatepass")
                    rows = rows << ROW_BITS | xxhash.xxh64_intdigest(part, seed) % ROWS
                known[word] = rows
            out.append(rows)
        return np.array(out, np.int64)


def _rows(words: np.ndarray) -> np.ndarray:
    """Table rows of every word, and padding so that each word begins a window."""
    n = max(len(words) + max(WIDTHS) - 1, max(WIDTHS))
    out = np.full((n, len(STEMS)), _PAD, np.int32)
    for at in range(len(STEMS)):
        out[: len(words), at] = words >> ROW_BITS * at & (ROWS - 1)
    return out


def _vectors(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = table[rows[..., 0]]
    for at in range(1, len(STEMS)):
        out += table[rows[..., at]]
    return out


@dataclass
class Network:
    """Embedding table, per width the filters' weights (place, dimension, filter), the logistic layer."""

    table: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = THRESHOLD
    n_rows: int = 0
    #: Sums of squared gradients, in the order of ``arrays``; a fit that goes on needs them.
    seen: list[np.ndarray] = field(default_factory=list)

    def arrays(self) -> list[np.ndarray]:
        return [self.table, self.bias, self.weights, *self.filters, np.array([self.offset])]

    def responses(self, vectors: np.ndarray) -> np.ndarray:
        """Responses of all filters where each window begins; the last rows begin none."""
        n = len(vectors) - max(WIDTHS) + 1
        out = np.empty((n, len(WIDTHS) * FILTERS), np.float32)
        for g, (width, weights) in enumerate(zip(WIDTHS, self.filters)):
            part = out[:, g * FILTERS : (g + 1) * FILTERS]
            part[:] = vectors[:n] @ weights[0]
            for place in range(1, width):
                part += vectors[place : place + n] @ weights[place]
        return out

    def pooled(self, words: np.ndarray) -> np.ndarray:
        """Each filter's largest response in the whole text, stretch by stretch."""
        rows = _rows(words)
        best = np.full(len(WIDTHS) * FILTERS, -np.inf, np.float32)
        for a in range(0, max(1, len(words)), _STRETCH):
            part = rows[a : a + _STRETCH + max(WIDTHS) - 1]
            np.maximum(best, self.responses(_vectors(self.table, part)).max(0), out=best)
        return best

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        hidden = np.maximum(0, np.stack([self.pooled(words) for words in texts]) + self.bias)
        return 1 / (1 + np.exp(-np.clip(hidden.astype(np.float64) @ self.weights + self.offset, -30, 30)))


def _start(seed: int) -> tuple[Network, np.random.Generator]:
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.2, (ROWS + 1, DIMS)).astype(np.float32)
    table[_PAD] = 0
    filters = [rng.normal(0, 0.5 / np.sqrt(w), (w, DIMS, FILTERS)).astype(np.float32) for w in WIDTHS]
    n = len(WIDTHS) * FILTERS
    return Network(table, filters, np.zeros(n, np.float32), rng.normal(0, 0.2, n), 0.0), rng


class _Steps:
    """Adaptive gradient steps for one array; rows are updated where they were used."""

    def __init__(self, values: np.ndarray, rate: float, seen: np.ndarray | None = None) -> None:
        self.values, self.rate = values, rate
        self.seen = np.full(values.shape, 1e-2, values.dtype) if seen is None else seen.copy()

    def __call__(self, gradient: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        self.seen[rows] += gradient**2
        self.values[rows] -= self.rate * gradient / np.sqrt(self.seen[rows])


def fit(
    texts: list[np.ndarray], labels: np.ndarray, *, epochs: int = 4, rate: float = 0.15, batch: int = 32, seed: int = 13,
    start: Network | None = None, share: float | None = None,
) -> Network:
    """Logistic loss; labels count alike in sum (toxic rows weigh more where they are
    rarer, up to fourfold; ``share`` is that of toxic rows, if not of these alone).
    Without rows, every score is 0.5. ``start``, which stays as it is, is trained further."""
    if start is None:
        net, rng = _start(seed)
    else:
        rng = np.random.default_rng(seed)
        net = replace(
            start, table=start.table.copy(), bias=start.bias.copy(), weights=start.weights.copy(),
            filters=[f.copy() for f in start.filters],
        )
    net.n_rows = len(texts)
    if not texts:
        if start is None:
            net.weights[:] = 0
        return net
    share = min(max(labels.mean() if share is None else share, 1e-3), 1 - 1e-3)
    importance = np.where(labels > 0, min(4.0, max(1.0, (1 - share) / share)), 1.0)
    seen = net.seen or [None] * len(net.arrays())
    table, bias, weights = (_Steps(v, rate, s) for v, s in zip((net.table, net.bias, net.weights), seen))
    filters = [_Steps(f, rate, s) for f, s in zip(net.filters, seen[3:])]
    offset, seen_offset = np.full(1, net.offset), np.full(1, 1e-2) if seen[-1] is None else seen[-1].copy()
    rows = [_rows(words) for words in texts]
    group = np.repeat(np.arange(len(WIDTHS)), FILTERS)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            n_filters = len(group)
            best, where = np.empty((len(chosen), n_filters), np.float32), np.empty((len(chosen), n_filters), np.int64)
            for i, t in enumerate(chosen):
                found = net.responses(_vectors(net.table, rows[t]))
                where[i] = found.argmax(0)
                best[i] = found[where[i], np.arange(n_filters)]
            hidden = np.maximum(0, best + net.bias)
            raw = hidden @ net.weights + offset[0]
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]) * importance[chosen] / len(chosen)
            back = (error[:, None] * net.weights * (hidden > 0)).astype(np.float32)
            touched, flows = [], []
            for g, (width, step) in enumerate(zip(WIDTHS, filters)):
                part = slice(g * FILTERS, (g + 1) * FILTERS)
                gradient = np.zeros_like(step.values)
                for place in range(width):
                    used = np.stack([rows[t][where[i, part] + place] for i, t in enumerate(chosen)])
                    gradient[place] = np.einsum("tf,tfd->df", back[:, part], _vectors(net.table, used))
                    flow = back[:, part, None] * step.values[place].T
                    for side in range(len(STEMS)):
                        touched.append(used[..., side].reshape(-1))
                        flows.append(flow.reshape(-1, DIMS))
                step(gradient + 1e-5 * step.values)
            weights(hidden.T.astype(np.float64) @ error + 1e-4 * net.weights)
            bias(back.sum(0))
            seen_offset += error.sum() ** 2
            offset -= rate * error.sum() / np.sqrt(seen_offset)
            index, flow = np.concatenate(touched), np.concatenate(flows)
            live = (index != _PAD) & (np.abs(flow).max(1) > 0)
            if live.any():
                by_row = np.argsort(index[live], kind="stable")
                sorted_index = index[live][by_row]
                begins = np.flatnonzero(np.r_[True, sorted_index[1:] != sorted_index[:-1]])
                table(np.add.reduceat(flow[live][by_row], begins), sorted_index[begins])
    net.offset = float(offset[0])
    net.seen = [table.seen, bias.seen, weights.seen, *(f.seen for f in filters), seen_offset]
    return net


def best_threshold(
    scores: np.ndarray, labels: np.ndarray, default: float = THRESHOLD, times: np.ndarray | None = None
) -> float:
    """The threshold with the best F1, halfway to the next lower score; the default if
    one label is absent. Of equal ones, the one nearest the default. A score may stand
    for several rows (``times``)."""
    if not labels.any() or labels.all():
        return default
    times = np.ones(len(scores), np.int64) if times is None else times
    order = np.argsort(-scores, kind="stable")
    ranked, hits = scores[order], np.cumsum((labels * times)[order])
    last = np.r_[ranked[1:] != ranked[:-1], True]  # equal scores stand or fall together
    f1 = np.where(last, 2 * hits / (np.cumsum(times[order]) + hits[-1]), -1)
    edges = (ranked + np.r_[ranked[1:], 0]) / 2
    top = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(edges[top[np.argmin(np.abs(edges[top] - default))]])


@dataclass
class _Learned:
    """What copies of a model have learned beyond it, added up: per array the change of
    its values and of their squared gradients, and how many copies have changed a row."""

    sums: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def __getstate__(self) -> list[list[tuple[tuple[int, ...], bytes, bytes]]]:
        """Compressed, for the way between tasks: of each array the rows that are not
        zero, their first bytes first, since the high bytes of small numbers are alike."""

        def packed(values: np.ndarray) -> tuple[tuple[int, ...], bytes, bytes]:
            some = values.reshape(len(values), -1).any(1)
            planes = np.ascontiguousarray(values[some]).view(np.uint8).reshape(-1, values.itemsize).T
            return values.shape, zlib.compress(np.packbits(some).tobytes(), 1), zlib.compress(planes.tobytes(), 1)

        return [[packed(values) for values in one] for one in self.sums]

    def __setstate__(self, state: list[list[tuple[tuple[int, ...], bytes, bytes]]]) -> None:
        def unpacked(shape: tuple[int, ...], some: bytes, planes: bytes) -> np.ndarray:
            values = np.zeros(shape, np.int64)
            chosen = np.unpackbits(np.frombuffer(zlib.decompress(some), np.uint8), count=shape[0]).astype(bool)
            read = np.frombuffer(zlib.decompress(planes), np.uint8).reshape(values.itemsize, -1)
            values[chosen] = np.ascontiguousarray(read.T).view(np.int64).reshape(-1, *shape[1:])
            return values

        self.sums = [tuple(unpacked(*values) for values in one) for one in state]

    @classmethod
    def of(cls, net: Network, start: Network) -> _Learned:
        def units(new: np.ndarray, old: np.ndarray) -> np.ndarray:
            return np.rint((new.astype(np.float64) - old) / _UNIT).astype(np.int64)

        sums = []
        for new, old, seen, before in zip(net.arrays(), start.arrays(), net.seen, start.seen):
            moved = units(seen, before)
            changed = (moved.reshape(len(moved), -1) > 0).any(1).astype(np.int64)
            sums.append((units(new, old), moved, changed))
        return cls(sums)

    def __add__(self, other: _Learned) -> _Learned:
        return _Learned([tuple(a + b for a, b in zip(x, y)) for x, y in zip(self.sums, other.sums)])

    def onto(self, start: Network) -> Network:
        """``start`` with the mean change of each row, over the copies that have changed it."""
        values, seen = [], []
        for old, before, (change, moved, changed) in zip(start.arrays(), start.seen, self.sums):
            copies = np.maximum(changed, 1).reshape(-1, *[1] * (old.ndim - 1))
            values.append((old + change * _UNIT / copies).astype(old.dtype))
            seen.append((before + moved * _UNIT / copies).astype(before.dtype))
        table, bias, weights, *filters, offset = values
        return replace(start, table=table, bias=bias, weights=weights, filters=filters, offset=float(offset[0]), seen=seen)


def _likely(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``docs`` without most rows whose id is not among ``chosen``: no text without a label need move.

    A bit is set for the hash of each chosen id. The bitmap has ``FILTER_BITS`` bits
    (8 MB) whatever the data, so it may be broadcast; the more ids share a bit, the more
    rows pass that are dropped where they meet the labels.
    """
    bit = F.xxhash64(F.col("doc_id").cast("string")).bitwiseAND(F.lit(FILTER_BITS - 1))
    part, position = F.shiftright(bit, 15).cast("int"), bit.bitwiseAND(F.lit((1 << 15) - 1)).cast("int")
    bitmap = chosen.groupBy(part.alias("part")).agg(F.bitmap_construct_agg(position).alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.col("position") / 8 + 1, 1)), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.pow(F.lit(2), F.col("position") % 8).cast("int")) > 0
    return docs.withColumns({"part": part, "position": position}).join(F.broadcast(bitmap), "part").where(is_set)


def _shards(docs: DataFrame, labels: DataFrame, rows: int | None, words: int | None) -> tuple[DataFrame, int]:
    """``shard``, ``docs`` (id, text, language and label of its rows to learn from, by id),
    and how many shards all rows need. Texts move once, to their shard, and meet their
    labels there."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~in_fold(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    if rows is not None:
        chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", text.alias("text"), "lang").where(~in_fold(F.col("doc_id")))  # held-out texts need not move
    sizes = docs.select("doc_id", F.length("text").alias("chars")).join(chosen, "doc_id")
    size = sizes.agg(F.count(F.lit(1)).alias("rows"), F.sum("chars").alias("chars")).first()
    n_shards = max(1, -(-size.rows // SHARD_ROWS), -(-(size.chars or 0) // SHARD_CHARS))
    shard = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(n_shards)).cast("int").alias("shard")
    found = (
        _likely(docs, chosen)
        .select("doc_id", F.struct("text", "lang").alias("least"))
        .unionByName(chosen, allowMissingColumns=True)
        .repartition(shard)
        .groupBy(shard, "doc_id")
        .agg(F.min("least").alias("least"), F.max("toxic").alias("toxic"))
        .where("least IS NOT NULL AND toxic IS NOT NULL")
        .select("shard", "doc_id", "least.text", "least.lang", "toxic")
    )
    if words is not None:
        ahead = F.sum(F.regexp_count("text", F.lit(r"(?U)\w+"))).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
        found = found.withColumn("ahead", ahead).where(F.col("ahead") <= words)
    document = F.struct("doc_id", "text", "lang", "toxic")
    return found.groupBy("shard").agg(F.sort_array(F.collect_list(document)).alias("docs")), n_shards


def _texts(shard: Row, calibration: bool) -> tuple[list[np.ndarray], np.ndarray, list[str | None]]:
    """Words, labels and languages of a shard's rows that calibrate, or of those that fit."""
    read = Words()
    rows = [d for i, d in enumerate(shard.docs) if (i % CALIBRATION == CALIBRATION - 1) == calibration]
    return [read(d.text) for d in rows], np.array([d.toxic for d in rows], np.float64), [d.lang for d in rows]


def _more(learned: _Learned | None, shard: Row, start: Network, share: float, seed: int) -> _Learned | None:
    """``learned`` and what a copy of ``start`` learns from a shard. The copy and the
    shard's words are freed here, before the next shard is read."""
    texts, toxic, _ = _texts(shard, False)
    if not texts:
        return learned
    one = _Learned.of(fit(texts, toxic, epochs=1, seed=seed, start=start, share=share), start)
    return one if learned is None else learned + one


def train(docs: DataFrame, labels: DataFrame, *, rows: int | None = None, words: int | None = None) -> Network:
    """Fit on all labelled documents outside the held-out fold (runs jobs).

    An id labelled more than once is toxic if any label says so, of an id with several
    texts the smallest is read; null ids and labels are left out, null texts are empty.
    Texts stay on the executors: they are written once, a record per shard. A task reads
    a shard, trains a copy of the model on it and adds what the copy has learned to a sum
    of the model's size; the sums are reduced in a tree, so the driver gets that size
    whatever the data. The result depends on the rows alone, not on their layout.

    Every fifth row of a shard sets the thresholds, one per language with enough toxic
    rows, from counts of scores. ``rows`` and ``words`` bound what is learned from, by
    the smallest hashes of ids, if a caller wants less than all.
    """
    dealt, n_shards = _shards(docs, labels, rows, words)
    shards = written(dealt, "toxicity-shards")
    fits = F.filter("docs", lambda d, i: i % CALIBRATION != CALIBRATION - 1)
    fitted = shards.select(F.explode(fits).alias("doc"))
    total = fitted.agg(F.count(F.lit(1)).alias("rows"), F.avg("doc.toxic").alias("share")).first()
    if not total.rows:
        return fit([], np.zeros(0))
    context = docs.sparkSession.sparkContext
    share = total.share

    def begin(some: Iterable[Row]) -> Iterator[Network]:
        for shard in some:
            texts, toxic, _ = _texts(shard, False)
            if texts:
                yield fit(texts, toxic, share=share)

    first = shards.where(F.size(fits) > 0).agg(F.min("shard")).scalar()
    net = shards.where(F.col("shard") == first).rdd.mapPartitions(begin).collect()[0]
    for number in range(PASSES if n_shards > 1 else 0):
        start = context.broadcast(net)

        def learn(some: Iterable[Row], number: int = number, start=start) -> Iterator[_Learned]:
            learned = None
            for shard in some:
                learned = _more(learned, shard, start.value, share, 1 + number + PASSES * shard.shard)
            if learned is not None:
                yield learned

        # A sum per task, and tasks by the cores: more shards make no more sums.
        learned = shards.rdd.coalesce(max(LEAST_TASKS, 2 * context.defaultParallelism)).mapPartitions(learn)
        # So many levels that only a handful of sums reaches the driver.
        depth = max(2, math.ceil(math.log(learned.getNumPartitions() + 1, 4)))
        net = learned.treeReduce(lambda a, b: a + b, depth).onto(net)
        start.unpersist()
    net = replace(net, n_rows=total.rows, seen=[])
    _set_thresholds(net, shards)
    return net


def _set_thresholds(net: Network, shards: DataFrame) -> None:
    """The common threshold, and those of languages with enough toxic rows, from how
    often each score (rounded) occurs among the rows that calibrate."""
    shared = net.table, net.filters, net.bias, net.weights, net.offset
    shared = shards.sparkSession.sparkContext.broadcast(shared)

    def scores(some: Iterable[Row]) -> Iterator[tuple[str | None, int, int]]:
        model = Network(*shared.value)
        for shard in some:
            texts, toxic, langs = _texts(shard, True)
            for lang, score, label in zip(langs, model.score(texts), toxic):
                yield lang, round(float(score) * SCORE_STEPS), int(label > 0)

    rows = shards.rdd.mapPartitions(scores).toDF("lang string, step int, toxic int")
    # At most a record per language, label and step.
    counts = rows.groupBy("lang", "step", "toxic").count().toPandas()
    known, step, times = counts["toxic"].to_numpy() > 0, counts["step"].to_numpy() / SCORE_STEPS, counts["count"].to_numpy()
    langs = counts["lang"].to_numpy(object)
    net.threshold = best_threshold(step, known, times=times)
    for lang in sorted({x for x in langs if isinstance(x, str)}):
        of = langs == lang
        if times[of][known[of]].sum() >= LEAST_TOXIC:
            net.thresholds[lang] = best_threshold(step[of], known[of], net.threshold, times[of])


def score_documents(docs: DataFrame, net: Network, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``score`` (probability that the whole text is toxic) and
    ``flagged`` (1 if the score reaches the threshold of the document's language).

    Null, empty and wordless texts are scored as no words; very long texts are scored
    stretch by stretch, nothing is cut off. ``lang`` chooses the threshold only; null or
    unknown languages take the common one. Rows are independent: repeated rows get equal
    scores, an empty table stays empty, other columns are ignored. The model has a fixed
    size (8 MB) whatever the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (net.table, net.filters, net.bias, net.weights, net.offset)
    )

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        read, model = Words(), Network(*shared.value)
        for texts in batches:
            yield pd.Series(model.score([read(t) for t in texts]), dtype="float64")

    threshold = F.lit(net.threshold)
    for lang, least in net.thresholds.items():
        threshold = F.when(F.col("lang") == lang, F.lit(least)).otherwise(threshold)
    scored = docs.select(*keep, score(F.col("text")).alias("score"), threshold.alias("threshold"))
    return scored.withColumn("flagged", (F.col("score") >= F.col("threshold")).cast("int"))
