"""Quality classifier: a factorisation machine over hashed words and structure.

Every document becomes a sparse vector of hashed words, standardised structure
statistics and length classes. The machine adds to a linear model the inner
products of low-rank factors for all pairs of features; the sum-of-squares
identity gives them in time linear in the features:

    sum over pairs <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import held_out

#: Labelled rows the model is fitted on, at most (those with the smallest hashes).
TRAIN_ROWS = 12_000
#: Scores from here on count as good.
THRESHOLD = 0.7

_WORD_DIMS = 1 << 15
_LENGTH_CLASSES = 24
_FACTORS = 8
_UPPER, _LOWER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"!#$%&*|@^~<>{}[]=+\\/_`")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:?")] = True


def _structure(data: bytes, words: Counter, n_words: int) -> list[float]:
    """Shares and averages that describe a text's form."""
    bytes_by_value = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n_bytes = max(1, len(data))
    letters = max(1, int(bytes_by_value[_UPPER].sum() + bytes_by_value[_LOWER].sum()))
    lines = data.split(b"\n")
    n = max(1, n_words)
    return [
        np.log1p(n_words),
        len(data) / n,
        bytes_by_value[_UPPER].sum() / letters,
        bytes_by_value[_DIGIT].sum() / n_bytes,
        bytes_by_value[_SYMBOL].sum() / n,
        bytes_by_value[_STOP].sum() / n,
        bytes_by_value[128:].sum() / n_bytes,
        bytes_by_value[32] / n_bytes,
        len(words) / n,
        len(words) / np.sqrt(n),
        max(words.values(), default=0) / n,
        sum(1 for c in words.values() if c == 1) / max(1, len(words)),
        np.log1p(len(lines)),
        1 - len(set(lines)) / len(lines),
        max(map(len, lines)) / n_bytes,
    ]


_STRUCTURE = 15
DIMS = _WORD_DIMS + _LENGTH_CLASSES + _STRUCTURE


class Featurizer:
    """Turns a text into (feature numbers, values); structure stays unscaled."""

    def __init__(self) -> None:
        self.places: dict[str, int] = {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        text = text or ""
        tokens = text.lower().split()
        words = Counter(tokens)
        if len(self.places) > 200_000:  # bounds the worker's memory
            self.places.clear()
        places = self.places
        index = []
        for word in words:
            place = places.get(word)
            if place is None:
                place = places[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % _WORD_DIMS
            index.append(place)
        counts = 1 + np.log(np.fromiter(words.values(), float, len(words)))
        norm = np.sqrt((counts**2).sum()) or 1.0
        length_class = _WORD_DIMS + min(_LENGTH_CLASSES - 1, len(tokens).bit_length())
        form = _structure(text.encode("utf-8", "surrogatepass"), words, len(tokens))
        return (
            np.concatenate([index, [length_class], np.arange(DIMS - _STRUCTURE, DIMS)]).astype(np.int32),
            np.concatenate([counts / norm, [1.0], form]).astype(np.float32),
        )


@dataclass(frozen=True)
class Machine:
    """A fitted machine: bias, linear weights, factors, the scale of the structure, rows learned from."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    n_rows: int = 0

    def scaled(self, values: np.ndarray) -> np.ndarray:
        out = values.astype(np.float64)
        out[-_STRUCTURE:] = np.clip((out[-_STRUCTURE:] - self.mean) / self.spread, -4, 4) / 4
        return out

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Probability of label 1, in time linear in the features."""
        if not rows:
            return np.zeros(0)
        index = np.concatenate([i for i, _ in rows])
        values = np.concatenate([self.scaled(v) for _, v in rows])
        starts = np.cumsum([0, *(len(i) for i, _ in rows[:-1])])
        return 1 / (1 + np.exp(-np.clip(_margins(self, index, values, starts)[0], -30, 30)))


def _margins(m: Machine, index: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Raw scores, and for the gradient each row's factor sums and each feature's part."""
    parts = m.factors[index] * values[:, None]
    sums = np.add.reduceat(parts, starts)
    pairs = 0.5 * (sums**2 - np.add.reduceat(parts**2, starts)).sum(1)
    return m.bias + np.add.reduceat(m.linear[index] * values, starts) + pairs, sums, parts


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, epochs: int = 6, rate: float = 0.1, seed: int = 11) -> Machine:
    """Logistic loss, adaptive gradient steps over small batches, a fixed seed.

    Without rows, every score is 0.5.
    """
    rng = np.random.default_rng(seed)
    form = np.array([v[-_STRUCTURE:] for _, v in rows], np.float64).reshape(-1, _STRUCTURE)
    mean = form.mean(0) if len(form) else np.zeros(_STRUCTURE)
    spread = (form.std(0) if len(form) else np.ones(_STRUCTURE)) + 1e-6
    linear, factors = np.zeros(DIMS), rng.normal(0, 0.05, (DIMS, _FACTORS))
    if not rows:
        return Machine(0.0, linear, np.zeros_like(factors), mean, spread)
    bias, seen_b, seen_w, seen_v = 0.0, 1e-3, np.full(DIMS, 1e-3), np.full((DIMS, _FACTORS), 1e-3)
    scale = Machine(0.0, linear, factors, mean, spread)
    scaled = [(i, scale.scaled(v)) for i, v in rows]
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            batch = order[at : at + 64]
            index = np.concatenate([scaled[r][0] for r in batch])
            values = np.concatenate([scaled[r][1] for r in batch])
            sizes = np.array([len(scaled[r][0]) for r in batch])
            starts = np.cumsum(sizes) - sizes
            raw, sums, parts = _margins(Machine(bias, linear, factors, mean, spread), index, values, starts)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]) / len(batch)
            each = np.repeat(error, sizes)
            used, slot = np.unique(index, return_inverse=True)
            grad_w = np.bincount(slot, each * values, len(used)) + 1e-6 * linear[used]
            flow = (each * values)[:, None] * (np.repeat(sums, sizes, axis=0) - parts)
            grad_v = np.stack([np.bincount(slot, flow[:, f], len(used)) for f in range(_FACTORS)], 1)
            grad_v += 1e-6 * factors[used]
            seen_b += error.sum() ** 2
            seen_w[used] += grad_w**2
            seen_v[used] += grad_v**2
            bias -= rate * error.sum() / np.sqrt(seen_b)
            linear[used] -= rate * grad_w / np.sqrt(seen_w[used])
            factors[used] -= rate * grad_v / np.sqrt(seen_v[used])
    return Machine(float(bias), linear, factors, mean, spread, len(rows))


def train(docs: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS) -> Machine:
    """Fit on at most ``rows`` labelled documents that are not held out.

    The sample is the labelled ids with the smallest hashes; an id labelled more
    than once counts as good only if all its labels say so; null ids and labels
    are left out. Texts become features on the executors; the driver gets those of
    the sample only.
    """
    sample = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # ``rows`` bounds the sample, so it may be broadcast.
    labelled = (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.min("quality").alias("quality"))
    )

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        featurize = Featurizer()
        for batch in batches:
            found = [featurize(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "quality": batch["quality"],
                    "index": [i.tobytes() for i, _ in found],
                    "values": [v.tobytes() for _, v in found],
                }
            )

    found = labelled.mapInPandas(features, "doc_id long, quality int, index binary, values binary").toPandas()
    found = found.sort_values("doc_id")
    vectors = [
        (np.frombuffer(i, np.int32), np.frombuffer(v, np.float32)) for i, v in zip(found["index"], found["values"])
    ]
    return fit(vectors, found["quality"].to_numpy(np.float64))


def score_documents(docs: DataFrame, machine: Machine, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score``, the probability that a whole text is good.

    Null and empty texts are scored by their (empty) features. Rows are
    independent: repeated rows get equal scores, an empty table stays empty.
    The machine has a fixed size (about 2 MB) whatever the data.
    """
    m = machine
    fitted = docs.sparkSession.sparkContext.broadcast((m.bias, m.linear, m.factors, m.mean, m.spread))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        featurize, model = Featurizer(), Machine(*fitted.value)
        for texts in batches:
            yield pd.Series(model.score([featurize(t) for t in texts]), dtype="float64")

    return docs.select(*keep, score(F.col("text")).alias("score"))
