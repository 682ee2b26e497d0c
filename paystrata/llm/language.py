"""Language identification: known words first, then shorter and shorter n-grams.

Training counts every letter run of every training text per language, as a word
and by its character n-grams, exactly: one entry per distinct word or n-gram, so
the model grows with the vocabulary. A text's words are scored by their log
frequency in each language; a word never seen falls back to its longest character
n-grams that were.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import held_out

#: Lengths of the n-grams, whose tables follow the table of words.
ORDERS = (4, 3, 2, 1)
#: Characters looked at together; longer texts are cut, if possible between words.
SEGMENT = 1 << 19
UNKNOWN = "und"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordReader:
    """Finds and hashes the words and n-grams of many texts at once."""

    def __init__(self) -> None:
        self.letters = np.array([chr(c).isalpha() for c in range(0x110000)])
        self.powers = np.cumprod(np.full(SEGMENT + 2, _BASE))
        self.inverse = np.cumprod(np.full(SEGMENT + 2, _UNBASE))

    def segments(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(code points, number of the text of each), a segment's worth at a time."""
        parts, owners, size = [], [], 0
        for owner, text in enumerate(texts):
            lower = (text or "").lower()
            at = 0
            while at < len(lower):
                end = min(len(lower), at + SEGMENT - 1)
                if end < len(lower):
                    blank = max(lower.rfind(" ", at + 1, end), lower.rfind("\n", at + 1, end))
                    end = blank if blank > at else end
                if size + end - at + 1 > SEGMENT:
                    yield self._joined(parts, owners)
                    parts, owners, size = [], [], 0
                parts.append(lower[at:end] + " ")
                owners.append(owner)
                size += end - at + 1
                at = end
        if parts:
            yield self._joined(parts, owners)

    @staticmethod
    def _joined(parts: list[str], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        return codes, np.repeat(owners, [len(p) for p in parts])

    def words(self, codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
        """(start, end, owner, hash) of every letter run, and the letters' hashes."""
        letter = self.letters[codes]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], letter.astype(np.int8), [0]])))
        start, end = edge[::2], edge[1::2]
        mixed = _mixed(codes.astype(np.uint64) + np.uint64(1))
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed * self.powers[: len(codes)])])
        hashes = _mixed((total[end] - total[start]) * self.inverse[start])
        return start, end, owner[start], hashes, np.where(letter, mixed, np.uint64(0))

    @staticmethod
    def grams(mixed: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, hash) of the n-grams that consist of letters."""
        n = len(mixed) - order + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        value, inside = np.full(n, np.uint64(order)), np.ones(n, bool)
        for k in range(order):
            piece = mixed[k : k + n]
            value = value * _BASE + piece
            inside &= piece != 0
        place = np.flatnonzero(inside)
        return place, _mixed(value[place])


def _summed(language: np.ndarray, key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each (key, language) once, in this order, its sum, and where one of it was."""
    order = np.lexsort((language, key))
    language, key = language[order], key[order]
    new = np.ones(len(order), bool)
    new[1:] = (key[1:] != key[:-1]) | (language[1:] != language[:-1])
    at = np.flatnonzero(new)
    sums = np.add.reduceat(n[order], at) if len(at) else n[:0]
    return language[at], key[at], sums, order[at]


class Table:
    """Counts of a table's keys: a key's languages and counts are neighbours."""

    def __init__(self, languages: int, language: np.ndarray, key: np.ndarray, n: np.ndarray) -> None:
        """From entries in order of key and language, each pair once."""
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        starts = np.flatnonzero(new)
        self.keys, self.first = key[starts], np.append(starts, len(key))
        self.language = language
        # log((n + 0.1) / (total + 0.1 * keys)) is a part of the language and one of the entry.
        total = np.bincount(language, n, languages)
        self.base = np.log(0.1 / (total + 0.1 * max(1, len(starts))))
        self.gain = np.log1p(10.0 * n).astype(np.float32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each hash's place among the keys, and whether it is one of them."""
        if not len(self.keys):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        # Ordered, so that neighbours in a large table are looked up together.
        some, back = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        return at[back], (self.keys[at] == some)[back]

    def logs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log frequencies (language x distinct key) of the keys, and the column of each."""
        some, back = np.unique(at, return_inverse=True)
        size = self.first[some + 1] - self.first[some]
        column = np.repeat(np.arange(len(some)), size)
        entry = np.arange(len(column)) + np.repeat(self.first[some] - (np.cumsum(size) - size), size)
        out = np.repeat(self.base[:, None], len(some), 1)
        out[self.language[entry], column] += self.gain[entry]
        return out, back


@dataclass(frozen=True)
class LanguageModel:
    """Counts per language of all words, then of all n-grams of each order."""

    languages: tuple[str, ...]
    #: Per table (language, key, count), in order of key and language.
    entries: tuple[tuple[np.ndarray, np.ndarray, np.ndarray], ...]

    def tables(self) -> list[Table]:
        return [Table(len(self.languages), *entries) for entries in self.entries]


def _count_words(number: dict[str, int]):
    """Task function: (language, hash, word, n) of the words of a segment of texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = WordReader()
        for batch in batches:
            speech = np.array([number[x] for x in batch["lang"]], np.int32)
            for codes, owner in reader.segments(batch["text"].tolist()):
                start, end, of, hashes, _ = reader.words(codes, owner)
                language, key, n, at = _summed(speech[of], hashes, np.ones(len(of), np.int64))
                text = codes.tobytes().decode("utf-32-le", "surrogatepass")
                words = [text[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())]
                yield pd.DataFrame({"language": language, "hash": key.view(np.int64), "word": words, "n": n})

    return count


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Task function: (table, language, hash, n) of counted words and their n-grams."""
    reader = WordReader()

    def frame(table: int, language: np.ndarray, key: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        language, key, n, _ = _summed(language, key, n)
        return pd.DataFrame({"table": np.int32(table), "language": language, "hash": key.view(np.int64), "n": n})

    for batch in batches:
        speech, n = batch["language"].to_numpy(np.int32), batch["n"].to_numpy(np.int64)
        yield frame(0, speech, batch["hash"].to_numpy(np.int64).view(np.uint64), n)
        for codes, owner in reader.segments(batch["word"].tolist()):
            *_, mixed = reader.words(codes, owner)
            for table, order in enumerate(ORDERS, 1):
                place, gram = reader.grams(mixed, order)
                of = owner[place]
                yield frame(table, speech[of], gram, n[of])


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Task function: the entries of each table as arrays."""
    for batch in batches:
        for table, rows in batch.groupby("table"):
            yield pd.DataFrame(
                {
                    "table": [table],
                    "language": [rows["language"].to_numpy("<i4").tobytes()],
                    "hash": [rows["hash"].to_numpy("<i8").tobytes()],
                    "n": [rows["n"].to_numpy("<i8").tobytes()],
                }
            )


def train(docs: DataFrame) -> LanguageModel:
    """Count all training texts: ``lang`` given and not held out by ``doc_id``.

    Words are counted by grouping, reduced before they are sent; n-grams lie
    within words, so they are counted from the distinct words. The driver gets 20
    bytes per distinct word or n-gram and language it occurs in.
    """
    given = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select("text", "lang")
    # One record per language; the tables' size is a multiple of their number.
    languages = tuple(sorted(r.lang for r in given.select("lang").distinct().collect()))
    number = {name: n for n, name in enumerate(languages)}
    words = (
        given.mapInPandas(_count_words(number), "language int, hash long, word string, n long")
        .groupBy("language", "hash", "word").agg(F.sum("n").alias("n"))
    )
    counted = (
        words.mapInPandas(_count_grams, "table int, language int, hash long, n long")
        .groupBy("table", "language", "hash").agg(F.sum("n").alias("n"))
    )
    rows = counted.mapInPandas(_packed, "table int, language binary, hash binary, n binary").collect()
    entries = []
    for table in range(len(ORDERS) + 1):
        mine = [r for r in rows if r.table == table]
        language, key, n = (
            np.frombuffer(b"".join(getattr(r, name) for r in mine), kind)
            for name, kind in (("language", "<i4"), ("hash", "<u8"), ("n", "<i8"))
        )
        entries.append(_summed(language, key, n)[:3])
    return LanguageModel(languages, tuple(entries))


class Scorer:
    """Applies a model to texts."""

    def __init__(self, model: LanguageModel) -> None:
        self.reader = WordReader()
        self.model = model
        self.words, *self.grams = model.tables()

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood per text and language, and each text's number of words."""
        totals, words = np.zeros((len(texts), len(self.model.languages))), np.zeros(len(texts))
        for codes, owner in self.reader.segments(texts):
            start, end, of, hashes, mixed = self.reader.words(codes, owner)
            at, seen = self.words.find(hashes)
            words += np.bincount(of, minlength=len(texts))
            logs, column = self.words.logs(at[seen])
            for n in range(len(logs)):
                totals[:, n] += np.bincount(of[seen], logs[n, column], len(texts))
            self._back_off(totals, start[~seen], end[~seen], of[~seen], mixed)
        return totals, words

    def _back_off(self, totals: np.ndarray, start: np.ndarray, end: np.ndarray, of: np.ndarray, mixed: np.ndarray) -> None:
        """Unseen words: the average log frequency of their longest known n-grams."""
        if not start.size:
            return
        place = np.repeat(start, end - start) + np.arange((end - start).sum()) - np.repeat(np.cumsum(end - start) - (end - start), end - start)
        mine = np.zeros(len(mixed), np.uint64)
        mine[place] = mixed[place]
        word = np.zeros(len(mixed), np.int64)
        word[place] = np.repeat(np.arange(len(start)), end - start)
        open_ = np.ones(len(start), bool)
        for table, order in zip(self.grams, ORDERS):
            at, gram = self.reader.grams(mine, order)
            use = open_[word[at]]
            at, gram = at[use], gram[use]
            cell, known = table.find(gram)
            at, cell = at[known], cell[known]
            found = np.bincount(word[at], minlength=len(start))
            hit = found > 0
            if hit.any():
                logs, column = table.logs(cell)
                for n in range(len(logs)):
                    mean = np.bincount(word[at], logs[n, column], len(start))[hit] / found[hit]
                    totals[:, n] += np.bincount(of[hit], mean, len(totals))
            open_ &= ~hit


def predict(docs: DataFrame, model: LanguageModel, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` (probability, 0 to 1).

    ``und`` with score 0 if the text is null or has no letter, or if there was
    nothing to learn from. Languages that tie: the first in code point order.
    Rows are independent; repeated rows get equal predictions.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.entries))

    @F.pandas_udf("lang_pred string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(LanguageModel(*shared.value))
        names = np.array([*scorer.model.languages, UNKNOWN], object)
        for texts in batches:
            totals, words = scorer(texts.tolist())
            if totals.shape[1] == 0:
                yield pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0})
                continue
            best = totals.argmax(1) if len(totals) else np.zeros(0, int)
            odds = np.exp(totals - totals.max(1, keepdims=True)) if len(totals) else totals
            share = odds.max(1) / odds.sum(1) if len(totals) else np.zeros(0)
            some = words > 0
            yield pd.DataFrame(
                {"lang_pred": names[np.where(some, best, len(names) - 1)], "score": np.where(some, share, 0.0)}
            )

    return docs.select(*keep, guess(F.col("text")).alias("_guess")).select(*keep, "_guess.*")
