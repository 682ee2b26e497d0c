"""Classifier and language identification: held-out accuracy and edge cases."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paystrata.llm import language, quality
from paystrata.llm.common import held_out
from paystrata.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(llm):
    return {name: llm.read.parquet(f"{MIDDLE}/{name}.parquet") for name in ("documents", "labels")}


def test_quality_on_held_out_documents(llm, tables):
    scored = QUERIES["op2_quality"](llm, MIDDLE)
    assert scored.count() == tables["documents"].count()
    rows = scored.join(tables["labels"], "doc_id").where("held_out").select("predicted", "quality", "score").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_quality_ignores_everything_but_the_text(llm, tables, clash):
    machine = quality.train(tables["documents"], tables["labels"])
    rows = [(1, "a b c", "x"), (1, "a b c", None), (None, "a b c", "z"), (2, None, "x"), (3, "", "y"), (4, "w " * 200_000, "x")]
    found = quality.score_documents(clash(llm.createDataFrame(rows, "doc_id long, text string, lang string")), machine).collect()
    assert len({r.score for r in found[:3]}) == 1 and found[3].score == found[4].score
    assert all(0 <= r.score <= 1 for r in found)


def test_quality_without_labels_or_documents(llm, tables):
    machine = quality.train(tables["documents"], tables["labels"].limit(0))
    assert {r.score for r in quality.score_documents(tables["documents"].limit(5), machine).collect()} == {0.5}
    assert quality.score_documents(tables["documents"].limit(0), machine).count() == 0
    odd = llm.createDataFrame([(None, 1), (0, None), (3, 1), (3, 0)], "doc_id long, quality int")
    assert quality.train(tables["documents"], odd) is not None


def test_pair_sums_equal_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    machine = quality.Machine(0.3, rng.normal(size=quality.DIMS), rng.normal(size=(quality.DIMS, 8)), np.zeros(15), np.ones(15))
    index, values = rng.choice(quality.DIMS, 20, replace=False), rng.normal(size=20)
    raw = quality._margins(machine, index, values, np.array([0]))[0][0]
    want = 0.3 + machine.linear[index] @ values
    for a in range(20):
        for b in range(a):
            want += machine.factors[index[a]] @ machine.factors[index[b]] * values[a] * values[b]
    assert raw == pytest.approx(want)


def test_language_on_held_out_documents(llm, tables):
    found = QUERIES["op6_language"](llm, MIDDLE)
    assert found.count() == tables["documents"].count()
    rows = found.where("held_out").join(tables["documents"].select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_backs_off_and_handles_odd_texts(llm, clash):
    train = [(k, t, lang) for k in range(8) for t, lang in (("the house and garden", "en"), ("das haus und garten", "de"))]
    train += [(100, None, "en"), (101, "nothing", None), (None, "the", "en")]
    docs = clash(llm.createDataFrame(train, "doc_id long, text string, lang string"))
    model = language.train(docs)
    assert model.languages == ("de", "en")
    texts = ["the", "HAUS", "hauses", None, "", "123 !?", "the " * 400_000, "und" + "x" * 1_100_000]
    found = language.predict(llm.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string"), model)
    got = [r.lang_pred for r in found.orderBy("doc_id").collect()]
    assert got[:7] == ["en", "de", "de", "und", "und", "und", "en"]


def test_language_without_training_texts(llm):
    docs = llm.createDataFrame([(1, "a word", None)], "doc_id long, text string, lang string")
    model = language.train(docs)
    assert [(r.lang_pred, r.score) for r in language.predict(docs, model).collect()] == [("und", 0.0)]
    assert language.predict(docs.limit(0), model).count() == 0


def test_hashes_of_words_do_not_depend_on_their_place():
    reader = language.WordReader()
    codes, owner = reader._joined(["word other word ", "x word "], [0, 1])
    start, end, of, hashes, _ = reader.words(codes, owner)
    names = ["".join(map(chr, codes[a:b])) for a, b in zip(start, end)]
    assert names == ["word", "other", "word", "x", "word"] and of.tolist() == [0, 0, 0, 1, 1]
    assert hashes[0] == hashes[2] == hashes[4] != hashes[1]


def test_words_and_grams_are_counted_exactly(llm):
    texts = [("ab abc ab", "x"), ("ab bca", "y"), ("abc", "x")]
    model = language.train(llm.createDataFrame([(10, *t) for t in texts], "doc_id long, text string, lang string"))
    want = [Counter() for _ in range(5)]
    for text, lang in texts:
        for word in text.split():
            want[0][word, lang] += 1
            for table, order in enumerate(language.ORDERS, 1):
                for at in range(len(word) - order + 1):
                    want[table][word[at : at + order], lang] += 1
    for (speech, key, n), counts in zip(model.entries, want):
        assert sorted(n.tolist()) == sorted(counts.values()) and len(set(key.tolist())) == len({k for k, _ in counts})
        assert np.bincount(speech, n, 2).tolist() == [sum(c for (_, lang), c in counts.items() if lang == x) for x in "xy"]


def test_an_unseen_word_is_never_taken_for_a_seen_one(llm):
    # Words of a-m are English, of n-z German; the probes are German words that
    # share their hash's low 18 bits and five more with an English word.
    rng, reader = np.random.default_rng(3), language.WordReader()

    def words(first, n):
        return ["".join(chr(first + c) for c in row) for row in rng.integers(0, 13, (n, 8))]

    def marks(some):
        hashes = reader.words(*reader._joined([" ".join(some) + " "], [0]))[3]
        return list(zip((hashes % np.uint64(1 << 18)).tolist(), ((hashes >> np.uint64(40)) % np.uint64(32)).tolist()))

    english, german, others = words(97, 2000), words(110, 2000), words(110, 40_000)
    taken, known = set(marks(english)), set(german)
    probes = [w for w, m in zip(others, marks(others)) if m in taken and w not in known]
    assert len(probes) >= 3
    model = language.train(
        llm.createDataFrame([(10, " ".join(english), "en"), (10, " ".join(german), "de")], "doc_id long, text string, lang string")
    )
    found = language.predict(llm.createDataFrame(list(enumerate(probes)), "doc_id long, text string"), model)
    assert {r.lang_pred for r in found.collect()} == {"de"}


def test_held_out_rule(llm):
    ids = [*range(50), -3, None]
    found = llm.createDataFrame([(i,) for i in ids], "i long").select(held_out(F.col("i")).alias("h")).collect()
    assert [r.h for r in found] == [i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in ids]
