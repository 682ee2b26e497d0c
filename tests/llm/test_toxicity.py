from __future__ import annotations

import pickle
import random
import re
import zlib

import numpy as np
import pytest

from paystrata.llm import toxicity

DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, toxic int"
BAD = {"en": ["vile", "rotten", "scoundrel"], "de": ["schuftig", "schuftiger", "schuftigste"]}


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = {lang: ["".join(rng.choices("abcdefghij", k=5)) for _ in range(300)] for lang in BAD}
    rows = []
    for i in range(n):
        lang = "en" if i % 3 else "de"
        text = rng.choices(words[lang], k=rng.randint(5, 80))
        toxic = int(rng.random() < 0.25)
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(BAD[lang]))
        rows.append((i, " ".join(text), lang, toxic))
    return rows


@pytest.fixture(scope="module")
def trained(llm):
    rows = corpus(1500)
    docs = llm.createDataFrame([r[:3] for r in rows], DOCS)
    labels = llm.createDataFrame([(r[0], r[3]) for r in rows], LABELS)
    return rows, docs, labels, toxicity.train(docs, labels)


def test_held_out_accuracy_and_flags(trained):
    rows, docs, _, net = trained
    got = {r.doc_id: r for r in toxicity.score_documents(docs, net).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    right = [(got[r[0]].score >= 0.5) == bool(r[3]) for r in held]
    assert len(held) > 200 and np.mean(right) > 0.95
    assert np.mean([got[r[0]].flagged == r[3] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_thresholds_by_language(trained):
    net = trained[-1]
    assert set(net.thresholds) == {"en", "de"}
    assert all(0 < t < 1 for t in net.thresholds.values())


def test_held_out_labels_are_not_read(llm, trained):
    rows, docs, _, net = trained
    changed = [(r[0], 1 - r[3] if zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[3]) for r in rows]
    again = toxicity.train(docs, llm.createDataFrame(changed, LABELS))
    assert again.thresholds == net.thresholds and np.array_equal(again.table, net.table)


def test_score_depends_on_the_text_alone(llm, trained):
    net = trained[-1]
    rows = [(1, "a vile word", "en"), (2, "a vile word", None), (None, "a vile word", "xx"), (1, "a vile word", "en")]
    got = toxicity.score_documents(llm.createDataFrame(rows, DOCS), net).collect()
    assert len(got) == 4 and len({r.score for r in got}) == 1


def test_words_anywhere_in_very_long_texts_count(llm, trained):
    rows, _, _, net = trained
    clean = " ".join(r[1] for r in rows if not r[3] and r[2] == "en")
    long = (clean + " ") * 3
    assert len(long.split()) > 3 * toxicity._STRETCH
    docs = llm.createDataFrame([(1, long, "en"), (2, long + "vile", "en"), (3, "vile " + long, "en")], DOCS)
    score = {r.doc_id: r.score for r in toxicity.score_documents(docs, net).collect()}
    assert score[1] < 0.5 <= min(score[2], score[3])


def test_pooling_by_stretches_equals_pooling_at_once(trained, monkeypatch):
    rows, _, _, net = trained
    read = toxicity.Words()
    texts = [read(r[1]) for r in rows[:50]] + [read(""), read("one"), read("two words")]
    whole = net.score(texts)
    monkeypatch.setattr(toxicity, "_STRETCH", 4)
    assert np.allclose(net.score(texts), whole, atol=1e-6)


def test_responses_equal_a_plain_convolution(trained):
    net = trained[-1]
    words = toxicity.Words()("some vile words here and there")
    rows = toxicity._rows(words)
    vectors = np.array([sum(net.table[r] for r in row) for row in rows])
    for g, width in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            plain = max(
                sum(float(vectors[at + k] @ net.filters[g][k][:, f]) for k in range(width)) for at in range(len(words))
            )
            assert net.pooled(words)[g * toxicity.FILTERS + f] == pytest.approx(plain, abs=1e-4)


def test_gradients_lower_the_loss():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 1 << 51, rng.integers(0, 9)) for _ in range(60)]
    labels = (np.arange(60) % 2).astype(float)

    def loss(epochs):
        p = toxicity.fit(texts, labels, epochs=epochs).score(texts)
        return -np.mean(np.log(np.where(labels > 0, p, 1 - p)))

    assert loss(8) < loss(2) < loss(0)


def test_nothing_to_learn_from(llm, trained):
    docs, none = trained[1], llm.createDataFrame([], LABELS)
    for labels in (none, llm.createDataFrame([(None, 1), (1, None)], LABELS)):
        net = toxicity.train(docs, labels)
        assert net.n_rows == 0 and {r.score for r in toxicity.score_documents(docs.limit(5), net).collect()} == {0.5}
    empty = llm.createDataFrame([], DOCS)
    assert toxicity.score_documents(empty, toxicity.train(empty, trained[2])).collect() == []


def test_null_and_empty_texts_repeated_labels_and_extra_columns(llm, trained, clash):
    net = trained[-1]
    docs = clash(llm.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "?!", None)], DOCS)).selectExpr("*", "1 AS score", "2 AS threshold")
    scores = {r.score for r in toxicity.score_documents(docs, net).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() < 0.5
    rows = [(i, "vile text" if i % 2 else None, None) for i in range(60)]
    labels = llm.createDataFrame([(i, i % 2) for i in range(60)] + [(i, 0) for i in range(60)], LABELS)
    again = toxicity.train(clash(llm.createDataFrame(rows + rows, DOCS)), labels)
    assert 0 < again.n_rows <= 60


def test_bounds_of_the_sample(llm, trained):
    _, docs, labels, _ = trained
    assert toxicity.train(docs, labels, rows=100).n_rows == 80
    assert 0 < toxicity.train(docs, labels, words=2000).n_rows < 100


def test_best_threshold():
    scores, labels = np.array([0.9, 0.8, 0.3, 0.2]), np.array([True, True, False, False])
    assert toxicity.best_threshold(scores, labels) == pytest.approx(0.55)
    assert toxicity.best_threshold(scores, np.array([True] * 4)) == 0.5
    assert 0.2 < toxicity.best_threshold(scores, np.array([True, False, True, False])) < 0.3


def test_all_labelled_rows_are_learned_from(llm):
    rng = random.Random(5)
    draw = lambda: "".join(rng.choices("klmnopqrstuv", k=8))
    common, bad = [draw() for _ in range(200)], [draw() for _ in range(60)]
    rows = []
    for i in range(14_000):
        text = rng.choices(common, k=4)
        if toxic := i % 4 == 0:
            text[rng.randrange(4)] = bad[i * len(bad) // 14_000]  # every word in its stretch of ids
        rows.append((i, " ".join(text), "en", int(toxic)))
    net = toxicity.train(llm.createDataFrame([r[:3] for r in rows], DOCS), llm.createDataFrame([(r[0], r[3]) for r in rows], LABELS))
    fold = sum(zlib.crc32(str(r[0]).encode()) % 5 != 0 for r in rows)
    assert fold > 10_000 and fold * 0.8 <= net.n_rows <= fold * 0.8 + 10
    score = {r.text: r.score for r in toxicity.score_documents(llm.createDataFrame([(1, w, "en") for w in bad + common], DOCS), net, keep=("text",)).collect()}
    assert np.mean([score[w] >= 0.5 for w in bad]) > 0.95 and np.mean([score[w] < 0.5 for w in common]) > 0.95


def test_shards_and_layout(llm, trained, monkeypatch):
    rows, docs, labels, _ = trained
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 400)
    net, again = toxicity.train(docs, labels), toxicity.train(docs.repartition(5), labels.repartition(3))
    assert all(np.array_equal(a, b) for a, b in zip(net.arrays(), again.arrays()))
    assert net.thresholds == again.thresholds and set(net.thresholds) == {"en", "de"}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    read = toxicity.Words()
    right = (net.score([read(r[1]) for r in held]) >= 0.5) == np.array([bool(r[3]) for r in held])
    assert right.mean() > 0.85


def test_only_labelled_texts_move_and_only_once(llm, monkeypatch):
    rows = [(i, f"text {i}", "en" if i % 2 else None) for i in range(400)] + [(3, "another", "en"), (5, None, None), (None, "no id", "en")]
    marks = [(i, i % 2) for i in range(0, 400, 4)] + [(3, 0), (3, 1), (5, 1), (7, None), (None, 1), (1_000, 1)]
    docs, labels = llm.createDataFrame(rows, DOCS), llm.createDataFrame(marks, LABELS)
    fold = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    known = {}
    for i, toxic in marks:
        if i is not None and toxic is not None and not fold(i):
            known[i] = max(toxic, known.get(i, 0))
    wanted = sorted(
        (i, *min(((r[1] or "", r[2]) for r in rows if r[0] == i), key=lambda x: x[0]), toxic) for i, toxic in known.items() if i < 400
    )
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 20)
    for bits in (toxicity.FILTER_BITS, 1 << 15, 1):  # with one bit, every row passes
        monkeypatch.setattr(toxicity, "FILTER_BITS", bits)
        dealt, n_shards = toxicity._shards(docs, labels, None, None)
        got = dealt.collect()
        assert n_shards == -(-sum(r[0] in known for r in rows) // 20) and len({r.shard for r in got}) == len(got) > 1
        assert sorted(tuple(d) for r in got for d in r.docs) == wanted
        assert all([d.doc_id for d in r.docs] == sorted(d.doc_id for d in r.docs) for r in got)
    monkeypatch.undo()
    moved = toxicity._likely(docs, labels.where("doc_id IS NOT NULL")).collect()
    assert {r.doc_id for r in moved} == {r[0] for r in rows} & {m[0] for m in marks if m[0] is not None}
    dealt = toxicity._shards(docs, labels, None, None)[0]
    plan = dealt._jdf.queryExecution().explainString(dealt.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moves = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan)
    assert len(moves) > 1 and sum(any(name in columns for name in ("text#", "least#", "buf#", "docs#")) for columns in moves) == 1


def test_sums_travel_without_rows_that_did_not_change():
    rng = np.random.default_rng(3)
    table = np.zeros((toxicity.ROWS, toxicity.DIMS), np.int64)
    some = rng.choice(toxicity.ROWS, 1000, False)
    table[some] = rng.integers(-(1 << 30), 1 << 30, (1000, toxicity.DIMS))
    table[some[0]], table[some[1]] = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    moved, changed = table.copy(), (table != 0).any(1).astype(np.int64)
    moved[some[2:]] >>= 60  # a row may change in one sum alone
    none = np.zeros((3, 2, 4), np.int64)
    sums = toxicity._Learned([(table, moved, changed), (none, none, none[:, 0, 0]), (none[:1, 0, 0] - 7, none[:1, 0, 0], none[:1, 0, 0] + 1)])
    sent = pickle.dumps(sums)
    assert len(sent) < 5 * 2 * 16 * 1000  # of 8 bytes each, about half
    for one, again in zip(sums.sums, pickle.loads(sent).sums):
        assert all(a.dtype == b.dtype and np.array_equal(a, b) for a, b in zip(one, again))
        assert all(x.flags.writeable for x in again)
