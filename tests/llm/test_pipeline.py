"""The pipeline's stages, each against what its operator says."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter
from pathlib import Path

import pytest
import sentencepiece

import corpus_pipeline as pipeline
from brute import reachable
from paystrata.llm import mixing, pieces, quality
from paystrata.session import scratch_path
from test_texts import shingle_set

COLUMNS = list(pipeline.COLUMNS)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    full = [(i, t, "en", f"s{n % 3}", len(t) if t is not None else None) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def shuffle_files(spark):
    """Files of shuffles that this process holds."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(str(d)) for d in blocks.localDirs()]
    return {f for d in folders for f in d.rglob("shuffle_*")}


def words(r, n):
    return " ".join(f"w{r.randrange(5000)}" for _ in range(n))


def test_order_of_the_stages():
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near_copies", "repeats", "mixing", "pieces"]


def test_rejected_documents_go(llm, small):
    docs = llm.read.parquet(f"{small}/documents.parquet")
    kept = pipeline.keep_good(llm, docs, small)
    assert kept.columns == COLUMNS
    machine = quality.train(docs, llm.read.parquet(f"{small}/labels.parquet"))
    scores = quality.score_documents(docs, machine).collect()
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in scores if r.score >= 0.7)


@pytest.mark.parametrize("labels", [[], [(5, 0)], [(1, None), (None, 1)], [(77, 1)]])
def test_all_documents_stay_without_anything_to_learn_from(llm, tmp_path, labels):
    ids = [1, 3, 5, None]  # 5 is held out, 77 is no document's
    llm.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(llm, [(i, f"a clean text {i}") for i in ids] + [(3, None)])
    kept = pipeline.keep_good(llm, docs, str(tmp_path))
    assert kept.columns == COLUMNS and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


def test_one_near_copy_stays(llm):
    r = random.Random(1)
    base = words(r, 200)
    rows = [(10, base), (11, base + " tail"), (12, base), (12, base), (12, words(r, 50)), (13, words(r, 80)), (14, None), (15, ""), (None, base), (None, None)]
    kept = pipeline.drop_near_copies(llm, documents(llm, rows), "")
    assert kept.columns == COLUMNS
    assert sorted((x.doc_id, x.text or "") for x in kept.collect() if x.doc_id) == sorted([(10, base), (12, rows[4][1]), (13, rows[5][1]), (14, ""), (15, "")])


def test_shuffles_do_not_add_up(llm, tmp_path):
    r = random.Random(8)
    texts = [words(r, 80) for _ in range(30)]
    docs = documents(llm, list(enumerate(texts + texts[:5])))
    before = shuffle_files(llm)
    pipeline.drop_near_copies(llm, docs, "").write.parquet(str(tmp_path / "kept"))
    assert llm.read.parquet(str(tmp_path / "kept")).count() == 30
    for _ in range(100):  # they are removed in the background
        left = shuffle_files(llm) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left


def test_tables_go_once_they_are_used(llm, small, monkeypatch):
    left, read = [], pipeline.STAGES[-1][1]

    def last(spark, docs, sf_dir):
        left.extend(p.name.rpartition("-")[0] for p in Path(scratch_path(spark, "x")).parent.iterdir() if p not in before)
        return read(spark, docs, sf_dir)

    folder = Path(scratch_path(llm, "x")).parent
    before = set(folder.iterdir()) if folder.exists() else set()
    monkeypatch.setattr(pipeline, "STAGES", [*pipeline.STAGES[:-1], ("pieces", last)])
    pipeline.run(llm, small)
    assert [name for name in left if name.startswith("stage-")] == ["stage-mixing"]
    assert "shingle-lists" not in left and left.count("links") == 1


def test_passages_are_cut_on_whole_characters(llm):
    r = random.Random(2)
    passage = words(r, 60)
    rows = [(1, "é" + passage + " ende"), (2, "ö" + passage + "x"), (3, words(r, 100)), (4, None)]
    got = {x.doc_id: x for x in pipeline.cut_repeats(llm, documents(llm, rows), "").collect()}
    assert got[1].text == "é ende" and got[2].text == "öx" and got[3].text == rows[2][1] and got[4].text is None
    assert got[1].n_chars == 6


def test_documents_without_repeats_do_not_move(llm):
    r = random.Random(12)
    passage = words(r, 60)
    rows = [(1, "a " + passage), (2, "b " + passage), (3, words(r, 100)), (4, words(r, 100)), (5, None), (6, ""), (None, words(r, 70))]
    cut = pipeline.cut_repeats(llm, documents(llm, rows), "")
    assert sorted((x.doc_id or 0, x.text, x.n_chars) for x in cut.collect() if x.text) == [
        (0, rows[6][1], len(rows[6][1])), (1, "a", 1), (2, "b", 1), (3, rows[2][1], len(rows[2][1])), (4, rows[3][1], len(rows[3][1])),
    ]
    assert sorted(x.doc_id for x in cut.collect() if not x.text) == [5, 6]
    parts = cut._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert parts[0].startswith("Union")
    stay = parts[max(n for n, x in enumerate(parts) if x.startswith("+- ")) :]  # the second branch
    assert len(stay) > 1 and not any("Join" in x or "Repartition" in x for x in stay), parts


def test_passages_are_measured_in_words(llm):
    r = random.Random(4)

    def letters(n):
        return " ".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789#+") for _ in range(n))

    short, fifty, long_words = letters(51), letters(50), " ".join(f"word{r.randrange(10**9):09}" for _ in range(40))
    assert len(short) == 101
    rows = [(2 * n + k, f"{n}{k}<{shared}>{k}{n}") for n, shared in enumerate((short, fifty, long_words)) for k in range(2)]
    got = {x.doc_id: x.text for x in pipeline.cut_repeats(llm, documents(llm, rows), "").collect()}
    assert [got[0], got[1]] == ["00" + "00", "01" + "10"]
    assert all(got[i] == text for i, text in rows[2:])


def test_mix_repeats_documents(llm):
    r = random.Random(3)
    rows = [(n, words(r, 1 + n % 30)) for n in range(200)] + [(7, "w"), (7, "w"), (300, None), (None, "a b")]
    docs = documents(llm, rows)
    got = pipeline.mix(llm, docs, "")
    assert got.columns == COLUMNS
    total = sum(len((t or "").split()) for _, t in rows)
    assert sum(len(x.text.split()) for x in got.collect()) == pytest.approx(1.5 * total, abs=4)


def test_stages_take_no_documents(llm, small):
    empty = llm.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES:
        assert stage(llm, empty, small).count() == 0


def test_whole_run(llm, small):
    got = pipeline.run(llm, small)
    rows = got.collect()
    assert rows and all(r.n_tokens == len(r.ids) == len(r.ends) for r in rows)


def plain_repeats(texts):
    """What stays of each text: bytes in strings that occur twice go, in runs of over fifty words."""
    size, data = 101, [t.encode() for t in texts]
    starts = Counter(t[p : p + size] for t in set(data) for p in range(len(t) - size + 1))
    out = []
    for t in data:
        covered = bytearray(len(t))
        for p in range(len(t) - size + 1):
            if starts[t[p : p + size]] > 1:
                covered[p : p + size] = b"\1" * size
        kept, at = b"", 0
        for run in re.finditer(b"\1+", bytes(covered)):
            begin, end = run.span()
            while begin < end and t[begin] & 0xC0 == 0x80:
                begin += 1
            while begin < end < len(t) and t[end] & 0xC0 == 0x80:
                end -= 1
            if len(t[begin:end].split()) > 50:
                kept, at = kept + t[at:begin], end
        out.append((kept + t[at:]).decode())
    return out


def plain_run(spark, docs, scores):
    """The stages in plain Python, given the scores and what the mix takes."""
    rows = sorted((r for r, score in zip(docs, scores) if score >= 0.7), key=lambda r: (r[0] is None, r[0]))
    sets = [shingle_set(r[1], 5) for r in rows]
    links = [(i, j) for i, x in enumerate(sets) for j in range(i) if x and 10 * len(x & sets[j]) >= 8 * len(x | sets[j])]
    first: dict = {}
    for n, root in enumerate(reachable(len(rows), links)):
        first.setdefault(root, n)
    rows = [rows[n] for n in sorted(first.values())]
    counts = [len(rows)]
    cut = plain_repeats([r[1] or "" for r in rows])
    counts.append(sum(t != (r[1] or "") for r, t in zip(rows, cut)))
    rows = [(r[0], t if r[1] is not None else None, *r[2:4], len(t)) for r, t in zip(rows, cut)]
    taken = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA), keep=("text",)).collect()
    copies = {(r.doc_id, r.text): r.copies for r in taken}
    library = sentencepiece.SentencePieceProcessor(model_file=pipeline.PIECE_MODEL)
    with open(pipeline.PIECE_MODEL, "rb") as file:
        codec = pieces.PieceCodec(file.read())
    out = []
    for i, text, lang, source, _ in rows:
        ids = library.encode(text or "")
        digest = hashlib.sha256(library.decode(ids).encode()).hexdigest()
        out += [(i, lang, source, len(ids), ids, codec.encode(text or "")[1].tolist(), digest)] * copies[i, text]
    return out, counts


def test_whole_run_equals_plain_python(llm, small, tmp_path):
    r = random.Random(6)
    given = [tuple(x) for x in llm.read.parquet(f"{small}/documents.parquet").select(*COLUMNS).collect()][:60]
    passage = words(r, 60)
    more = [(9_000 + n, text + " " + passage, lang, source, 0) for n, (_, text, lang, source, _) in enumerate(given[:20])]
    more += [(9_100 + n, text + " tail", lang, source, 0) for n, (_, text, lang, source, _) in enumerate(given[20:40])]
    more += [(None, "a text without an id " + words(r, 40), "en", "s", 0), (9_200, None, None, None, None), (9_201, "é", "fr", "s", 1)]
    docs = llm.createDataFrame(given + more, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = llm.read.parquet(f"{small}/labels.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = quality.score_documents(docs, quality.train(docs, labels), keep=pipeline.COLUMNS).collect()
    want, (kept, cut) = plain_run(llm, [tuple(x)[:5] for x in rows], [x.score for x in rows])
    assert 0 < cut < kept < len(rows) and want
    assert sorted(map(repr, map(tuple, pipeline.run(llm, str(tmp_path)).collect()))) == sorted(map(repr, want))
