"""Jaccard join and suffix dedup against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pytest

from brute import smallest_ids
from paystrata.llm import jaccard, suffixes
from paystrata.llm.suffixes import deep_shallow_sort

SCHEMA = "doc_id long, text string"


def near_copies(r, n=30):
    words = [f"w{k}" for k in range(400)]
    rows = []
    for b in range(5):
        base = [r.choice(words) for _ in range(r.choice([30, 80, 200]))]
        for _ in range(n):
            text = list(base)
            for _ in range(r.choice([0, 1, 2, 3, 5, 8])):
                text[r.randrange(len(text))] = r.choice(words)
            if r.random() < 0.3:
                text += [r.choice(words) for _ in range(r.randrange(12))]
            rows.append((100 + len(rows), " ".join(text)))
    return rows + [
        (5, None), (6, ""), (7, " \n\t"), (8, "One"), (9, "one"), (10, "one two"), (None, "one two"), (None, "quite alone in here"),
        (11, "ONE  two\n"), (101, rows[1][1]), (101, "é É"), (12, "x\x85y a b c"), (13, "x y a b c"), (14, "a " * 30_000),
    ]


def shingle_set(text, n):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


@pytest.mark.parametrize(
    "words, percent, limits",
    [(3, 90, {}), (3, 90, {"short_list": 3, "group_sets": 8}), (5, 80, {"short_list": 6, "group_sets": 20})],
)
def test_components_against_brute_force(llm, clash, words, percent, limits):
    rows = near_copies(random.Random(words))
    sets = [shingle_set(t, words) for _, t in rows]
    links = []
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                links.append((i, j))
    ids = [i for i, _ in rows]
    want = sorted(((i, len(s), c) for i, s, c in zip(ids, sets, smallest_ids(ids, links))), key=str)
    found = jaccard.similar_sets(clash(llm.createDataFrame(rows, SCHEMA)), words=words, percent=percent, **limits)
    assert sorted(map(tuple, found.select("doc_id", "n_shingles", "component_id").collect()), key=str) == want


def test_one_document_of_each_group_stays(llm):
    rows = near_copies(random.Random(9))
    found = jaccard.similar_sets(llm.createDataFrame(rows, SCHEMA)).cache()
    groups = found.where("component IS NOT NULL").select("component").distinct().count()
    alone = found.where("component IS NULL").count()
    assert alone == 3
    assert jaccard.first_of_each(found).count() == groups + alone


def test_no_documents(llm):
    empty = llm.createDataFrame([], SCHEMA)
    assert jaccard.similar_sets(empty).count() == 0
    assert suffixes.remove_repeats(empty).count() == 0


def passages(r):
    words = [f"w{k}" for k in range(3000)] + [f"é{k}" for k in range(300)]

    def text(n):
        return " ".join(r.choice(words) for _ in range(n))

    shared = [text(90), text(120), text(40), text(60)]
    rows = []
    for k in range(80):
        head, tail = text(r.randrange(60)), text(r.randrange(50))
        rows.append((100 + k, head + r.choice(["", " "]) + r.choice(shared)[r.choice([0, 0, 3, 17]) :] + r.choice(["", "x"]) + tail))
    return rows + [
        (1, None), (2, ""), (3, "a" * 399), (4, "a" * 400), (5, "a" * 401), (6, "b" * 1000), (7, "b" * 450), (8, "ab" * 700),
        (9, "x" + "ab" * 210), (None, "ab" * 400), (10, "Oneaea " * 300), (11, "zz Oneaea " + "Oneaea " * 100), (12, text(100)),
        (13, rows[3][1]), (14, rows[3][1]), (13, rows[3][1] + "q"), (15, "".join(r.choice("ab") for _ in range(3000))),
    ]


def brute_removal(rows, size):
    texts = [(t or "").encode() for _, t in rows]
    starts = Counter(t[p : p + size] for t in texts for p in range(len(t) - size + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        covered = bytearray(len(t))
        for p in range(len(t) - size + 1):
            if starts[t[p : p + size]] > 1:
                covered[p : p + size] = b"\1" * size
        kept = bytes(b for b, c in zip(t, covered) if not c)
        runs = len(re.findall(b"\1+", bytes(covered)))
        out.append((i, len(t), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(
    "size, gram, limits", [(400, 100, {}), (400, 100, {"group_anchors": 8}), (60, 20, {}), (60, 20, {"group_anchors": 20})]
)
def test_removal_against_brute_force(llm, clash, size, gram, limits):
    rows = passages(random.Random(size))
    df = clash(llm.createDataFrame(rows, SCHEMA).repartition(4))
    found = suffixes.remove_repeats(df, min_bytes=size, gram=gram, **limits)
    got = found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute_removal(rows, size)


def test_crowded_anchors_are_divided_with_one_python_process_per_task(llm, monkeypatch):
    plans, written = [], suffixes.written

    def noted(df, label):
        if label == "anchor-halves":
            plans.append(df._jdf.queryExecution().toString().split("== Physical Plan ==")[1])
        return written(df, label)

    monkeypatch.setattr(suffixes, "written", noted)
    rows = passages(random.Random(400))
    suffixes.remove_repeats(llm.createDataFrame(rows, SCHEMA).repartition(4), group_anchors=8).collect()
    assert plans
    for plan in plans:
        steps = re.findall(r"\b(MapInArrow|Exchange) ", plan)
        assert "MapInArrow" in steps
        assert all({a, b} != {"MapInArrow"} for a, b in zip(steps, steps[1:])), plan


def test_bitmap_holds_all_its_hashes_and_few_others(llm):
    r = random.Random(6)
    inside, outside = ([r.randrange(-(2**63), 2**63) for _ in range(2000)] for _ in range(2))
    bits = suffixes._bitmap(llm.createDataFrame([(x,) for x in inside], "hash long"))
    assert suffixes._passing(bits, np.array(inside)).all()
    assert suffixes._passing(bits, np.array(outside)).sum() < 20
    none = suffixes._bitmap(llm.createDataFrame([], "hash long"))
    assert not suffixes._passing(none, np.array(inside)).any()


def test_texts_without_repeated_anchors_do_not_move(llm, monkeypatch):
    moved, gone, written, discard = [], [], suffixes.written, suffixes.discard
    monkeypatch.setattr(suffixes, "written", lambda df, label: moved.append((label, df)) or written(df, label))
    monkeypatch.setattr(suffixes, "discard", lambda *tables: gone.extend(tables) or discard(*tables))
    r = random.Random(8)
    shared = "".join(r.choice("abcdefgh") for _ in range(600))
    alone = [(k, "".join(r.choice("abcdefgh") for _ in range(900))) for k in range(40)]
    rows = [(100, "x" + shared), (101, "y" + shared), (102, "y" + shared), *alone]
    got = suffixes.remove_repeats(llm.createDataFrame(rows, SCHEMA).repartition(3))
    kept = got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, kept), key=str) == brute_removal(rows, 400)
    plan = dict(moved)["anchored-texts"]._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Filter \w*pythonUDF|ArrowEvalPython", plan), plan
    assert "anchors" in dict(moved) and gone
    for table in gone:
        assert not any(os.path.exists(name.removeprefix("file://")) for name in table.inputFiles())


def test_long_texts_are_read_in_segments(monkeypatch):
    monkeypatch.setattr(suffixes, "_SEGMENT", 700)
    r = random.Random(4)
    text = "".join(r.choice("abcd") for _ in range(5000)).encode()
    whole, cut = suffixes.AnchorFinder(60, 20), suffixes.AnchorFinder(60, 20)
    places = cut(text)[0]
    monkeypatch.setattr(suffixes, "_SEGMENT", 1 << 20)
    assert places.tolist() == whole(text)[0].tolist()


def test_deep_shallow_sort():
    r = random.Random(5)
    for _ in range(200):
        some = [bytes(r.choice(b"ab") for _ in range(r.randrange(40))) for _ in range(r.randrange(1, 30))]
        prefix = bytes(r.choice(b"ab") for _ in range(30))
        some += [prefix + x for x in some] + some[:3]
        r.shuffle(some)
        order = deep_shallow_sort(some)
        assert sorted(order) == list(range(len(some)))
        assert [some[i] for i in order] == sorted(some)
