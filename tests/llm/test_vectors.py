"""Lattice hashing and exact top-k against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from brute import smallest_ids
from paystrata.llm import lattice, topk

SCHEMA = "vec_id long, embedding array<float>"
ODD = [
    (901, None), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [None] + [1.0] * 15), (905, []),
    (906, [float("inf")] * 16), (907, [1.0] * 5), (908, [2.0] * 5), (None, [1.0] * 16), (909, [1e-30] * 16),
    (910, [1e30] * 16), (909, [3.0] * 16),
]


def vectors(rng, n=150, dims=16):
    rows = []
    for k in range(n):
        base = rng.normal(size=dims)
        rows.append((2 * k, base.tolist()))
        if k % 3 == 0:
            near = base + rng.normal(size=dims) * rng.choice([0.02, 0.1, 0.2])
            rows.append((2 * k + 1, (near * rng.uniform(0.1, 9)).tolist()))
    center = rng.normal(size=dims)  # a group in which nearly all are linked
    rows += [(1000 + k, (center + rng.normal(size=dims) * 0.1).tolist()) for k in range(60)]
    rows += [(2000 + k, center.tolist()) for k in range(5)]
    return [(i, np.array(v, np.float32).tolist()) for i, v in rows]


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


def brute_links(rows, least):
    links = []
    unit = [np.array(v, float) / np.linalg.norm(v) if usable(v) and any(v) else None for _, v in rows]
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links.append((i, j))
    return links


@pytest.mark.parametrize("cell_rows", [2048, 16])
def test_links_against_brute_force(llm, clash, cell_rows):
    rows = vectors(np.random.default_rng(1)) + ODD
    links = brute_links(rows, 0.9)
    df = clash(llm.createDataFrame(rows, SCHEMA))
    found = lattice.near_duplicates(df, cell_rows=cell_rows).collect()
    degree = np.bincount(np.array(links).reshape(-1), minlength=len(rows))
    recall = sum(r.n_links for r in found) / (2 * len(links))
    assert recall >= 0.97
    ids = [i for i, _ in rows]
    want = sorted(zip(map(str, ids), degree.tolist(), map(str, smallest_ids(ids, links))))
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in found)
    assert len(got) == len(want)
    assert all(g[1] <= w[1] for g, w in zip(sorted(g[:2] for g in got), sorted(w[:2] for w in want)))  # none too many
    assert sum(g == w for g, w in zip(got, want)) >= 0.95 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_recall_at_the_threshold_itself(llm):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(400):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        rows += [(2 * k, a.tolist()), (2 * k + 1, (0.903 * a + np.sqrt(1 - 0.903**2) * b).tolist())]
    found = lattice.near_duplicates(llm.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.where("n_links = 1").count() >= 0.85 * len(rows)


def test_lattice_points_are_the_closest():
    rng = np.random.default_rng(2)
    z = rng.normal(size=(300, 8)) * 2
    near = lattice.nearest_point(z)
    gap = ((z - near) ** 2).sum(1)
    assert (gap <= 1 + 1e-9).all()  # the covering radius of E8 is 1
    for v in lattice.minimal_vectors():
        assert (((z - near - v) ** 2).sum(1) >= gap - 1e-9).all()
    assert np.allclose((lattice.minimal_vectors() ** 2).sum(1), 2)


def test_no_vectors(llm):
    empty = llm.createDataFrame([], SCHEMA)
    assert lattice.near_duplicates(empty).count() == 0
    assert topk.top_inner_products(empty).count() == 0
    only = llm.createDataFrame([(1, None), (50, None)], SCHEMA)
    assert topk.top_inner_products(only).count() == 0
    assert {(r.vec_id, r.n_links) for r in lattice.near_duplicates(only).collect()} == {(1, 0), (50, 0)}


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 20, "head_rows": 8}])
def test_top_inner_products(llm, clash, sizes):
    rng = np.random.default_rng(3)
    rows = [(k, (rng.normal(size=16) * rng.lognormal()).astype(np.float32).tolist()) for k in range(600)]
    rows += [(5000 + k, [0.5] * 16) for k in range(12)] + [(50, [1.0] * 16), (100, [4.0] * 3), (650, [])] + ODD[:6]
    rows.append((None, [9.0] * 16))
    real = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole = np.zeros((len(real), 16), np.int64)
    for at, (_, v) in enumerate(real):
        whole[at, : len(v)] = np.floor(256 * np.array(v, float))
    ids = np.array([i for i, _ in real])
    want = []
    for at in np.flatnonzero(ids % 50 == 0):
        score = whole @ whole[at]
        order = [j for j in np.lexsort((ids, -score)) if j != at][:5]
        want += [(int(ids[at]), n + 1, int(ids[j]), int(score[j])) for n, j in enumerate(order)]
    got = topk.top_inner_products(clash(llm.createDataFrame(rows, SCHEMA)), **sizes).collect()
    assert sorted(map(tuple, got)) == sorted(want)


LONG = (-(2**63), 2**63 - 1)


def cut(x):
    return min(max(x, LONG[0]), LONG[1])


@pytest.mark.parametrize("reach", [1e4, 1.4e7, 1e8, 1e15, 1e30])
@pytest.mark.parametrize("few", [False, True])
def test_large_components_give_exact_scores_up_to_a_long(llm, reach, few):
    """Components and scores beyond a long count as the nearest long."""
    rng = np.random.default_rng(4)
    rows = [(k, (rng.uniform(-1, 1, 4) * (reach if k < 8 or not few else 1)).tolist()) for k in range(160)]
    rows += [(1000 + k, [reach, -reach, reach, 1.0]) for k in range(3)]
    whole = [(i, [cut(math.floor(256 * x)) for x in v]) for i, v in rows]
    want = []
    for at, (anchor, q) in enumerate(whole):
        if anchor % 50 == 0:
            scored = sorted((-cut(sum(a * b for a, b in zip(q, v))), i) for j, (i, v) in enumerate(whole) if j != at)
            want += [(anchor, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_inner_products(df, block_rows=30, head_rows=9)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_every_vector_moves_once(llm, monkeypatch):
    seen = {0: llm.sparkContext.accumulator(0), 1: llm.sparkContext.accumulator(0)}
    real = topk._search

    def counting(width, rotation, k, batches):
        def watched():
            for batch in batches:
                kinds = batch.column("is_query").to_numpy()
                seen[0].add(int((kinds == 0).sum()))
                seen[1].add(int((kinds == 1).sum()))
                yield batch

        return real(width, rotation, k, watched())

    monkeypatch.setattr(topk, "_search", counting)
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(500)]
    topk.top_inner_products(llm.createDataFrame(rows, SCHEMA), block_rows=25, every=5, head_rows=20).collect()
    assert seen[0].value == 500 and 100 <= seen[1].value <= 100 * 28
