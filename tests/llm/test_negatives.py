from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paystrata.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"
LONG = (-(2**63), 2**63 - 1)


def plain(rows, every=50, positives=5, k=3):
    usable = [
        (v, [math.floor(256 * x) for x in e], lab)
        for v, e, lab in rows
        if v is not None and lab is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = []
    for i, (anchor, q, label) in enumerate(usable):
        if anchor % every:
            continue
        scored = [
            (-min(max(sum(a * b for a, b in zip(q, e)), LONG[0]), LONG[1]), v, lab)
            for j, (v, e, lab) in enumerate(usable) if j != i
        ]
        scored.sort()
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fit = [x for x in scored if x[2] != label and -50 * s <= -100 * x[0] <= -95 * s][:k]
            out += [(anchor, p, rank, v, -s, -t) for rank, (t, v, _) in enumerate(fit, 1)]
    return sorted(out)


def found(spark, rows, **options):
    return sorted(map(tuple, negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), **options).collect()))


def random_rows(seed, n, width, reach=1.0, labels=4):
    rng = random.Random(seed)
    return [(i, [rng.uniform(-reach, reach) for _ in range(width)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("block_rows", [7, 64, 100_000])
def test_equals_brute_force(llm, block_rows):
    rows = random_rows(block_rows, 400, 6)
    expected = plain(rows)
    assert len(expected) > 50
    assert found(llm, rows, block_rows=block_rows) == expected


@pytest.mark.parametrize("reach", [1e3, 1e6, 1e8, 1e12, 1e30])
def test_large_components_stay_exact_and_scores_end_at_a_long(llm, reach):
    rows = random_rows(5, 200, 3, reach)
    assert found(llm, rows) == plain(rows)


def test_few_large_vectors_among_small_ones(llm):
    rows = random_rows(6, 300, 4) + [(1000 + i, [1e7 * (i + 1), 1.0, -2.0, 0.5], i % 4) for i in range(4)]
    assert found(llm, rows) == plain(rows)


def test_ties_repeated_rows_and_a_hot_label(llm):
    rng = random.Random(8)
    rows = [(i % 90, [float(rng.randrange(3)) for _ in range(3)], 0 if i % 3 else rng.randrange(3)) for i in range(270)]
    assert found(llm, rows, block_rows=16) == plain(rows)


def test_nulls_and_odd_vectors_take_no_part(llm):
    rows = random_rows(9, 120, 3) + [
        (None, [1.0, 1.0, 1.0], 1), (500, None, 1), (501, [1.0, None, 1.0], 1), (502, [math.nan, 1.0, 1.0], 1),
        (503, [math.inf, 1.0, 1.0], 1), (504, [1.0, 1.0, 1.0], None), (550, [], 1), (551, [2.0], 1), (600, [1.0, 2.0, 3.0], 1),
    ]
    assert found(llm, rows) == plain(rows)


def test_empty_table_few_rows_and_extra_columns(llm, clash):
    assert found(llm, []) == []
    assert found(llm, [(0, [1.0], 1)]) == []
    rows = random_rows(10, 150, 3)
    wide = clash(llm.createDataFrame(rows, SCHEMA)).withColumns({n: F.lit(1) for n in ("id", "block", "goals", "rank", "place")})
    assert sorted(map(tuple, negatives.hard_negatives(wide).collect())) == plain(rows)


@pytest.mark.parametrize("bits", [3, 8, 20, 22, 24, 40, 70])
def test_packed_products(bits):
    rng = random.Random(bits)
    a, c = ([[rng.randrange(-(1 << bits), 1 << bits) for _ in range(5)] for _ in range(n)] for n in (4, 37))
    got = negatives.Scorer(np.array(c, float)).scores(np.array(a, float))
    exact = [[sum(int(float(x)) * int(float(y)) for x, y in zip(p, q)) for q in c] for p in a]
    assert got.tolist() == [[min(max(s, LONG[0]), LONG[1]) for s in row] for row in exact]


def test_several_candidates_share_one_integer():
    packed = negatives.Packed(np.arange(-30.0, 30.0).reshape(20, 3))
    packed.scores(np.ones((1, 3)))
    (planes,) = packed.wide.values()
    assert len(planes) < 20 / 4


def test_every_block_moves_once(llm, conf):
    """n candidates and one copy of each anchor per block."""
    conf(spark__sql__shuffle__partitions="4")
    df = llm.createDataFrame(random_rows(11, 600, 3), SCHEMA)
    moved = []
    scan = negatives._scan

    def counting(look, names, width, scale):
        run = scan(look, names, width, scale)
        total = llm.sparkContext.accumulator(0)
        moved.append(total)

        def counted(batches):
            def seen():
                for batch in batches:
                    total.add(batch.num_rows)
                    yield batch

            return run(seen())

        return counted

    negatives._scan = counting
    try:
        negatives.hard_negatives(df, block_rows=100).collect()
    finally:
        negatives._scan = scan
    assert [total.value for total in moved] == [600 + 12 * 6] * 2
