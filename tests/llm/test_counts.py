"""Mixing, piece encoding and length histograms."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import sentencepiece

from paystrata.llm import lengths, mixing, pieces
from paystrata.llm.queries import BYTE_RANKS, PIECE_MODEL, QUERIES, byte_pattern

SCHEMA = "doc_id long, text string, source string"


def mixed_documents(r):
    rows = []
    for source, n in (("b", 60), ("a", 200), (None, 30), ("é", 5), ("", 1), ("zero", 3)):
        for _ in range(n):
            words = 0 if source == "zero" else r.choice([1, 2, 2, 7, 50, 333])
            rows.append((len(rows), " ".join(["w"] * words), source))
    return rows + [(3, "w w", "b"), (3, "w w", "b"), (None, "w\x85w w", "a"), (700, None, "a"), (701, " \t\n", "b"), (702, "w " * 4_000, "a")]


def level_targets(sizes: dict, weights=(3, 1, 2)) -> dict:
    """Water filling, step by step."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[n % 3] for n, s in enumerate(order)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(order)
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * share >= 2 * sizes[s]}
        if not over:
            target.update({s: weight[s] * share for s in free})
            break
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_mix(llm, clash):
    rows = mixed_documents(random.Random(1))
    df = clash(llm.createDataFrame(rows, SCHEMA))
    got = mixing.mix_sources(df).collect()
    again = mixing.mix_sources(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    size = {}
    for _, text, source in rows:
        size[source] = size.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = level_targets(size)
    assert len(got) == len(rows)
    for source, target in want.items():
        mine = [r for r in got if r.source == source]
        assert {r.source_size for r in mine} == {size[source]}
        assert all(r.target == pytest.approx(target) for r in mine)
        assert abs(sum(r.taken for r in mine) - target) <= (1 if len(mine) > 9 else 333)
    assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 2 for r in got)


def test_mix_of_hot_lengths(llm, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    rows = [(k, "one two", "s") for k in range(1000)] + [(2000 + k, "one", "t") for k in range(3000)]
    got = mixing.mix_sources(llm.createDataFrame(rows, SCHEMA)).collect()
    for source, target in level_targets({"s": 2000, "t": 3000}).items():
        assert abs(sum(r.taken for r in got if r.source == source) - target) <= 2


def test_mix_of_nothing(llm):
    empty = llm.createDataFrame([], SCHEMA)
    assert mixing.mix_sources(empty).count() == 0
    blank = llm.createDataFrame([(1, "", "a"), (2, None, None)], SCHEMA)
    assert [(r.taken, r.target) for r in mixing.mix_sources(blank).collect()] == [(0, 0.0)] * 2


def test_budgets_are_met_exactly_where_possible():
    r = np.random.default_rng(2)
    for _ in range(200):
        sizes = np.unique(r.integers(1, 60, r.integers(1, 9)))
        counts = r.integers(1, 6, len(sizes))
        sums = {0}
        for s, c in zip(sizes.tolist(), counts.tolist()):
            sums = {x + k * s for x in sums for k in range(c + 1)}
        budget = int(r.integers(0, (sizes * counts).sum() + 1))
        taken = mixing.fit_budget(sizes, counts, budget, 7)
        reached = int((taken * sizes).sum())
        assert (taken >= 0).all() and (taken <= counts).all() and reached <= budget
        assert reached == max(x for x in sums if x <= budget)
    assert mixing.fit_budget(np.array([3, 5]), np.array([10**9, 10**9]), 4 * 10**9 + 1, 7) @ np.array([3, 5]) == 4 * 10**9 + 1


@pytest.mark.parametrize("words", [4, 16, 1 << 16])
def test_budgets_are_met_whatever_the_programme_starts_with(monkeypatch, words):
    monkeypatch.setattr(mixing, "EXACT_WORDS", words)
    test_budgets_are_met_exactly_where_possible()


@pytest.mark.parametrize(
    ("sizes", "budget"), [([70_000, 70_001, 150_000], 5_000_001), ([7_000, 7_001, 15_000], 500_001), ([90_001, 200_000], 4_000_009)]
)
def test_long_documents_fit_exactly(sizes, budget):
    sizes, counts = np.array(sizes), np.full(len(sizes), 40)
    reachable = {0}
    for size in sizes.tolist():
        reachable = {x + k * size for x in reachable for k in range(41) if x + k * size <= budget}
    taken = mixing.fit_budget(sizes, counts, budget, 7)
    assert (taken <= counts).all() and taken @ sizes == max(reachable)


ALPHABET = ["a", "b", " ", "  ", "▁", "\n", "é", "ﬁ", "\0", "　", "한", "😀", "­", "é", "Ⅷ", "\t", "<s>", "<unk>", "\x7f", "﻿", "The "]


def random_texts(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randrange(14))) for _ in range(n)]


def test_pieces_equal_the_library(llm, clash):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    texts = [None, "", *random_texts(1, 300), "long text " * 40_000]
    df = clash(llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    rows = pieces.encode_documents(df, PIECE_MODEL).orderBy("doc_id").collect()
    for text, row in zip(texts, rows):
        ids = library.encode(text or "")
        assert row.ids == ids and row.decoded == library.decode(ids)
        assert row.ends == sorted(row.ends) and (not ids or row.ends[-1] == len((text or "").encode()))
    assert pieces.encode_documents(df.limit(0), PIECE_MODEL).count() == 0


def test_spans_hold_the_pieces():
    with open(PIECE_MODEL, "rb") as file:
        codec = pieces.PieceCodec(file.read())
    text = "Hello  wörld, ▁ and 😀"
    ids, ends = codec.encode(text)
    data, begin = text.encode(), 0
    for piece, end in zip(codec.decoder.id_to_piece(ids.tolist()), ends.tolist()):
        span = data[begin:end]
        if piece.startswith("<0x"):
            assert span == bytes([int(piece[3:5], 16)])
        else:
            assert span.decode().replace(" ", "▁") in (piece, piece.removeprefix("▁"))
        begin = end


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_normalisation_by_a_compiled_map(rule, squeeze):
    library = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=squeeze
    )
    spec = next(v for n, v, _, _ in pieces._fields(library.serialized_model_proto()) if n == 3)
    ours = pieces.Normalizer(spec)
    for text in random_texts(3, 600):
        normal, source = ours(text)
        assert normal.decode() == library.normalize(text), text
        assert len(source) == len(normal) + 1 and (np.diff(source) >= 0).all()


def test_piece_query_digests(llm, small):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    texts = {r.doc_id: r.text for r in llm.read.parquet(f"{small}/documents.parquet").collect()}
    for row in QUERIES["op8_pieces"](llm, small).collect():
        ids = library.encode(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_suffix_sums_against_brute_force(llm, clash):
    r = random.Random(3)
    counts = [r.choice([0, 1, 5, 900, 1023, 1024, 5000, 70_000]) + r.randrange(3) for _ in range(500)]
    df = clash(llm.createDataFrame([(c,) for c in counts] + [(None,)], "n_tokens long"))
    sums = lengths.suffix_sums(lengths.length_histogram(df)).cache()
    for row in sums.collect():
        at_least = [c for c in counts if c >= row.n_tokens]
        assert row.n_docs == counts.count(row.n_tokens)
        assert (row.docs_at_least, row.tokens_at_least) == (len(at_least), sum(at_least))
        assert row.truncated_total == sum(min(c, row.n_tokens) for c in counts)
        assert row.quantile == pytest.approx(sum(c <= row.n_tokens for c in counts) / len(counts))
    one = llm.range(1)
    for limit in (0, 1, 3, 1000, 10**6):
        assert one.select(lengths.truncated_total(sums, limit).alias("t")).first().t == sum(min(c, limit) for c in counts)
    for share in (0.1, 0.5, 0.99, 1.0):
        want = min(c for c in counts if sum(x <= c for x in counts) >= share * len(counts) - 1e-9)
        assert one.select(lengths.quantile_length(sums, share).alias("q")).first().q == want


def test_token_counts(llm, small):
    import base64

    import tiktoken

    with open(BYTE_RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=byte_pattern(), mergeable_ranks=ranks, special_tokens={})
    texts = [r.text for r in llm.read.parquet(f"{small}/documents.parquet").collect()]
    counts = [len(encoding.encode_ordinary(t or "")) for t in texts]
    rows = QUERIES["op10_token_counts"](llm, small).collect()
    assert {r.n_tokens: r.n_docs for r in rows} == {c: counts.count(c) for c in counts}
    odd = llm.createDataFrame([(1, None), (2, ""), (3, "<|endoftext|>")], "doc_id long, text string")
    found = lengths.encoded_lengths(odd, BYTE_RANKS, byte_pattern()).orderBy("doc_id").collect()
    assert found[0].n_tokens == found[1].n_tokens == 0 and found[2].n_tokens > 1
    assert lengths.suffix_sums(lengths.length_histogram(odd.selectExpr("doc_id AS n_tokens").limit(0))).count() == 0
