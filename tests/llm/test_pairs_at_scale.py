"""Operators on pairs where cells, buckets and texts are many or large, against brute force."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from tallyfield.llm import ngram_join, vectors
from tallyfield.llm.ngram_join import ngram_jaccard_join
from tallyfield.llm.vectors import near_duplicate_vectors


def linked_vectors(rows: int, dims: int, seed: int) -> np.ndarray:
    """Points around few centres and between them, in pairs at a cosine of 0.9 to 0.97."""
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((10, dims))
    share = rng.uniform(0, 1, (rows, 1))
    base = share * centre[rng.integers(0, 10, rows)] + (1 - share) * centre[rng.integers(0, 10, rows)] + 0.2 * rng.standard_normal((rows, dims))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = rng.standard_normal((rows, dims))
    other -= (other * base).sum(1, keepdims=True) * base
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = rng.uniform(0.9, 0.97, (rows, 1))
    return np.vstack([base, cosine * base + np.sqrt(1 - cosine**2) * other])


@pytest.mark.parametrize(("margin", "least"), [(None, 1.0), (3.0, 0.99)])
def test_cells_of_two_levels_keep_the_links(spark, margin, least):
    x = linked_vectors(700, 16, 8)
    label = np.arange(len(x)) % 2
    label[700:] = label[:700]
    rows = [(i, v.tolist(), int(label[i])) for i, v in enumerate(x)]
    rows += [(5_000, [1.0, 2.0], 1), (5_001, [1.0, 2.01], 1), (5_002, [-1.0, 2.0], 1)]  # another dimension meets apart
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in near_duplicate_vectors(df, sample=128, cells=60, block=64, margin=margin).collect()}
    linked = (x @ x.T >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(linked, False)
    made, true = np.array([got[i].n_links for i in range(len(x))]), linked.sum(1)
    assert (made <= true).all() and made.sum() >= least * true.sum() and true.sum() > 2_000
    assert [got[i].n_links for i in (5_000, 5_001, 5_002)] == [1, 1, 0] and got[5_001].component_id == 5_000


def test_two_levels_are_in_use_above(spark, monkeypatch):
    x = linked_vectors(300, 8, 9)
    seen = []
    divided = vectors._divided
    monkeypatch.setattr(vectors, "_divided", lambda dealt, inner, *rest: seen.append(inner) or divided(dealt, inner, *rest))
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    assert near_duplicate_vectors(df, sample=128, cells=60).count() == 600 and seen == [8]
    assert near_duplicate_vectors(df, sample=128, cells=30).count() == 600 and seen == [8]


def test_a_strip_of_4096_cells_stays_under_200_mb():
    rng = np.random.default_rng(1)
    unit, centres = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (rng.standard_normal((1024, 64)), rng.standard_normal((4096, 64))))
    tracemalloc.start()
    vectors._places(unit, centres, 0.2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6


def test_buckets_are_cut_by_shingles(spark, monkeypatch):
    """Long texts that nearly agree, one longer than a chunk, and short ones: links as by brute force for any chunk size."""
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(4_000)]
    texts = []
    for length in (3_000, 900, 40):
        base = rng.choice(words, length).tolist()
        for _ in range(9):
            copy = list(base)
            for at in rng.integers(0, length, max(1, length // 100)):
                copy[at] = f"x{rng.integers(1 << 40)}"
            texts.append(" ".join(copy))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    alike = [[a != b and len(s & t) >= 0.8 * len(s | t) - 1e-9 for b, t in enumerate(sets)] for a, s in enumerate(sets)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    verify, most = ngram_join._verify, spark.sparkContext.accumulator(0)

    def watched(n, similarity):
        run = verify(n, similarity)

        def counted(group):
            for _, part in group.groupby(["bucket", "low", "high"]):
                if part["low"].iloc[0] != part["high"].iloc[0]:
                    most.add(1)
            return run(group)

        return counted

    monkeypatch.setattr(ngram_join, "_verify", watched)
    for block in (1_000, 5_000, 1 << 18):
        before = most.value
        got = {r.doc_id: r.n_links for r in ngram_jaccard_join(df, block=block).collect()}
        assert got == {i: sum(row) for i, row in enumerate(alike)}
        assert (most.value > before) == (block < 1 << 18)  # chunks are paired only where a bucket is cut
    assert sum(map(sum, alike)) > 100
