"""Positive-unlabelled learning over the whole corpus: risk, gradient, sums and features against brute force; labels of one class."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyfield.llm import classifiers as c

SMALL, HUNDREDTH = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def made_up(seed=0, n=60, width=7):
    rng = np.random.default_rng(seed)
    sets = [np.flatnonzero(rng.random(width) < 0.3) for _ in range(n)]
    counts = rng.integers(1, 5, n).astype(np.float64)
    return [s.astype(np.int16).tobytes() for s in sets], sets, counts


def plain_risk(theta, known, kn, other, on, prior, decay):
    """The risk written out text by text."""
    g = lambda s: theta[:-1][s].sum() + theta[-1]
    plus, minus = (lambda x: np.log1p(np.exp(-x))), (lambda x: np.log1p(np.exp(x)))
    mean = lambda f, sets, n: sum(k * f(g(s)) for s, k in zip(sets, n, strict=True)) / n.sum()
    negative = mean(minus, other, on) - prior * mean(minus, known, kn)
    return prior * mean(plus, known, kn) + max(0.0, negative) + decay / 2 * (theta[:-1] ** 2).sum()


@pytest.mark.parametrize("prior", [0.1, 0.9])  # with the second the negative part is below zero at times
def test_risk_and_gradient(spark, prior):
    packed_p, known, kn = made_up(1, 20)
    packed_u, other, on = made_up(2)
    sets = spark.createDataFrame(list(zip(packed_u, on.astype(int).tolist(), strict=True)), "f binary, n long").repartition(5)
    toxic, rng = (*c._flat(packed_p), kn), np.random.default_rng(3)
    for scale in (0.0, 1.0, 5.0):
        theta = rng.normal(0, scale, 8)
        risk = lambda t: c.nnpu_risk(t, toxic, c._negatives(sets, 7), on.sum(), prior, 0.01)
        value, grad = risk(theta)
        assert np.isclose(value, plain_risk(theta, known, kn, other, on, prior, 0.01))
        step = 1e-6
        for i in range(8):
            up = theta.copy()
            up[i] += step
            down = theta.copy()
            down[i] -= step
            slope = (plain_risk(up, known, kn, other, on, prior, 0.01) - plain_risk(down, known, kn, other, on, prior, 0.01)) / (2 * step)
            assert np.isclose(slope, grad[i], atol=1e-5), (scale, i)


def test_minimum_is_no_worse_than_the_plain_descent_finds(spark):
    packed_p, known, kn = made_up(4, 30)
    packed_u, other, on = made_up(5, 80)
    sets = spark.createDataFrame(list(zip(packed_u, on.astype(int).tolist(), strict=True)), "f binary, n long")
    toxic, decay = (*c._flat(packed_p), kn), 1e-2
    theta = c.minimise(lambda t: c.nnpu_risk(t, toxic, c._negatives(sets, 7), on.sum(), 0.2, decay), np.zeros(8), 60)
    each = [s for s, k in zip(known + other, np.concatenate([kn, on]).astype(int), strict=True) for _ in range(k)]
    rows, features = np.repeat(np.arange(len(each)), [len(s) for s in each]), np.concatenate(each)
    positive = np.arange(len(each)) < kn.sum()
    w, b = c.fit_nnpu(rows, features, positive, ~positive, 7, 0.2, steps=2000, rate=0.02, decay=decay)
    risk = lambda t: plain_risk(t, known, kn, other, on, 0.2, decay)
    assert risk(theta) <= risk(np.append(w, b)) + 1e-6


def test_frequencies_and_sets_are_those_of_all_texts(spark):
    texts = ["", None, "abcdefg", "abcdefg", "ABCDEFG xyz", "é" * 40, "word " * 500_000] + [f"text {i % 7} of many" for i in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    expected: dict[int, int] = {}
    held: dict[frozenset, int] = {}
    for t in texts:
        found = {int(f) for *_, fs in c._present(pa.array([t]), np.arange(1 << c.TOXIC_BITS), 1 << c.TOXIC_BITS) for f in fs}
        held[frozenset(found)] = held.get(frozenset(found), 0) + 1
        for f in found:
            expected[f] = expected.get(f, 0) + 1
    assert {r.f: r.n for r in c._frequencies(df).collect()} == expected
    chosen = sorted(expected)[::3]
    place = np.full(1 << c.TOXIC_BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    sets: dict[frozenset, int] = {}
    for found, n in held.items():
        key = frozenset(int(place[f]) for f in found if place[f] >= 0)
        sets[key] = sets.get(key, 0) + n
    assert {frozenset(np.frombuffer(r.f, np.int16).tolist()): r.n for r in c._feature_sets(df, place, len(chosen)).collect()} == sets


def test_labels_of_one_class_only(spark):
    docs, labels = (spark.read.parquet(f"{HUNDREDTH}/{t}.parquet") for t in ("documents", "labels"))
    scored = c.toxicity(docs, labels.where("toxic = 1")).select("doc_id", "held_out", "predicted").join(labels, "doc_id").collect()
    held = [r for r in scored if r.held_out]
    assert sum(r.predicted for r in held if r.toxic == 0) <= 3 and any(r.predicted for r in held if r.toxic == 1)
    given = c.toxicity(docs, labels.where("toxic = 1"), prior=0.13).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted for r in given if r.toxic == 0) <= 3 and sum(r.predicted for r in given if r.toxic == 1) >= 4
    clean = c.toxicity(docs.limit(50), labels.where("toxic = 0")).agg(F.max("score"), F.max("predicted")).first()
    assert clean[0] <= 1e-5 and clean[1] == 0


def test_unlabelled_documents_are_learnt_from(spark):
    """The same labels with other documents around them give other scores: the corpus is the unlabelled side."""
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    toxic = labels.where("toxic = 1")
    more = spark.range(10_000, 10_400).select(F.col("id").alias("doc_id"), F.concat(F.lit("quiet words about number "), F.col("id")).alias("text"))
    few = {r.doc_id: r.score for r in c.toxicity(docs.select("doc_id", "text"), toxic, prior=0.1).collect()}
    many = {r.doc_id: r.score for r in c.toxicity(docs.select("doc_id", "text").union(more), toxic, prior=0.1).collect()}
    assert any(abs(few[i] - many[i]) > 1e-3 for i in few)
