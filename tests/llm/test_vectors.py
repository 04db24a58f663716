"""Exact top-k and hard negatives against plain rankings of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.llm import leaves, negatives, topk

SCHEMA = "vec_id long, embedding array<double>, label int, id string, score long"


def table(spark, vectors, labels=None, ids=None):
    labels = labels if labels is not None else [0] * len(vectors)
    ids = ids if ids is not None else range(len(vectors))
    return spark.createDataFrame([(i if i is None else int(i), v if v is None else [None if x is None else float(x) for x in v], y if y is None else int(y), "x", 7) for i, v, y in zip(ids, vectors, labels)], SCHEMA)


def whole(v, scale):
    return [math.floor(scale * x) for x in v]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def top_plain(vectors, scale, top, every):
    held = {i: whole(v, scale) for i, v in enumerate(vectors)}
    out = []
    for q in held:
        if q % every == 0:
            ranked = sorted((-dot(held[q], held[i]), i) for i in held if i != q)[:top]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked)]
    return sorted(out)


def mined_plain(vectors, labels, scale, every):
    held = {i: whole(v, scale) for i, v in enumerate(vectors)}
    out = []
    for a in held:
        if a % every:
            continue
        ranked = sorted((-dot(held[a], held[i]), i) for i in held if i != a)
        for s, p in [(s, i) for s, i in ranked if labels[i] == labels[a]][:5]:
            fit = [(t, i) for t, i in ranked if labels[i] != labels[a] and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(fit)]
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def clustered(n, d, seed):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((12, d))[rng.integers(0, 12, n)] + 0.3 * rng.standard_normal((n, d))
    x[: n // 4] = x[0]  # many copies
    x[n // 4 : n // 3] = np.round(x[n // 4 : n // 3])
    return (x / np.linalg.norm(x, axis=1)[:, None]).tolist(), rng.integers(0, 4, n).tolist()


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(leaves, "BLOCK_ROWS", 40)
    monkeypatch.setattr(leaves, "QUERY_ROWS", 30)
    monkeypatch.setattr(leaves, "FIT_ROWS", 150)


@pytest.mark.parametrize("d", [5, 64])
def test_top_k_equals_a_ranking_of_all(spark, small, d):
    vectors, _ = clustered(420, d, d)
    got = topk.search(table(spark, vectors), F.col("id") % 3 == 0, top=7)
    assert rows(got) == top_plain(vectors, 64, 7, 3)


@pytest.mark.parametrize("d", [5, 64])
def test_negatives_equal_rankings_of_all(spark, small, d):
    vectors, labels = clustered(420, d, d + 1)
    got = negatives.mine(table(spark, vectors, labels), F.col("id") % 4 == 0, F.col("label"))
    want = mined_plain(vectors, labels, 256, 4)
    assert want and rows(got) == want


def test_bounds_hold_and_leave_pairs_out():
    rng = np.random.default_rng(3)
    x = np.repeat(rng.standard_normal((40, 16)), 4, axis=1) * 100  # each value stands for a few components, as in a series
    x = np.floor(x + rng.standard_normal(x.shape))
    centre, queries = x.mean(axis=0), x[:10]
    floor = np.sort(queries @ x.T, axis=1)[:, -5]
    row, col = topk.survivors(queries, floor, x, centre, [topk.statistics(x - centre, s) for s in topk.LEVELS])
    hit = np.argwhere(queries @ x.T >= floor[:, None])
    assert {tuple(p) for p in hit} <= set(zip(row, col)) and len(row) < 0.5 * 400
    stats = topk.statistics(x, topk.LEAF_LEVEL)
    most = topk.highest(queries, stats[:20].min(axis=0)[None], stats[:20].max(axis=0)[None])
    assert (most[:, 0] >= (queries @ x[:20].T).max(axis=1)).all()
    outline = negatives.outline(x)
    most = negatives.highest(queries, outline[:20].min(axis=0)[None], outline[:20].max(axis=0)[None])
    assert (most[:, 0] >= (queries @ x[:20].T).max(axis=1)).all()


@pytest.mark.parametrize("seed", range(5))
def test_threshold_join_finds_all(seed):
    rng = np.random.default_rng(seed)
    x = np.floor(256 * rng.standard_normal((90, 6 + seed)) * rng.random((90, 1)))
    q, fits = x[:20], rng.random((20, 90)) < 0.7
    scores = q @ x.T
    floor = np.quantile(scores, rng.random(20) * 0.3 + 0.7)
    row, col, found = negatives.Postings(x).joined(q, floor, fits)
    want = {(r, c, scores[r, c]) for r, c in np.argwhere(fits & (scores >= floor[:, None]))}
    assert {*zip(row, col, found)} == want


ODD = [[1.0, 0.5], None, [None, 1.0], [float("nan"), 1.0], [float("inf"), 0.0], [0.0, 0.0], [], [1.0, 0.5], [1.0], [-1.0, -0.5], [1.0, 0.5, 2.0]]


def test_odd_rows_of_top_k(spark):
    # zero and empty vectors take part and score 0; a missing component counts as 0; rows without id don't
    got = topk.search(table(spark, [*ODD, [1.0, 0.5]], ids=[*range(len(ODD)), None]), F.col("id") == 0)
    assert rows(got) == sorted((0, n + 1, i, s) for n, (i, s) in enumerate([(7, 5120), (10, 5120), (8, 4096), (5, 0), (6, 0), (9, -5120)]))
    for empty in (table(spark, []), table(spark, [None])):
        assert topk.search(empty, F.col("id") == 0).collect() == []
    assert topk.search(table(spark, [[1.0]]), F.col("id") == 0).collect() == []
    # an id that repeats takes part once, with its smallest vector
    twice = table(spark, [[2.0], [1.0], [3.0], [2.0]], ids=[0, 1, 1, 0])
    assert rows(topk.search(twice, F.col("id") == 0)) == [(0, 1, 1, 128 * 64)]
    # scores beyond what doubles hold exactly
    wide = table(spark, [[3e6, 1.0], [3e6, 1.015625], [3e6, 1.0]])
    big = 3_000_000 * 64
    assert rows(topk.search(wide, F.col("id") == 0)) == [(0, 1, 1, big * big + 64 * 65), (0, 2, 2, big * big + 64 * 64)]


def test_odd_rows_of_negatives(spark):
    vectors = [[1.0, 0.0], [1.0, 0.0], [0.7, 0.1], None, [0.6, 0.2], [0.0, 0.0], [0.7, 0.1], [-1.0, 0.0]]
    labels = [1, 1, 2, 2, None, 1, 2, 2]
    got = negatives.mine(table(spark, vectors, labels), F.col("id") == 0, F.col("label"))
    score = 256 * math.floor(256 * 0.7)
    # the second positive scores 0, as only a score of 0 could fit it
    assert rows(got) == [(0, 1, 1, 2, 65536, score), (0, 1, 2, 6, 65536, score)]
    for empty in (table(spark, []), table(spark, [[1.0], [1.0]], [None, None])):
        assert negatives.mine(empty, F.col("id") == 0, F.col("label")).collect() == []
