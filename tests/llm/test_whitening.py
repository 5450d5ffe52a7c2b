"""Whitening against a plain eigendecomposition of the whole covariance."""

import math

import numpy as np
import pytest
from coursewise.llm.whitening import Centre, op13_embedding_whitening, merged, rank_one, whiten

SCHEMA = "vec_id long, embedding array<float>, component int, n string, v double"


def build(X, rank=256):
    lam, vec = np.zeros(0), np.zeros((X.shape[1], 0))
    for y in X:
        lam, vec = rank_one(lam, vec, y, rank)
    return lam, vec


def same(lam, vec, scatter):
    top = max(np.abs(scatter).max(), 1e-300)
    assert np.abs(vec.T @ vec - np.eye(vec.shape[1])).max() < 1e-11
    assert np.abs(vec @ np.diag(lam) @ vec.T - scatter).max() / top < 1e-11


@pytest.mark.parametrize("d,n", [(1, 5), (3, 2), (7, 60), (24, 300)])
def test_rank_one_updates_and_merges(d, n):
    rng = np.random.default_rng(d)
    X = rng.normal(size=(n, d)) * rng.uniform(1e-3, 1e3, size=d)
    X[n // 2:] = X[0]  # repeated rows
    same(*build(X), X.T @ X)
    same(*merged(build(X[:n // 3]), build(X[n // 3:]), 256), X.T @ X)


def test_equal_eigenvalues_and_zero_rows_are_deflated():
    X = np.vstack([np.eye(6), np.eye(6), np.zeros((2, 6)), np.ones((3, 6)), np.eye(6)[:2] * 1e-9])
    same(*build(X), X.T @ X)
    rng = np.random.default_rng(3)
    X = rng.integers(-1, 2, size=(200, 5)).astype(float)
    same(*build(X), X.T @ X)


def scaled(v):
    return [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]


def check(spark, vectors, got, components=8, explained=1e-12):
    """Against exact sums and numpy's eigenvectors."""
    n, d = len(vectors), len(vectors[0][1])
    x = [scaled(v) for _, v in vectors]
    sums = [sum(c) for c in zip(*x, strict=True)]
    X = np.array([[(n * a - s) / n for a, s in zip(r, sums, strict=True)] for r in x])
    e, v = np.linalg.eigh(X.T @ X / n)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    rows = got.collect()
    assert len(rows) == n * len(e)
    by = {}
    for r in rows:
        by.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    deviation = {}
    for (i, _), r in zip(vectors, x, strict=True):
        deviation.setdefault(i, []).append(sum((n * a - s) ** 2 for a, s in zip(r, sums, strict=True)))
    for i, want in deviation.items():
        assert sorted(by[i]) == list(range(1, len(e) + 1))
        assert sorted(int(r["deviation"]) for r in by[i][1]) == sorted(want)
    W = X @ v / np.sqrt(e)
    for k in range(len(e)):
        want = sorted((W[j, k], vectors[j][0] or -1) for j in range(n))
        have = sorted((r["whitened"], r["vec_id"] or -1) for r in rows if r["component"] == k + 1)
        turned = sorted((-a, b) for a, b in have)
        close = [all(abs(a - c) < 1e-8 for (a, _), (c, _) in zip(want, h, strict=True)) for h in (have, turned)]
        assert any(close)
    for r in rows:
        assert r["n"] == n and abs(r["explained"] / (e[r["component"] - 1] / (X * X).sum() * n) - 1) < explained
        assert r["identity_error"] < 1e-9 and r["identity_error"] == rows[0]["identity_error"]


def vectors(n=150, d=12, seed=1):
    rng = np.random.default_rng(seed)
    out = [(i, (rng.normal(size=d) * np.arange(1, d + 1) / 9).astype(np.float32).tolist()) for i in range(n)]
    return out + [out[3], out[3], (None, out[5][1]), (7, out[9][1])] + [(1000 + i, out[0][1]) for i in range(70)]


def test_awkward_table(spark):
    good = vectors()
    bad = [(500, None), (501, []), (502, [1.0] * 11), (503, [None] + [1.0] * 11), (504, [float("nan")] + [1.0] * 11),
           (505, [1.0] * 11 + [float("-inf")]), (None, None)]
    df = spark.createDataFrame([(i, v, 9, "clash", 0.5) for i, v in good + bad], SCHEMA).repartition(7)
    check(spark, good, whiten(df))


def test_a_small_basis_is_refined_until_it_fits(spark):
    good = vectors(d=12)
    df = spark.createDataFrame([(i, v, 9, "clash", 0.5) for i, v in good], SCHEMA).repartition(5)
    check(spark, good, whiten(df, components=2, rank=4), components=2)


def test_few_dimensions_and_no_variance(spark):
    good = [(i, [float(i % 5), float(i % 3)]) for i in range(30)]
    make = lambda rows: spark.createDataFrame([(i, v, 9, "", 0.5) for i, v in rows], SCHEMA)
    check(spark, good, whiten(make(good)))
    assert whiten(make([])).count() == 0
    assert whiten(make([(1, None), (2, [])])).count() == 0
    assert whiten(make([(1, [1.0, 2.0])])).count() == 0
    assert whiten(make([(i, [1.0, 2.0]) for i in range(9)])).count() == 0
    one_way = whiten(make([(i, [float(i), 2.0 * i]) for i in range(9)])).collect()
    assert {r["component"] for r in one_way} == {1} and len(one_way) == 9


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 50, 5], [-(1 << 50), 7], [3, 3]])
    sums = [int(s) for s in x.sum(axis=0)]
    centre = Centre(3, sums)
    assert centre.deviations(x) == [sum((3 * int(a) - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]


def test_many_partitions_meet_in_a_tree(spark):
    good = vectors(n=300, d=4)
    df = spark.createDataFrame([(i, v, 9, "clash", 0.5) for i, v in good], SCHEMA).repartition(40)
    check(spark, good, whiten(df))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    t = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(spark, t, op13_embedding_whitening(spark, sf))
