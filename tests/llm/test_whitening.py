import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from antecede.llm import registry, whitening


def matrices():
    rng = np.random.default_rng(4)
    for d in (1, 2, 5, 30, 64, 130):
        a = rng.standard_normal((d, d + 3))
        yield a @ a.T
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    yield (q * np.r_[[5.0] * 7, [1.0] * 13, [0.0] * 20]) @ q.T  # equal ones
    yield (q * np.geomspace(1e-5, 1e6, 40)) @ q.T
    yield np.diag(np.arange(12.0))
    yield np.eye(20)


@pytest.mark.parametrize("k", range(10))
def test_pairs_against_dense_solver(k):
    v = list(matrices())[k]
    v = (v + v.T) / 2
    want = np.linalg.eigvalsh(v)[::-1]
    want = want[want > 1e-12 * want[0]]
    for most in (1, 3, 8, len(v)):
        values, vectors = whitening.leading_pairs(v, most)
        m = min(most, len(want))
        assert len(values) == m and np.abs(values - want[:m]).max() < 1e-12 * want[0]
        assert np.abs(vectors.T @ vectors - np.eye(m)).max() < 1e-12
        assert np.abs(v @ vectors - vectors * values).max() < 1e-11 * want[0]


def test_inertia():
    rng = np.random.default_rng(8)
    for d in (1, 2, 3, 17, 40):
        a = rng.standard_normal((d, d))
        a = a + a.T
        if d > 2:
            a[np.diag_indices(d)] = 0  # needs pivots of two
        values = np.linalg.eigvalsh(a)
        for at in np.r_[values[:-1] + np.diff(values) / 2, -100, 100, 0]:
            assert whitening.count_below(a, at) == (values < at).sum()


def exact(rows, dims):
    """Whole numbers and exact covariance of the vectors that count."""
    xs = [[math.floor(1024 * c) + 100000 for c in v] for v in rows if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    n, sums = len(xs), [sum(c) for c in zip(*xs, strict=True)]
    t = [[n * c - s for c, s in zip(x, sums, strict=True)] for x in xs]
    cov = [[float(Fraction(sum(r[i] * r[j] for r in t), n**3)) for j in range(dims)] for i in range(dims)]
    return n, t, np.array(cov)


def held(rows, got, dims, most=8):
    n, t, cov = exact(rows, dims)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    white = np.array([[float(Fraction(c, n)) for c in r] for r in t]) @ (vectors / np.sqrt(values))
    assert len(got) == n * most
    table = np.array([[r["whitened"] for r in got if r["component"] == k + 1] for k in range(most)]).T
    for k in range(most):
        sign = np.sign(white[:, k] @ table[:, k])
        assert np.abs(table[:, k] * sign - white[:, k]).max() < 1e-8
    assert [r["deviation"] for r in got if r["component"] == 1] == [sum(c * c for c in r) for r in t]
    for r in got:
        assert r["n"] == n and r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(cov), rel=1e-9)
        assert r["identity_error"] < 1e-9


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    got = registry.op12_embedding_whitening(spark, sf_dir).orderBy("vec_id", "component").collect()
    held([r["embedding"] for r in rows], got, len(rows[0]["embedding"]))


def test_rows_that_do_not_count(spark):
    rng = np.random.default_rng(11)
    vectors = [v.tolist() for v in rng.standard_normal((60, 5))]
    vectors += [None, [], [1.0] * 4, [None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 5, [1.0, float("inf"), 1.0, 1.0, 1.0], [1e300] * 5, vectors[0]]
    rows = [(k if k % 7 else None, v, "x") for k, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string").withColumn("vector", F.lit(1)).coalesce(1)
    got = whitening.whiten(df, whitening.fit(df, components=3)).collect()
    held([v for v in vectors if v != [1e300] * 5], got, 5, 3)
    assert [r["vec_id"] for r in got[::3]] == [r[0] for r in rows if r[1] in vectors[:60]]


def test_no_component(spark):
    for vectors in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 4):
        df = spark.createDataFrame([(1, v) for v in vectors], "vec_id long, embedding array<float>")
        assert whitening.whiten(df, whitening.fit(df)).count() == 0


def test_large_entries_stay_exact(spark):
    vectors = [[float(k) * 2**40, float(k * k)] for k in range(50)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>").coalesce(1)
    got = whitening.whiten(df, whitening.fit(df)).collect()
    n, t, _ = exact(vectors, 2)
    assert [int(r["deviation"]) for r in got if r["component"] == 1] == [sum(c * c for c in r) for r in t]
