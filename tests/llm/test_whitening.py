from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmill.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"
NAMES = "vec_id component n deviation whitened explained identity_error".split()


def by_hand(vectors):
    """The same by plain double arithmetic and exact sums."""
    x = [tuple(int(np.floor(256 * float(np.float32(c)))) for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), object)
    n, total = len(fit), fit.sum(0)
    z = fit * n - total
    v = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in z.T @ z])
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:4], axes[:, ::-1][:, :4]
    own = np.array(x, object) * n - total
    w = (own / n).astype(float) @ axes / np.sqrt(e)
    return n, [int(d) for d in (own * own).sum(1)], w, e / np.trace(v)


def test_whole_table_matches_brute_force(spark, sf):
    table = sorted(spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect())
    df = whitening.op11_whitening(spark, sf)
    assert df.columns == NAMES and dict(df.dtypes)["component"] == "int"
    rows = sorted(df.collect())
    n, deviation, w, explained = by_hand([r.embedding for r in table])
    assert [(r.vec_id, r.component) for r in rows] == [(t.vec_id, c) for t in table for c in (1, 2, 3, 4)]
    assert {r.n for r in rows} == {n} and [r.deviation for r in rows[::4]] == deviation
    got = np.array([r.whitened for r in rows]).reshape(-1, 4)
    sign = np.sign((got * w).sum(0))
    assert np.abs(got - w * sign).max() < 1e-9
    assert np.allclose([r.explained for r in rows[:4]], explained, rtol=1e-12)
    assert {r.identity_error for r in rows}.pop() < 1e-12


def test_odd_rows(spark):
    good = np.random.default_rng(1).normal(size=(40, 6)).astype(np.float32).tolist()
    rows = [*enumerate(good), (40, None), (41, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (42, [float("nan")] * 6), (43, [float("inf")] * 6), (44, [1.0]), (45, []), (3, good[3]), (None, good[5]), (50, good[5])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit("clash")).withColumn("component", F.lit("clash"))
    got = whitening.whitened(df).collect()
    kept = [(i, v) for i, v in rows if v is not None and len(v) == 6 and all(c is not None and np.isfinite(c) for c in v)]
    n, deviation, w, _ = by_hand([v for _, v in kept])
    assert n == 40 and {r.n for r in got} == {40} and len(got) == 4 * len(kept)
    want = {i: d for (i, _), d in zip(kept, deviation)}
    assert all(r.deviation == want[r.vec_id] for r in got)
    assert {round(r.whitened, 9) for r in got if r.vec_id is None} == {round(r.whitened, 9) for r in got if r.vec_id == 50}


@pytest.mark.parametrize("vectors, components, error", [([[1.0, 2.0]], 2, 1.0), ([[0.5, -0.5, 2.0]] * 3, 3, 1.0), ([[0.0, 0.0], [1.0, 0.0], [3.0, 0.0]], 2, 1.0), ([[-0.0], [1.0]], 1, 0.0)])
def test_axes_without_spread(spark, vectors, components, error):
    rows = whitening.whitened(spark.createDataFrame(list(enumerate(vectors)), SCHEMA)).collect()
    assert len(rows) == components * len(vectors)
    assert all(np.isfinite(r.whitened) and abs(r.identity_error - error) < 1e-9 for r in rows)


def test_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        df = whitening.whitened(spark.createDataFrame(rows, SCHEMA))
        assert df.columns == NAMES and df.count() == 0


def test_large_entries_are_summed_exactly(spark):
    vectors = [[3e30, 1e9, 0.0], [-3e30, 2e9, 1.0], [1e12, -1e9, 0.5], [5e6, 7.0, 1e7]]
    x = [[max(-(2**63), min(2**63 - 1, int(np.floor(256 * float(np.float32(c)))))) for c in v] for v in vectors]
    fit = whitening.quantised(spark.createDataFrame(list(enumerate(vectors)), SCHEMA)).select("x")
    n, total, exact = whitening.covariance(fit, 3)
    assert (n, total) == (4, [sum(c) for c in zip(*x)])
    assert exact == [[n * sum(r[i] * r[j] for r in x) - total[i] * total[j] for j in range(3)] for i in range(3)]
    moderate = [[v / 256 for v in (2**30 + i, -(2**29) * i, i)] for i in range(5)]
    y = [[int(256 * v) for v in row] for row in moderate]
    fit = spark.createDataFrame([(row,) for row in y], "x array<long>")
    _, total, exact = whitening.covariance(fit, 3)
    assert exact == [[5 * sum(r[i] * r[j] for r in y) - total[i] * total[j] for j in range(3)] for i in range(3)]
    assert {r.deviation is None for r in whitening.whitened(spark.createDataFrame(list(enumerate(vectors)), SCHEMA)).collect()} == {True}


@pytest.mark.parametrize("values", [[5, 5 - 1e-9, 5 - 3e-9, 1], [1, 1, 1, 0.5], [4, 3, 2, 1], [1, 1 - 1e-12, 1e-6, 1e-9], [2] * 3 + [2 - 1e-7] * 3 + [1]])
def test_refinement_resolves_clusters(values):
    q, _ = np.linalg.qr(np.random.default_rng(2).normal(size=(len(values), len(values))))
    q = q.astype(np.longdouble)
    for _ in range(3):  # orthogonal to extended precision
        q = q @ (3 * np.eye(len(values), dtype=np.longdouble) - q.T @ q) / 2
    a = q @ np.diag(np.array(values, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    _, start = np.linalg.eigh(a.astype(np.float32))
    _, x = whitening._refined(a.astype(np.float64), start.astype(np.float64))
    found, x = whitening._refined(a, x.astype(np.longdouble))
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17
    assert np.abs(np.sort(found) - np.sort(np.array(values, np.longdouble))).max() < 1e-17
    assert np.abs(a @ x - x * found).max() < 1e-16
