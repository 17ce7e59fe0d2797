"""The index of vectors by cells, against brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmill.operators.vectors import cosine_topk
from gridmill.sources import cells
from gridmill.sources.cells import CellIndex, recall

SCHEMA = "k long, v array<double>"
K = 4


def table(spark, vectors, more=()):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in [*enumerate(vectors), *more]], SCHEMA)


def grouped(rng, groups, each, width=12):
    """Vectors around centres, a third of them copies of one, and rounded so that ties occur."""
    v = (rng.normal(size=(groups, 1, width)) + 0.25 * rng.normal(size=(groups, each, width))).reshape(-1, width).round(1)
    return np.concatenate([v, np.repeat(v[:1], len(v) // 2, axis=0)])


def brute(v, queries):
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    out = set()
    for q in queries:
        score = np.round(u @ u[q], 9)
        order = [i for i in np.lexsort((np.arange(len(v)), -score)) if i != q][:K]
        out |= {(q, int(i), n + 1) for n, i in enumerate(order)}
    return out


def content(df):
    return {(r.query, r.match, r["rank"]) for r in df.collect()}


@pytest.fixture
def built(spark, tmp_path):
    def build(df, n, runs=2):
        index = CellIndex(spark, f"{tmp_path}/c", "k", buckets=4)
        index.fit(df, "v", n)
        for run in range(runs):
            index.add(df.filter(F.pmod("k", F.lit(runs)) == run) if runs > 1 else df, "v", run)
        return index

    return build


@pytest.mark.parametrize("chunk", [2048, 16])
def test_an_exact_search_is_brute_force(spark, built, monkeypatch, chunk):
    monkeypatch.setattr(cells, "CHUNK", chunk)
    monkeypatch.setattr(cells, "BLOCK", 5)
    v = grouped(np.random.default_rng(3), 12, 20)
    df = table(spark, v)
    index = built(df, 12)
    queries = df.filter("k % 9 = 0")
    for probes in (1, 5):
        assert content(index.search(queries, "v", K, probes, exact=True)) == brute(v, range(0, len(v), 9))
    assert index.stored().agg(F.sum(F.size("rows"))).first()[0] == len(v)
    if chunk == 16:
        assert index.stored().agg(F.max("chunk")).first()[0] > 3


def test_measured_probes_reach_the_recall(spark, built):
    rng = np.random.default_rng(5)
    df = table(spark, grouped(rng, 30, 30))
    index = built(df, 30)
    probes = index.calibrate(df, "v", K)
    assert 1 <= probes < 15
    queries = df.filter("k % 10 = 0")
    r = recall(index.search(queries, "v", K, probes), cosine_topk(queries, df, "k", "v", K)).first()
    assert r.n_queries == queries.count() and r.n_nearest == K * r.n_queries and r.recall >= 0.95


def test_vectors_without_direction_measure_too(spark, built):
    # Nothing is grouped here, so that many cells have to be probed.
    df = table(spark, np.random.default_rng(8).normal(size=(600, 32)))
    index = built(df, 16)
    queries = df.filter("k % 6 = 0")
    true = cosine_topk(queries, df, "k", "v", K)
    probes = index.calibrate(df, "v", K)
    assert probes > 4
    assert recall(index.search(queries, "v", K, probes), true).first().recall >= 0.95
    assert recall(index.search(queries, "v", K, 1), true).first().recall < 0.95


def test_odd_rows_and_empty_tables(spark, built):
    good = np.random.default_rng(9).normal(size=(40, 6)).round(2)
    odd = [(100, None), (101, []), (102, [0.0] * 6), (103, [1.0] * 5), (104, [float("nan")] * 6), (105, [float("inf")] + [1.0] * 5), (None, [1.0] * 6)]
    df = table(spark, good, odd).unionByName(spark.sql("SELECT 106L AS k, array(1D, CAST(NULL AS DOUBLE), 1D, 1D, 1D, 1D) AS v"))
    index = built(df, 4, runs=1)
    queries = df.filter("k is null or k % 5 = 0 or k >= 100")
    assert content(index.search(queries, "v", K, 1, exact=True)) == brute(good, range(0, 40, 5))
    assert index.search(df.limit(0), "v", K).count() == 0


@pytest.mark.parametrize("rows", [[], [(1, None), (2, [0.0])]])
def test_a_table_without_vectors(spark, built, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    index = built(df, None, runs=1)
    assert len(index.centres) == 0 and index.calibrate(df, "v", K) == 1
    assert index.search(df, "v", K, exact=True).count() == 0


def test_one_cell_and_fewer_rows_than_wanted(spark, built):
    v = np.random.default_rng(2).normal(size=(3, 4))
    assert content(built(table(spark, v), 1, runs=1).search(table(spark, v), "v", K, exact=True)) == brute(v, range(3))


def test_a_run_done_again_is_stored_once_and_new_sessions_see_it(spark, built, tmp_path):
    v = np.random.default_rng(4).normal(size=(60, 5))
    df = table(spark, v)
    index = built(df, 5)
    index.add(df.filter("k % 2 = 1"), "v", 1)
    assert index.stored().agg(F.sum(F.size("rows"))).first()[0] == 60
    spark.sql(f"DROP TABLE {index.table}")
    again = CellIndex(spark, f"{tmp_path}/c", "k", buckets=4)
    assert content(again.search(df, "v", K, 2, exact=True)) == brute(v, range(60))


def test_what_is_stored_is_not_shuffled(spark, built):
    index = built(table(spark, grouped(np.random.default_rng(1), 5, 20)), 5)
    lines = index.search(table(spark, [[1.0] * 12]), "v", K)._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "rows:array" in line)
    assert "Bucketed: true" in lines[at]
    # The steps between the stored vectors and the join that they meet the queries in.
    depth, above = re.search("[A-Z]", lines[at]).start(), []
    for line in reversed(lines[:at]):
        if (d := re.search("[A-Z]", line).start()) < depth:
            depth = d
            above.append(line[d:].split()[0])
    assert above[: above.index("SortMergeJoin")] == ["Filter", "Project", "Sort"]
