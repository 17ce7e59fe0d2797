"""Totals of rows by windows against a count of each, and without pairs of both."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmill.operators.windows import window_totals
from gridmill.plans import catalog


@pytest.mark.parametrize("unit", [timedelta(microseconds=1), timedelta(seconds=1), timedelta(minutes=7), timedelta(days=1)])
def test_totals_of_windows(spark, unit):
    rng = np.random.default_rng(5)
    start = datetime(1970, 1, 1) - 40 * unit
    windows = [(int(k % 30), start + int(a) * unit, start + int(a + w) * unit) for k, a, w in zip(range(40), rng.integers(0, 90, 40), rng.integers(-2, 70, 40))]
    windows += [(30, None, start), (31, start, None)]
    ids = rng.permutation(300).tolist()
    rows = [(i, start + int(x) * unit / 4 if i % 50 else None) for i, x in zip(ids, rng.integers(-20, 500, 300))]
    got = window_totals(spark.createDataFrame(rows, "id long, at timestamp"), spark.createDataFrame(windows, "k int, window_start timestamp, window_end timestamp"), "at", "id", "k").collect()
    want = {}
    for k, a, b in windows:
        for i, at in rows:
            if a and b and at and a <= at < b:
                want.setdefault(k, []).append(i)
    assert {(r.k, r.n, r.first, r["last"]) for r in got} == {(k, len(v), min(v), max(v)) for k, v in want.items()}
    assert len(got) == len(want)


def test_no_windows_no_totals(spark):
    rows = spark.createDataFrame([(1, datetime(2024, 1, 1))], "id long, at timestamp")
    windows = spark.createDataFrame([(1, datetime(2024, 1, 2), datetime(2024, 1, 1))], "k int, window_start timestamp, window_end timestamp")
    assert window_totals(rows, windows, "at", "id", "k").collect() == []


def test_range_assign_makes_no_pairs(spark, tmp_path):
    day = datetime(2024, 1, 10)
    spark.range(400).select(F.col("id").alias("o_orderkey"), F.lit(day).alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(2000).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704758400) + F.col("id") * 60).cast("timestamp_ntz").alias("ts")).write.parquet(f"{tmp_path}/events.parquet")
    df = catalog.QUERIES["range_assign"](spark, str(tmp_path))
    rows = df.collect()
    assert sum(r.n for r in rows) > 100_000
    made = []
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "Join" in node.nodeName():
            made.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
        for inner in ("executedPlan", "plan"):
            if ("AdaptiveSparkPlan" in node.nodeName() and inner == "executedPlan") or ("QueryStage" in node.nodeName() and inner == "plan"):
                todo.append(getattr(node, inner)())
    assert made and max(made) < 20_000
