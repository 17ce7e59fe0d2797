"""The ingestion store: its index, its commits, and the range join of windows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridmill.operators.windows import assign_windows
from gridmill.plans.jobs import backfill_run
from gridmill.sources.ingested import IdIndex, Store

SCHEMA = "record_id string, at timestamp, v int"
DAY = datetime(2024, 1, 1)


@pytest.fixture
def rows(spark):
    return lambda *r: spark.createDataFrame([(i, DAY + timedelta(hours=h), v) for i, h, v in r], SCHEMA)


def content(store):
    return sorted((r.record_id, r.v) for r in store.read().collect())


def test_each_id_lands_once(spark, rows, tmp_path):
    store = Store(spark, f"{tmp_path}/s", rows().schema, buckets=4)
    assert content(store) == [] and store.runs().count() == 0
    assert store.append(rows(("a", 2, 2), ("a", 1, 1), ("b", 3, 3)), "at") == {"received": 3, "written": 2, "skipped": 1}
    assert store.append(rows(("a", 0, 9), ("c", 3, 3)), "at", DAY) == {"received": 2, "written": 1, "skipped": 1}
    again = Store(spark, f"{tmp_path}/s", rows().schema, buckets=4)
    assert again.append(rows(("c", 0, 9)), "at") == {"received": 1, "written": 0, "skipped": 1}
    assert again.append(rows(), "at") == {"received": 0, "written": 0, "skipped": 0}
    assert content(again) == [("a", 1), ("b", 3), ("c", 3)]
    assert again.state() == (4, DAY)


def test_a_run_that_failed_is_done_again(spark, rows, tmp_path, monkeypatch):
    store = Store(spark, f"{tmp_path}/s", rows().schema, buckets=4)
    store.append(rows(("a", 1, 1)), "at")
    with pytest.raises(ValueError):
        store.append(rows(("b", 1, 1), (" ", 1, 1)), "at")
    with pytest.raises(ValueError):
        store.append(rows(("b", 1, 1), (None, 1, 1)), "at")
    assert content(store) == [("a", 1)]
    # Rows and ids are there, but the run was not committed.
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
        batch = None
        try:
            batch = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/s/rows").limit(1).select(F.lit("b").alias("record_id"), "at", "v")
            store.append(batch, "at")
        except RuntimeError as error:
            assert str(error) == "lost"
    assert content(store) == [("a", 1)]
    assert store.append(rows(("b", 1, 5)), "at") == {"received": 1, "written": 1, "skipped": 0}
    assert content(store) == [("a", 1), ("b", 5)]


def test_the_index_is_not_shuffled_and_is_read_from_any_session(spark, rows, tmp_path):
    index = IdIndex(spark, f"{tmp_path}/i", buckets=4)
    for run in range(3):
        index.add(rows(*[(f"k{i}", 0, 0) for i in range(run * 10, run * 10 + 10)]), run)
    left = index.unseen(rows(("k5", 0, 0), ("k25", 0, 0), ("new", 0, 0)), 3)
    plan = left._jdf.queryExecution().sparkPlan().toString() + left._jdf.queryExecution().executedPlan().toString()
    executed = left._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in executed and executed.count("Exchange") == 1 and "Broadcast" not in plan
    assert [r.record_id for r in left.collect()] == ["new"]
    assert sorted(r.record_id for r in index.unseen(rows(("k5", 0, 0), ("k25", 0, 0)), 2).collect()) == ["k25"]
    spark.sql(f"DROP TABLE {index.table}")
    fresh = IdIndex(spark, f"{tmp_path}/i", buckets=4)
    assert fresh.known(3).count() == 30 and [r.record_id for r in fresh.unseen(rows(("k5", 0, 0), ("x", 0, 0)), 3).collect()] == ["x"]


def test_backfill_reads_no_stored_row(spark, rows, tmp_path):
    landed = rows(*[(f"k{i % 30}", i, i) for i in range(72)])
    out = backfill_run(spark, landed, f"{tmp_path}/s", "at", DAY, DAY + timedelta(days=3), 1)
    assert [(w["received"], w["written"]) for w in out["windows"]] == [(24, 24), (24, 6), (24, 0)] and out["status"] == "success"
    store = Store(spark, f"{tmp_path}/s", landed.schema)
    assert content(store) == sorted((f"k{i}", i) for i in range(30))
    assert backfill_run(spark, landed, f"{tmp_path}/s", "at", DAY, DAY + timedelta(days=3), 1)["windows"] == []
    assert backfill_run(spark, landed, f"{tmp_path}/s", "at", DAY, DAY + timedelta(days=3), 1, resume=False)["written"] == 0


def brute(rows, windows):
    return sorted((i, w) for i, t in rows for w, a, b in windows if t is not None and a is not None and b is not None and a <= t < b)


def placed(spark, rows, windows):
    r, w = spark.createDataFrame(rows, "i int, t timestamp"), spark.createDataFrame(windows, "w int, window_start timestamp, window_end timestamp")
    df = assign_windows(r, w, "t")
    assert df.columns == ["i", "t", "w", "window_start", "window_end"]
    assert "NestedLoop" not in (plan := df._jdf.queryExecution().executedPlan().toString()) and "Cartesian" not in plan
    return sorted((x.i, x.w) for x in df.collect())


def test_windows_of_any_width(spark):
    """Windows of 2, 7 and 1 days with a gap; one within another; a moment; none."""
    day = lambda n, **more: DAY + timedelta(days=n, **more)
    windows = [(0, day(0), day(2)), (1, day(2), day(9)), (2, day(10), day(11)), (3, day(3), day(3, hours=1)), (4, day(3), day(3)), (5, day(5), day(4)), (6, day(0), day(400)), (7, None, day(4)), (8, day(4), None), (9, day(1), day(1, microseconds=1)), (10, datetime(1960, 1, 1), datetime(1960, 1, 2)), (11, datetime(1969, 12, 31, 23), datetime(1970, 1, 1, 1)), (12, day(0), day(2))]
    rows = [*enumerate([day(0), day(1), day(1, microseconds=1), day(2), day(8, hours=23), day(9), day(9, hours=5), day(10), day(3), day(3, minutes=59), day(399), day(400), datetime(1960, 1, 1, 12), datetime(1970, 1, 1), datetime(1969, 12, 31, 23), None])]
    assert placed(spark, rows, windows) == brute(rows, windows)
    assert placed(spark, rows, []) == [] and placed(spark, [], windows) == []


def test_windows_at_random(spark):
    rng = random.Random(5)
    at = lambda: DAY + timedelta(microseconds=rng.randrange(10**rng.randrange(1, 14)))
    windows = [(i, *sorted((at(), at()))) for i in range(120)]
    rows = [(i, at()) for i in range(400)]
    assert placed(spark, rows, windows) == brute(rows, windows)
