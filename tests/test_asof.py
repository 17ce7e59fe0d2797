"""The as-of join against brute force, and features over chunks against features over whole series."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gridmill.operators import features as X
from gridmill.operators.modelling import carried_features, last_known

DAY = datetime(2024, 1, 1)


def brute(history, asks):
    out = []
    for g, t in asks:
        known = [h for h in history if h[0] == g and h[1] is not None and t is not None and h[1] <= t]
        last = lambda k: max(((h[1], h[2] is not None, h[2] or 0, h[3] or "", h[k]) for h in known if h[k] is not None), default=(None,))[-1]
        out.append((g, t, last(2), last(3)))
    return sorted(out, key=repr)


def test_random_series_and_odd_rows(spark):
    rng = random.Random(3)
    at = lambda: DAY + timedelta(minutes=rng.randrange(0, 60 * 24 * 40, 7))
    history = [(rng.choice(["a", "b", None]), at(), rng.choice([None, rng.random()]), rng.choice([None, "x", "y"])) for _ in range(300)]
    history += [("a", None, 1.0, "z"), ("a", DAY, 1.0, None), ("a", DAY, 2.0, "t"), ("a", DAY, 2.0, "t"), ("far", DAY - timedelta(days=900), 5.0, None)]
    asks = [(rng.choice(["a", "b", None, "none"]), at()) for _ in range(200)] + [("a", DAY), ("a", DAY), ("a", DAY - timedelta(seconds=1)), ("a", None), ("far", DAY)]
    h, a = spark.createDataFrame(history, "g string, t timestamp, v double, s string"), spark.createDataFrame(asks, "g string, origin timestamp")
    got = last_known(h, a, ["g"], "t", "origin", ["v", "s"])
    assert got.columns == ["g", "origin", "v", "s"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(history, asks)
    assert last_known(h.filter("false"), a, ["g"], "t", "origin", ["v"]).filter("v is not null").count() == 0
    assert last_known(h, a.filter("false"), ["g"], "t", "origin", ["v"]).count() == 0


def test_many_origins_move_rows_in_proportion(spark):
    history = spark.range(2000).select(F.lit("r").alias("region"), (F.lit(DAY) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("t"), F.col("id").cast("double").alias("v"))
    future = history.filter("v % 10 = 0").select("region", F.col("t").alias("origin"), F.col("t") + F.expr("interval 1 hour"), F.lit(1).alias("horizon")).toDF("region", "origin", "t", "horizon")
    out = carried_features(history, future, "t", ["hour", "v"], ("region",))
    rows = out.collect()
    assert len(rows) == 200 and all(r.origin == DAY + timedelta(hours=r.v) for r in rows)
    # No node of the plan makes history times origins: the largest join result is one row an ask.
    plan = out._jdf.queryExecution().executedPlan()
    made, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if "QueryStageExec" in node.getClass().getSimpleName():
            todo.append(node.plan())
        if "Join" in node.nodeName() and node.metrics().contains("numOutputRows"):
            made.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    assert made and max(made) <= 200


def test_whole_table_without_groups(spark):
    h = spark.createDataFrame([(DAY, 1.0), (DAY + timedelta(days=3), None), (DAY + timedelta(days=5), 7.0)], "t timestamp, v double")
    a = spark.createDataFrame([(DAY + timedelta(days=d),) for d in (-1, 0, 4, 5, 90)], "origin timestamp")
    assert [r.v for r in last_known(h, a, [], "t", "origin", ["v"]).orderBy("origin").collect()] == [None, 1.0, 1.0, 7.0, 7.0]


def test_chunked_interchange_equals_whole(spark):
    rows = [(DAY + timedelta(hours=i), *(("A", "B") if i % 3 else ("B", "A")), float(i)) for i in range(300)]
    flows = spark.createDataFrame(rows, "observed_at timestamp, from_region string, to_region string, value double")
    small = lambda df: sorted(map(repr, map(tuple, df.collect())))
    assert small(X.interchange_hourly(flows, "A", 30)) == small(X.interchange_hourly(flows, "A", None))
    totals = X.interchange_totals(flows, "A")
    assert small(X.interchange_daily(totals, chunk=3)) == small(X.interchange_daily(totals, chunk=None))
