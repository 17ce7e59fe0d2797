"""Queries of the modelling and serving operators (M, Q)."""

from datetime import datetime

from pyspark.sql import functions as F

from gridmill.operators import modelling as M
from gridmill.operators import serve as Q
from gridmill.operators.features import EASTERN, VARIABLES, add_calendar, long_to_wide
from gridmill.plans import views as V
from gridmill.plans.registry import query

START, END = datetime(2024, 1, 20), datetime(2024, 1, 25)
FEATS = ["l_quantity", "l_discount", "l_tax"]
ALPHA = 2.0


def _r(df, *columns, places=4):
    return df.withColumns({c: F.round(c, places) for c in columns})


def _wide(spark, sf):
    return long_to_wide(V.obs(spark, sf), ["observed_at", "region"], "variable", "value", list(VARIABLES), check=False)


@query("time_split", """SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'train' ELSE 'validation' END AS split FROM events WHERE ts >= TIMESTAMP '2024-01-20' - INTERVAL 10 DAY AND ts < TIMESTAMP '2024-01-25'""")
def _(spark, sf):
    return M.time_split(V.events(spark, sf), "ts", START, END, 10).select("event_id", "split")


@query("latest_split", """WITH m AS (SELECT max(ts) AS m FROM events) SELECT event_id, CASE WHEN ts > m - INTERVAL 5 DAY THEN 'validation' ELSE 'train' END AS split FROM events, m WHERE ts > m - INTERVAL 15 DAY""")
def _(spark, sf):
    return M.latest_split(V.events(spark, sf), "ts", 5, 10).select("event_id", "split")


_FOLDS = "f AS (SELECT CAST(k AS INTEGER) AS fold, TIMESTAMP '2024-01-10' + to_days(CAST(4 * k AS INTEGER)) AS vs FROM range(4) t(k))"


def _folds():
    return M.folds(datetime(2024, 1, 10), 4, 4, 3, 9)


@query("rolling_splits", f"WITH {_FOLDS} SELECT event_id, fold, CASE WHEN ts < vs THEN 'train' ELSE 'validation' END AS split FROM events, f WHERE ts >= vs - INTERVAL 9 DAY AND ts < vs + INTERVAL 3 DAY")
def _(spark, sf):
    return M.rolling_splits(V.events(spark, sf).select("event_id", "ts"), "ts", _folds()).drop("ts")


@query("regression_metrics", """WITH p AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem), m AS (SELECT l_returnflag, avg(y) AS m FROM p GROUP BY 1)
SELECT l_returnflag, count(*) AS n, round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg((y - p) ** 2)), 4) AS rmse, round(avg(abs(y - p) / greatest(abs(y), 2.22e-16)), 4) AS mape, round(1 - sum((y - p) ** 2) / sum((y - m) ** 2), 4) AS r2
FROM p JOIN m USING (l_returnflag) GROUP BY 1""")
def _(spark, sf):
    d = V.table(spark, sf, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p"))
    return _r(M.regression_metrics(d, "y", "p", "l_returnflag"), "mae", "rmse", "mape", "r2")


_COLS = [*FEATS, "l_extendedprice"]
_GRAM = "SELECT count(*) AS n, " + ", ".join(f"round(avg({c}), 2) AS m_{i}" for i, c in enumerate(_COLS)) + ", " + ", ".join(f"round(covar_pop({a}, {b}), 2) AS c_{i}_{j}" for i, a in enumerate(_COLS) for j, b in enumerate(_COLS) if i <= j and not (i == j == 3)) + " FROM lineitem"


@query("ridge_gram", _GRAM)
def _(spark, sf):
    g = M.gram(V.table(spark, sf, "lineitem"), FEATS, "l_extendedprice").drop("c_3_3")
    return _r(g, *[c for c in g.columns if c != "n"], places=2)


# One feature: ridge has a closed form that SQL can state.
@query("ridge_predict", f"""WITH b AS (SELECT regr_sxy(l_extendedprice, l_quantity) / (regr_sxx(l_extendedprice, l_quantity) + {ALPHA}) AS b, avg(l_extendedprice) AS y, avg(l_quantity) AS x FROM lineitem)
SELECT l_orderkey, l_linenumber, round(y + b * (l_quantity - x), 3) AS predicted FROM lineitem, b""")
def _(spark, sf):
    d = V.table(spark, sf, "lineitem")
    coef, intercept = M.fit_ridge(d, ["l_quantity"], "l_extendedprice", ALPHA)
    return d.select("l_orderkey", "l_linenumber", F.round(M.linear(["l_quantity"], coef, intercept), 3).alias("predicted"))


_LINE = f"b AS (SELECT regr_sxy(y, x) / (regr_sxx(y, x) + {ALPHA}) AS b, avg(y) AS my, avg(x) AS mx FROM {{}})"


@query("train_ridge_summary", f"""WITH e AS (SELECT ts, value AS y, CAST(user_id AS DOUBLE) AS x FROM events), m AS (SELECT max(ts) AS m FROM e),
tr AS (SELECT y, x FROM e, m WHERE ts > m - INTERVAL 30 DAY AND ts <= m - INTERVAL 5 DAY), va AS (SELECT y, x FROM e, m WHERE ts > m - INTERVAL 5 DAY), al AS (SELECT * FROM tr UNION ALL SELECT * FROM va),
b AS (SELECT regr_sxy(y, x) / (regr_sxx(y, x) + {ALPHA}) AS b, avg(y) AS my, avg(x) AS mx FROM tr), c AS (SELECT regr_sxy(y, x) / (regr_sxx(y, x) + {ALPHA}) AS c, avg(y) AS cy, avg(x) AS cx, count(*) AS n FROM al)
SELECT round(c, 5) AS coefficient, round(cy - c * cx, 3) AS intercept, round((SELECT avg(abs(y - (my + b * (x - mx)))) FROM va, b), 4) AS mae, n AS n_rows FROM c""")
def _(spark, sf):
    d = V.events(spark, sf).select("ts", F.col("value").alias("y"), F.col("user_id").cast("double").alias("x"))
    out = M.train(d, ["x"], "y", "ts", ALPHA, 5, 25)
    row = (round(out["coefficients"][0], 5), round(out["intercept"], 3), round(out["metrics"]["mae"], 4), out["rows"])
    return spark.createDataFrame([row], "coefficient double, intercept double, mae double, n_rows long")


_RES = "r AS (SELECT l_extendedprice - l_quantity * 1500 AS e FROM lineitem), s AS (SELECT count(*) AS n, avg(e) AS residual_mean, stddev_samp(e) AS residual_std, min(e) AS residual_min, max(e) AS residual_max, sum(e * e) AS sse FROM r)"


@query("residual_stats", f"WITH {_RES} SELECT n, round(residual_mean, 3) AS residual_mean, round(residual_std, 3) AS residual_std, round(residual_min, 3) AS residual_min, round(residual_max, 3) AS residual_max FROM s")
def _(spark, sf):
    d = V.table(spark, sf, "lineitem").withColumn("p", F.col("l_quantity") * 1500)
    cols = ["residual_mean", "residual_std", "residual_min", "residual_max"]
    return _r(M.residual_stats(d, "l_extendedprice", "p", 2).select("n", *cols), *cols, places=3)


@query("fit_statistics", f"WITH {_RES} SELECT n, round(4 + n * (ln(2 * pi() * sse / n) + 1), 2) AS aic, round(2 * ln(n) + n * (ln(2 * pi() * sse / n) + 1), 2) AS bic FROM s")
def _(spark, sf):
    d = V.table(spark, sf, "lineitem").withColumn("p", F.col("l_quantity") * 1500)
    return _r(M.residual_stats(d, "l_extendedprice", "p", 2).select("n", "aic", "bic"), "aic", "bic", places=2)


@query("arx_design", f"""WITH {V.WIDE}, s AS (SELECT region, observed_at, actual_load, actual_load - lag(actual_load, 24) OVER w AS y FROM wide WINDOW w AS (PARTITION BY region ORDER BY observed_at)),
l AS (SELECT *, lag(y, 1) OVER w AS y_lag_1, lag(y, 2) OVER w AS y_lag_2 FROM s WINDOW w AS (PARTITION BY region ORDER BY observed_at))
SELECT region, observed_at, round(actual_load, 4) AS actual_load, round(y, 4) AS y, round(y_lag_1, 4) AS y_lag_1, round(y_lag_2, 4) AS y_lag_2 FROM l WHERE actual_load IS NOT NULL AND y IS NOT NULL AND y_lag_1 IS NOT NULL AND y_lag_2 IS NOT NULL""")
def _(spark, sf):
    return _r(M.arx_design(_wide(spark, sf), "actual_load", "observed_at", ["region"], [1, 2], 24), "actual_load", "y", "y_lag_1", "y_lag_2")


# One lag of the seasonally differenced load: its path has a closed form, and each step adds to the value of a day before.
@query("arx_forecast", f"""WITH {V.WIDE}, k AS (SELECT region, observed_at, actual_load FROM wide WHERE actual_load IS NOT NULL),
s AS (SELECT *, actual_load - lag(actual_load, 24) OVER w AS y, row_number() OVER (PARTITION BY region ORDER BY observed_at DESC) AS back FROM k WINDOW w AS (PARTITION BY region ORDER BY observed_at)),
l AS (SELECT *, lag(y) OVER (PARTITION BY region ORDER BY observed_at) AS y1 FROM s), f AS (SELECT region, regr_sxy(y, y1) / (regr_sxx(y, y1) + 1e-6) AS b, avg(y) AS my, avg(y1) AS m1 FROM l WHERE y IS NOT NULL AND y1 IS NOT NULL GROUP BY 1),
c AS (SELECT region, b, my - b * m1 AS a, (SELECT y FROM l WHERE l.region = f.region AND back = 1) AS last FROM f)
SELECT region, CAST(h AS INTEGER) AS horizon, round(actual_load + a * (1 - b ** h) / (1 - b) + b ** h * last, 4) AS forecast FROM c JOIN s USING (region), range(1, 25) t(h) WHERE back = 25 - h""")
def _(spark, sf):
    return _r(M.arx_forecast(_wide(spark, sf), "actual_load", "observed_at", ["region"], [1], 24, 24), "forecast")


@query("arx_exogenous_forecast")
def _(spark, sf):
    """Lags, shocks and the load forecast, whose last known day stands for the day to come; held against brute force in the tests."""
    series = _wide(spark, sf)
    future = M.last_known(series, _future(spark, sf)[1], ["region"], "observed_at", "origin", ["load_forecast"])
    return M.arx_forecast(series, "actual_load", "observed_at", ["region"], [1, 2], 24, 24, ma=[1], exog=["load_forecast"], future=future)


@query("finite_check", "SELECT count(*) FILTER (value IS NULL) AS value, count(*) FILTER (event_type = 'error') AS odd FROM events")
def _(spark, sf):
    from gridmill.operators.guards import bad_values

    e = V.table(spark, sf, "events").withColumn("odd", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")))
    return bad_values(e, "value", "odd")


@query("prepare_time", "SELECT event_id, ts FROM events")
def _(spark, sf):
    return M.prepare_time(V.table(spark, sf, "events").select("event_id", "ts"), "ts")


@query("should_train", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN true ELSE TIMESTAMP '2000-01-01' >= o_orderdate + INTERVAL 24 HOUR END AS retrain FROM orders""")
def _(spark, sf):
    trained = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate").cast("timestamp"))
    return V.table(spark, sf, "orders").select("o_orderkey", M.should_train(trained, F.lit("2000-01-01").cast("timestamp"), 24).alias("retrain"))


@query("model_version", "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%S') || '.' || lpad(CAST(extract(microsecond FROM ts) % 1000000 AS VARCHAR), 6, '0') || 'Z' AS version FROM events")
def _(spark, sf):
    return V.events(spark, sf).select("event_id", M.model_version(F.col("ts")).alias("version"))


@query("forecast_origin", f"WITH {V.WIDE} SELECT max(observed_at) FILTER (actual_load IS NOT NULL) AS origin FROM wide")
def _(spark, sf):
    return M.forecast_origin(_wide(spark, sf), "observed_at", "actual_load")


@query("future_grid_hour", """SELECT o_orderkey, o_orderdate + to_hours(CAST(2 * k AS INTEGER)) AS at_time, CAST(k AS INTEGER) AS horizon FROM orders, range(1, 4) t(k)""")
def _(spark, sf):
    o = V.table(spark, sf, "orders").select("o_orderkey", F.posexplode(M.future_grid(F.col("o_orderdate").cast("timestamp"), 3, "2h")).alias("k", "at_time"))
    return o.select("o_orderkey", "at_time", (F.col("k") + 1).alias("horizon"))


@query("future_grid_day", """SELECT o_orderkey, timezone('UTC', timezone('America/New_York', timezone('America/New_York', timezone('UTC', o_orderdate)) + to_days(CAST(k AS INTEGER)))) AS at_time, CAST(k AS INTEGER) AS horizon FROM orders, range(1, 4) t(k)""")
def _(spark, sf):
    o = V.table(spark, sf, "orders").select("o_orderkey", F.posexplode(M.future_grid(F.col("o_orderdate").cast("timestamp"), 3, "1d", EASTERN)).alias("k", "at_time"))
    return o.select("o_orderkey", "at_time", (F.col("k") + 1).alias("horizon"))


_FUTURE = f"""{V.WIDE}, o AS (SELECT region, max(observed_at) FILTER (actual_load IS NOT NULL) AS origin FROM wide GROUP BY 1),
 fut AS (SELECT region, origin, origin + to_hours(CAST(k AS INTEGER)) AS observed_at, CAST(k AS INTEGER) AS horizon FROM o, range(1, 25) t(k) WHERE origin IS NOT NULL)"""
_CARRY = "(SELECT arg_max(w.{c}, w.observed_at) FROM wide w WHERE w.region = fut.region AND w.{c} IS NOT NULL AND w.observed_at <= fut.origin) AS {c}"
_BY = ("region",)


def _future(spark, sf):
    series = _wide(spark, sf)
    return series, M.future_rows(series, "observed_at", "actual_load", 24, "1h", by=_BY)


@query("future_features_ffill", f"""WITH {_FUTURE} SELECT region, origin, observed_at, horizon, CAST(extract(hour FROM observed_at) AS INTEGER) AS hour, {_CARRY.format(c='load_forecast')}, {_CARRY.format(c='net_generation')} FROM fut""")
def _(spark, sf):
    return M.carried_features(*_future(spark, sf), "observed_at", ["hour", "load_forecast", "net_generation"], _BY)


# Every third hour of every region is an origin, and so is the half hour after it.
_ASOF = "(SELECT * FROM (SELECT region, observed_at, {c} FROM wide WHERE {c} IS NOT NULL))"


@query("asof_origins", f"""WITH {V.WIDE}, o AS (SELECT region, observed_at + h AS origin FROM wide, (VALUES (INTERVAL 0 MINUTE), (INTERVAL 30 MINUTE)) t(h) WHERE extract(hour FROM observed_at) % 3 = 0),
a AS (SELECT o.region, o.origin, w.load_forecast FROM o ASOF LEFT JOIN {_ASOF.format(c='load_forecast')} w ON o.region = w.region AND o.origin >= w.observed_at),
b AS (SELECT o.region, o.origin, w.total_interchange FROM o ASOF LEFT JOIN {_ASOF.format(c='total_interchange')} w ON o.region = w.region AND o.origin >= w.observed_at)
SELECT region, origin, load_forecast, total_interchange FROM a JOIN b USING (region, origin)""")
def _(spark, sf):
    series = _wide(spark, sf)
    half = F.expr("interval 30 minutes")
    origins = series.filter(F.hour("observed_at") % 3 == 0).select("region", F.explode(F.array("observed_at", F.col("observed_at") + half)).alias("origin"))
    return M.last_known(series, origins, ["region"], "observed_at", "origin", ["load_forecast", "total_interchange"])


@query("future_features_known", f"""WITH {_FUTURE}, p AS (SELECT region, origin - INTERVAL 24 HOUR AS origin, observed_at - INTERVAL 24 HOUR AS observed_at, horizon FROM fut) SELECT region, origin, observed_at, horizon, load_forecast FROM p LEFT JOIN wide USING (region, observed_at)""")
def _(spark, sf):
    series, future = _future(spark, sf)
    day = F.expr("interval 24 hours")
    past = future.select("region", (F.col("origin") - day).alias("origin"), (F.col("observed_at") - day).alias("observed_at"), "horizon")
    return M.known_features(series, past, "observed_at", ["load_forecast"], _BY)


_STAMP = "strftime({}, '%Y-%m-%dT%H:%M:%S') || '+00:00'"
_FID = f"sha256('ridge-' || region || '|v1|' || {_STAMP.format('origin')} || '|' || {_STAMP.format('observed_at')})"


@query("forecast_id", f"WITH {_FUTURE} SELECT region, horizon, {_FID} AS forecast_id FROM fut")
def _(spark, sf):
    return _future(spark, sf)[1].select("region", "horizon", M.forecast_id(F.concat(F.lit("ridge-"), "region"), F.lit("v1"), F.col("origin"), F.col("observed_at")).alias("forecast_id"))


_ROWS = f"""SELECT {_FID} AS forecast_id, 'ridge-' || region AS model_name, 'v1' AS model_version, 'actual_load' AS target, origin AS forecast_origin_utc, observed_at AS forecast_for_utc,
 timezone('America/New_York', timezone('UTC', observed_at)) AS forecast_for_local, horizon, CAST(horizon AS DOUBLE) * 2 AS value, origin AS generated_at_utc FROM fut"""


def _forecasts(spark, sf):
    future = _future(spark, sf)[1]
    return M.forecast_rows(future, "observed_at", F.concat(F.lit("ridge-"), "region"), "v1", "actual_load", F.col("horizon").cast("double") * 2, F.col("origin"))


@query("forecast_rows", f"WITH {_FUTURE} {_ROWS}")
def _(spark, sf):
    return _forecasts(spark, sf)


@query("latest_forecasts", f"WITH {_FUTURE}, r AS ({_ROWS}) SELECT forecast_id, forecast_for_utc, value FROM r ORDER BY forecast_for_utc DESC, generated_at_utc DESC, forecast_id LIMIT 10")
def _(spark, sf):
    return Q.latest_forecasts(_forecasts(spark, sf), 10).select("forecast_id", "forecast_for_utc", "value")


@query("latest_per_target", "SELECT 'm' AS model_name, CAST(user_id AS VARCHAR) AS target, date_trunc('day', ts) AS forecast_for_utc, max(ts) AS generated_at_utc, arg_max(value, ts) AS value FROM events GROUP BY ALL")
def _(spark, sf):
    e = V.events(spark, sf).select(F.lit("m").alias("model_name"), F.col("user_id").cast("string").alias("target"), F.date_trunc("day", "ts").alias("forecast_for_utc"), F.col("ts").alias("generated_at_utc"), "value")
    return Q.latest_per_target(e)


@query("page_records", "SELECT doc_id, lang, (SELECT count(*) FROM documents) AS total FROM documents ORDER BY doc_id LIMIT 50 OFFSET 20")
def _(spark, sf):
    return Q.page(V.table(spark, sf, "documents").select("doc_id", "lang"), ["doc_id"], 50, 20)


@query("run_summary", "SELECT event_type AS stage, CASE WHEN event_id % 10 = 0 THEN 'failure' ELSE 'success' END AS status, count(*) AS items, CAST(sum(user_id) AS BIGINT) AS row_count FROM events GROUP BY ALL")
def _(spark, sf):
    return Q.run_summary(V.table(spark, sf, "events").select(F.col("event_type").alias("stage"), F.when(F.col("event_id") % 10 == 0, "failure").otherwise("success").alias("status"), F.col("user_id").alias("row_count")))


def _backtest(spark, sf, alpha):
    d = V.events(spark, sf).select("ts", F.col("value").alias("y"), F.col("user_id").cast("double").alias("x"))
    return M.backtest(d, ["x"], "y", "ts", _folds(), alpha)


def _back_sql(alpha):
    return f"""(WITH {_FOLDS}, e AS (SELECT fold, ts < vs AS tr, value AS y, CAST(user_id AS DOUBLE) AS x FROM events, f WHERE ts >= vs - INTERVAL 9 DAY AND ts < vs + INTERVAL 3 DAY),
b AS (SELECT fold, regr_sxy(y, x) / (regr_sxx(y, x) + {alpha}) AS b, avg(y) AS my, avg(x) AS mx FROM e WHERE tr GROUP BY fold)
SELECT fold, count(*) AS n, avg(abs(y - my - b * (x - mx))) AS mae, sqrt(avg((y - my - b * (x - mx)) ** 2)) AS rmse FROM e JOIN b USING (fold) WHERE NOT tr GROUP BY fold)"""


@query("backtest_metrics", f"SELECT fold, n, round(mae, 4) AS mae, round(rmse, 4) AS rmse FROM {_back_sql(2.0)}")
def _(spark, sf):
    return _r(_backtest(spark, sf, 2.0).select("fold", "n", "mae", "rmse"), "mae", "rmse")


@query("best_candidate", f"""WITH c AS (SELECT 'a' AS candidate, * FROM {_back_sql(2.0)} UNION ALL SELECT 'b', * FROM {_back_sql(1e9)}), g AS (SELECT candidate, avg(rmse) AS rmse, avg(mae) AS mae, count(*) AS folds FROM c GROUP BY 1)
SELECT candidate, round(rmse, 4) AS rmse, round(mae, 4) AS mae, folds FROM g ORDER BY g.rmse, candidate LIMIT 1""")
def _(spark, sf):
    both = _backtest(spark, sf, 2.0).withColumn("candidate", F.lit("a")).unionByName(_backtest(spark, sf, 1e9).withColumn("candidate", F.lit("b")))
    return _r(M.best_candidate(both), "rmse", "mae")


@query("calendar_local", "SELECT event_id, CAST(extract(hour FROM timezone('America/New_York', timezone('UTC', ts))) AS INTEGER) AS hour FROM events")
def _(spark, sf):
    return add_calendar(V.events(spark, sf).select("event_id", "ts"), "ts", EASTERN).select("event_id", "hour")
