"""Queries of the feature, dataset and severity operators (F, D)."""

from pyspark.sql import functions as F

from gridmill.operators import features as X
from gridmill.operators.datasets import load_dataset, one_to_one
from gridmill.operators.guards import duplicates
from gridmill.plans import views as V
from gridmill.plans.jobs import FEATURES, numeric_job
from gridmill.plans.registry import query


def _r(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


def _wide(spark, sf):
    return X.long_to_wide(V.obs(spark, sf), ["observed_at", "region"], "variable", "value", list(X.VARIABLES), check=False)


@query("pivot_wide", f"WITH {V.WIDE} SELECT * FROM wide")
def _(spark, sf):
    return _wide(spark, sf)


@query("pivot_duplicate_guard", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def _(spark, sf):
    return duplicates(V.table(spark, sf, "events"), "user_id", "event_type")


@query("expand_dims", "SELECT event_id, CAST(props->>'$.k' AS VARCHAR) AS dim_k, CAST(NULL AS VARCHAR) AS dim_x FROM events")
def _(spark, sf):
    e = V.table(spark, sf, "events").select("event_id", F.from_json("props", "map<string,string>").alias("d"))
    return X.expand_dimensions(e, "d", ["k", "x"], "dim_")


_CAL = """CAST(extract(hour FROM {t}) AS INTEGER) AS hour, CAST(isodow({t}) - 1 AS INTEGER) AS day_of_week, dayname({t}) AS day_name, CASE WHEN isodow({t}) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type,
 CAST(extract(month FROM {t}) AS INTEGER) AS month, CASE WHEN isodow({t}) >= 6 THEN 1 ELSE 0 END AS is_weekend"""


@query("calendar_features", f"SELECT o_orderkey, {_CAL.format(t='o_orderdate')} FROM orders")
def _(spark, sf):
    o = V.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("t"))
    return X.add_calendar(o, "t").drop("t")


_LOCAL = "timezone('America/New_York', timezone('UTC', {t}))"


# Observed federal holidays of the years that the tables cover, as published; the oracle takes nothing from the rule that it checks.
_OBSERVED = """1994-01-17 1994-02-21 1994-05-30 1994-07-04 1994-09-05 1994-10-10 1994-11-11 1994-11-24 1994-12-26 1995-01-02 1995-01-16 1995-02-20 1995-05-29 1995-07-04 1995-09-04 1995-10-09 1995-11-10 1995-11-23 1995-12-25
1996-01-01 1996-01-15 1996-02-19 1996-05-27 1996-07-04 1996-09-02 1996-10-14 1996-11-11 1996-11-28 1996-12-25 1997-01-01 1997-01-20 1997-02-17 1997-05-26 1997-07-04 1997-09-01 1997-10-13 1997-11-11 1997-11-27 1997-12-25
1998-01-01 1998-01-19 1998-02-16 1998-05-25 1998-07-03 1998-09-07 1998-10-12 1998-11-11 1998-11-26 1998-12-25 1999-01-01 1999-01-18 1999-02-15 1999-05-31 1999-07-05 1999-09-06 1999-10-11 1999-11-11 1999-11-25 1999-12-24 1999-12-31
2000-01-17 2000-02-21 2000-05-29 2000-07-04 2000-09-04 2000-10-09 2000-11-10 2000-11-23 2000-12-25 2001-01-01 2001-01-15 2001-02-19 2001-05-28 2001-07-04 2001-09-03 2001-10-08 2001-11-12 2001-11-22 2001-12-25
2002-01-01 2002-01-21 2002-02-18 2002-05-27 2002-07-04 2002-09-02 2002-10-14 2002-11-11 2002-11-28 2002-12-25 2023-01-02 2023-01-16 2023-02-20 2023-05-29 2023-06-19 2023-07-04 2023-09-04 2023-10-09 2023-11-10 2023-11-23 2023-12-25
2024-01-01 2024-01-15 2024-02-19 2024-05-27 2024-06-19 2024-07-04 2024-09-02 2024-10-14 2024-11-11 2024-11-28 2024-12-25 2025-01-01 2025-01-20 2025-02-17 2025-05-26 2025-06-19 2025-07-04 2025-09-01 2025-10-13 2025-11-11 2025-11-27 2025-12-25""".split()


def _days(first: int, last: int) -> str:
    return ", ".join(f"DATE '{d}'" for d in _OBSERVED if first <= int(d[:4]) <= last)


@query("holiday_flag", f"SELECT o_orderkey, CASE WHEN CAST({_LOCAL.format(t='o_orderdate')} AS DATE) IN ({_days(1994, 2002)}) THEN 1 ELSE 0 END AS is_holiday FROM orders")
def _(spark, sf):
    o = V.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("t"))
    return X.add_holiday(o, "t").drop("t")


@query("local_timestamp", f"SELECT event_id, {_LOCAL.format(t='ts')} AS ts_local FROM events")
def _(spark, sf):
    return V.events(spark, sf).select("event_id", X.local_time("ts").alias("ts_local"))


_LAGS = ", ".join(f"lag(actual_load, {n}) OVER w AS actual_load_lag_{n}" for n in X.LAGS)


@query("lags", f"WITH {V.WIDE} SELECT observed_at, region, {_LAGS} FROM wide WINDOW w AS (PARTITION BY region ORDER BY observed_at)")
def _(spark, sf):
    return X.add_lags(_wide(spark, sf), "actual_load", list(X.LAGS), ["region"], "observed_at", X.CHUNK).select("observed_at", "region", *[f"actual_load_lag_{n}" for n in X.LAGS])


@query("rolling_mean", f"""WITH {V.WIDE} SELECT observed_at, region, CASE WHEN count(actual_load) OVER w = 3 THEN round(avg(actual_load) OVER w, 6) END AS actual_load_mean_3
FROM wide WINDOW w AS (PARTITION BY region ORDER BY observed_at ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""")
def _(spark, sf):
    out = X.add_rolling_means(_wide(spark, sf), ["actual_load"], [3], ["region"], "observed_at", X.CHUNK)
    return _r(out.select("observed_at", "region", "actual_load_mean_3"), "actual_load_mean_3")


@query("mean_embedding", """SELECT label, list(round(m, 6) ORDER BY pos) AS mean_embedding FROM (SELECT label, i AS pos, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, range(1, 65) t(i) GROUP BY ALL) GROUP BY label""")
def _(spark, sf):
    out = X.mean_vectors(V.table(spark, sf, "embeddings"), ["label"], "embedding")
    return out.select("label", F.transform("mean_embedding", lambda x: F.round(x, 6)).alias("mean_embedding"))


@query("hourly_text_features", f"""WITH {V.DOCS}, v AS (SELECT date_trunc('hour', published_at) AS observed_at, region, doc_id, embedding FROM docs LEFT JOIN embeddings ON vec_id = doc_id),
m AS (SELECT observed_at, region, list(round(x, 6) ORDER BY i) AS mean_embedding FROM (SELECT observed_at, region, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM v, range(1, 65) t(i) WHERE embedding IS NOT NULL GROUP BY ALL) GROUP BY ALL)
SELECT observed_at, region, count(*) AS document_count, coalesce(any_value(mean_embedding), CAST([] AS DOUBLE[])) AS mean_embedding FROM v LEFT JOIN m USING (observed_at, region) GROUP BY ALL""")
def _(spark, sf):
    vectors = V.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    out = FEATURES.get("hourly_text")(V.docs(spark, sf).join(vectors, "doc_id", "left"), vector="embedding")
    return out.withColumn("mean_embedding", F.transform("mean_embedding", lambda x: F.round(x, 6)))


TERMS = {"license": 0.40, "the ": 0.15, "idiot": 0.30, "und ": 0.20}
_SCORE = "least(" + " + ".join(f"CASE WHEN contains(lower(text), '{t}') THEN {w} ELSE 0.0 END::DOUBLE" for t, w in TERMS.items()) + ", {cap}::DOUBLE)"
PRODUCTS = {"EN": 0.1, "DE": 0.3, "FR": 0.55}
_BASE = "(CASE upper(region) " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in PRODUCTS.items()) + " ELSE 0.0 END)::DOUBLE"
_SEVERITY = f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, {_BASE} + {_SCORE.format(cap=0.5)}))"
_TONE = f"{_SCORE.format(cap=0.8)} * (0.75::DOUBLE + 0.25::DOUBLE * greatest(0.0::DOUBLE, least(10.0::DOUBLE, -coalesce(TRY_CAST(tone AS DOUBLE), 0.0::DOUBLE))) / 10)"


def _severity(spark, sf):
    return V.docs(spark, sf).withColumn("severity_score", X.bulletin_severity(F.col("region"), F.col("text"), TERMS, PRODUCTS))


@query("keyword_severity", f"WITH {V.DOCS} SELECT doc_id, round({_SEVERITY}, 6) AS severity_score FROM docs")
def _(spark, sf):
    return _r(_severity(spark, sf).select("doc_id", "severity_score"), "severity_score", places=6)


@query("hourly_severity", f"""WITH {V.DOCS}, s AS (SELECT *, {_SEVERITY} AS severity_score FROM docs)
SELECT source, region, date_trunc('hour', published_at) AS observed_at, count(*) AS document_count, round(avg(severity_score), 6) AS severity_mean, round(max(severity_score), 6) AS severity_max,
 count(*) FILTER (severity_score >= 0.7) AS severe_document_count FROM s GROUP BY ALL""")
def _(spark, sf):
    return _r(X.hourly_severity(_severity(spark, sf), "published_at", ["source", "region"]), "severity_mean", "severity_max")


@query("tone_severity", f"WITH d AS (SELECT doc_id, text, CASE WHEN doc_id % 5 = 0 THEN 'bad' ELSE CAST(doc_id % 30 - 20 AS VARCHAR) END AS tone FROM documents) SELECT doc_id, round({_TONE}, 6) AS severity_score FROM d")
def _(spark, sf):
    tone = F.when(F.col("doc_id") % 5 == 0, "bad").otherwise((F.col("doc_id") % 30 - 20).cast("string"))
    d = V.table(spark, sf, "documents")
    return _r(d.select("doc_id", X.news_severity(F.col("text"), tone, TERMS).alias("severity_score")), "severity_score", places=6)


_HOURLY = f"""{V.WIDE}, hourly AS (SELECT *, {_LOCAL.format(t='observed_at')} AS observed_at_local, {_LAGS}, {_CAL.format(t='observed_at')},
 CASE WHEN CAST({_LOCAL.format(t='observed_at')} AS DATE) IN ({_days(2023, 2025)}) THEN 1 ELSE 0 END AS is_holiday FROM wide WINDOW w AS (PARTITION BY region ORDER BY observed_at))"""


@query("region_hourly", f"WITH {_HOURLY} SELECT * FROM hourly")
def _(spark, sf):
    return FEATURES.get("region_hourly")(V.obs(spark, sf), check="plan")


_MIDNIGHT = "timezone('UTC', timezone('America/New_York', date_trunc('day', timezone('America/New_York', timezone('UTC', observed_at)))))"


@query("region_daily", f"""WITH {V.WIDE} SELECT {_MIDNIGHT} AS observed_at, region, round(avg(actual_load), 6) AS load_mean, min(actual_load) AS load_min, max(actual_load) AS load_max,
 round(coalesce(sum(net_generation), 0), 6) AS generation_sum FROM wide GROUP BY ALL""")
def _(spark, sf):
    return _r(X.region_daily(_wide(spark, sf)), "load_mean", "generation_sum")


_TOTALS = f"""{V.FLOWS}, totals AS (SELECT observed_at, '{V.OWN}' AS region, sum(value) FILTER (to_region = '{V.OWN}') AS imports, sum(value) FILTER (from_region = '{V.OWN}') AS exports
 FROM flows WHERE from_region = '{V.OWN}' OR to_region = '{V.OWN}' GROUP BY observed_at)"""
_NET = f"coalesce(imports, 0) - coalesce(exports, 0) AS net_imports, {_LOCAL.format(t='observed_at')} AS observed_at_local"


@query("interchange_totals", f"WITH {_TOTALS} SELECT observed_at, region, imports, exports, {_NET} FROM totals")
def _(spark, sf):
    return X.interchange_totals(V.flows(spark, sf), V.OWN)


@query("interchange_totals_join", f"WITH {_TOTALS} SELECT observed_at, region, imports, exports, {_NET} FROM totals")
def _(spark, sf):
    return X.interchange_totals_by_join(V.flows(spark, sf), V.OWN)


@query("interchange_hourly", f"""WITH {_TOTALS} SELECT observed_at, region, imports, exports, {_NET}, lag(imports, 24) OVER w AS imports_lag_24, lag(exports, 24) OVER w AS exports_lag_24
FROM totals WINDOW w AS (PARTITION BY region ORDER BY observed_at)""")
def _(spark, sf):
    return X.interchange_hourly(V.flows(spark, sf), V.OWN)


@query("interchange_daily", f"""WITH {_TOTALS}, d AS (SELECT {_MIDNIGHT} AS observed_at, region, avg(imports) AS imports_mean, avg(exports) AS exports_mean FROM totals GROUP BY ALL)
SELECT observed_at, region, round(imports_mean, 6) AS imports_mean, round(exports_mean, 6) AS exports_mean, round(lag(imports_mean) OVER w, 6) AS imports_mean_lag_1, round(lag(exports_mean) OVER w, 6) AS exports_mean_lag_1
FROM d WINDOW w AS (PARTITION BY region ORDER BY observed_at)""")
def _(spark, sf):
    out = X.interchange_daily(X.interchange_totals(V.flows(spark, sf), V.OWN))
    return _r(out, "imports_mean", "exports_mean", "imports_mean_lag_1", "exports_mean_lag_1")


_OTHER = "other AS (SELECT observed_at, region, load_forecast AS forecast_in, net_generation AS generation_in FROM wide WHERE load_forecast IS NOT NULL)"


def _other(wide):
    return wide.filter("load_forecast is not null").select("observed_at", "region", F.col("load_forecast").alias("forecast_in"), F.col("net_generation").alias("generation_in"))


@query("dataset_hourly", f"WITH {V.WIDE}, {_OTHER} SELECT * FROM wide LEFT JOIN other USING (observed_at, region)")
def _(spark, sf):
    wide = _wide(spark, sf)
    return load_dataset(wide, _other(wide), check="plan")


@query("dataset_daily", f"""WITH {V.WIDE}, d AS (SELECT {_MIDNIGHT} AS observed_at, region, round(avg(actual_load), 6) AS load_mean, min(actual_load) AS load_min, max(actual_load) AS load_max,
 round(coalesce(sum(net_generation), 0), 6) AS generation_sum FROM wide GROUP BY ALL) SELECT *, load_max - load_min AS load_range FROM d""")
def _(spark, sf):
    daily = X.region_daily(_wide(spark, sf))
    spread = daily.select("observed_at", "region", (F.col("load_max") - F.col("load_min")).alias("load_range"))
    return _r(load_dataset(daily, spread, "load_mean", check="plan"), "load_mean", "generation_sum").orderBy("observed_at", "region")


@query("join_one_to_one_guard", "SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(spark, sf):
    c = V.table(spark, sf, "customer")
    named = c.join(V.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return one_to_one(c.select("c_custkey", "c_name"), named, ["c_custkey"], check="plan")


@query("numeric_job", f"""WITH {_HOURLY}, {_TOTALS.split(',', 0)[0]} SELECT hourly.*, imports, exports, net_imports, imports_lag_24, exports_lag_24 FROM hourly LEFT JOIN
(SELECT observed_at, region, imports, exports, coalesce(imports, 0) - coalesce(exports, 0) AS net_imports, lag(imports, 24) OVER v AS imports_lag_24, lag(exports, 24) OVER v AS exports_lag_24 FROM totals WINDOW v AS (PARTITION BY region ORDER BY observed_at)) USING (observed_at, region)""")
def _(spark, sf):
    return numeric_job(V.obs(spark, sf), V.flows(spark, sf), V.OWN)


@query("custom_transform", "SELECT o_orderkey, round(o_totalprice * 0.5, 6) AS half FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    def own(df):
        return df.filter("o_orderstatus = 'F'").select("o_orderkey", F.round(F.col("o_totalprice") * 0.5, 6).alias("half"))

    return V.table(spark, sf, "orders").transform(own)


