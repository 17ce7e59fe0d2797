"""Queries of the sources, sinks and jobs (S, F17, D04, M20, U02): tables derived from the given ones, written to the shared folder and read again."""

import io
import zipfile
from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F

from gridmill.operators import features as X
from gridmill.operators import modelling as M
from gridmill.plans import jobs as J
from gridmill.plans import views as V
from gridmill.plans.registry import query, shared
from gridmill.schema import GKG
from gridmill.sources import raw, tables


@query("scan_jsonl", "SELECT 'good' AS side, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events UNION ALL SELECT 'bad', count(*) FILTER (event_id % 10 = 0), NULL FROM events")
def _(spark, sf):
    path = shared(spark)
    e = V.table(spark, sf, "events").select(F.to_json(F.struct(F.col("event_id").cast("string").alias("record_id"), F.col("event_type").alias("source"))).alias("value"), "event_id")
    odd = e.filter("event_id % 10 = 0").select(F.when(F.col("event_id") % 20 == 0, "[1, 2]").otherwise("{no json").alias("value"))
    blank = e.filter("event_id % 7 = 0").select(F.lit("  ").alias("value"))
    e.select("value").unionByName(odd).unionByName(blank).write.text(path)
    good, bad = raw.scan_jsonl(spark, path)
    return good.agg(F.lit("good").alias("side"), F.count("*").alias("n"), F.sum(F.col("record_id").cast("long")).alias("ids")).unionByName(bad.agg(F.lit("bad").alias("side"), F.count("*").alias("n"), F.lit(None).cast("long").alias("ids")))


@query("jsonl_append", "SELECT event_type AS source, 2 * count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    path, e = shared(spark), V.table(spark, sf, "events").select(F.col("event_type").alias("source"), F.col("event_id").cast("string").alias("record_id"))
    for _k in range(2):
        tables.append_jsonl(e, path)
    return raw.scan_jsonl(spark, path)[0].groupBy("source").agg(F.count("*").alias("n"))


@query("csv_round_trip", "SELECT o_orderkey, o_orderpriority || ',\"' || o_orderstatus AS label, o_totalprice FROM orders")
def _(spark, sf):
    path = shared(spark)
    o = V.table(spark, sf, "orders").select("o_orderkey", F.concat("o_orderpriority", F.lit(',"'), "o_orderstatus").alias("label"), "o_totalprice")
    tables.write_csv(o, path)
    return raw.scan_csv(spark, path, o.schema)


def _orders(spark, sf):
    return V.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query("dataset_replace_append", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 2")
def _(spark, sf):
    root, o = shared(spark), _orders(spark, sf)
    tables.write_dataset(o.filter("o_orderkey % 3 = 2"), root, "silver:orders:records", "replace")
    tables.write_dataset(o.filter("o_orderkey % 3 = 2").withColumn("more", F.lit(1)), root, "silver:other:records", "replace")
    # Replaces the one reference and leaves the other as it is.
    tables.write_dataset(o.filter("o_orderkey % 3 = 0"), root, "silver:orders:records", "replace")
    tables.write_dataset(o.filter("o_orderkey % 3 = 1"), root, "silver:orders:records", "append")
    return tables.read_dataset(spark, root, "silver:orders:records")


@query("dataset_files", "SELECT count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS ids, CAST(sum(o_orderkey * o_custkey) AS BIGINT) AS both, 0 AS files_too_large, true AS enough_files FROM orders")
def _(spark, sf):
    root = shared(spark)
    tables.write_dataset(_orders(spark, sf), root, "gold:load:orders", "replace", rows_per_file=1000)
    files = tables.read_dataset(spark, root, "gold:load:orders").groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("ids"), F.sum((F.col("o_orderkey") * F.col("o_custkey")).cast("decimal(20,0)")).alias("both"))
    # Over millions of orders the products can add up to more than a long holds: they are added as decimals, and such a total is null.
    return files.agg(F.sum("n").alias("n_rows"), F.sum("ids").alias("ids"), F.sum("both").try_cast("bigint").alias("both"), F.count_if(F.col("n") > 1000).cast("int").alias("files_too_large"), (F.count("*") >= F.ceil(F.sum("n") / 1000)).alias("enough_files"))


@query("dataset_deduped", "SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1")
def _(spark, sf):
    root = shared(spark)
    tables.write_deduped(_orders(spark, sf).select("o_custkey", "o_orderkey", "o_totalprice"), root, "silver:orders:last", ["o_custkey"], "o_orderkey")
    return tables.read_dataset(spark, root, "silver:orders:last")


@query("dataset_missing", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 5 = 0")
def _(spark, sf):
    """A missing dataset as the empty frame that a first run joins and unites with."""
    o = _orders(spark, sf)
    missing = tables.read_dataset(spark, shared(spark), "bronze:none:records", o.schema)
    new = o.filter("o_orderkey % 5 = 0")
    return missing.unionByName(new.join(missing.select("o_orderkey"), "o_orderkey", "left_anti").select(*o.columns))


@query("upserted_table", "SELECT o_custkey, max(o_orderkey) AS seq, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1")
def _(spark, sf):
    path, o = shared(spark), V.table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("seq"), "o_totalprice")
    for part in range(3):
        tables.upsert_table(spark, path, o.filter(F.col("seq") % 3 == part), ["o_custkey"], "seq")
    return tables.read_upserted(spark, path)


@query("scan_graph_files", "SELECT 'g' || p_partkey AS GKGRECORDID, p_name || 'é' AS DocumentIdentifier, p_type AS Themes, NULL::VARCHAR AS Extras FROM part")
def _(spark, sf):
    path = shared(spark)
    cells = {"GKGRECORDID": F.concat(F.lit("g"), F.col("p_partkey").cast("string")), "DocumentIdentifier": F.concat("p_name", F.lit("é")), "Themes": F.col("p_type")}
    # Short rows: nothing after the themes.
    names = GKG.names[: GKG.names.index("Themes") + 1]
    line = F.concat_ws("\t", *[cells.get(n, F.lit("x")) for n in names])
    V.table(spark, sf, "part").select(line.alias("value")).write.option("encoding", "ISO-8859-1").csv(path, sep="\x01", quote="", escape="")
    return raw.scan_gkg(spark, path).select("GKGRECORDID", "DocumentIdentifier", "Themes", "Extras")


# A zipped file for every brand; those of brands that end in 1 are cut off.
@query("scan_graph_archives", "SELECT 'row' AS kind, 'g' || p_partkey AS id, p_name || 'é' AS document FROM part WHERE p_brand NOT LIKE '%1' UNION ALL SELECT DISTINCT 'rejected', p_brand, NULL FROM part WHERE p_brand LIKE '%1'")
def _(spark, sf):
    def packed(pdf):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("a.csv", "\n".join(pdf["line"]).encode("latin-1"))
        brand, whole = pdf["p_brand"].iloc[0], out.getvalue()
        return pd.DataFrame({"path": [brand], "content": [whole[: len(whole) // 2] if brand.endswith("1") else whole]})

    names = GKG.names[: GKG.names.index("Themes") + 1]
    cells = {"GKGRECORDID": F.concat(F.lit("g"), F.col("p_partkey").cast("string")), "DocumentIdentifier": F.concat("p_name", F.lit("é"))}
    lines = V.table(spark, sf, "part").select("p_brand", F.concat_ws("\t", *[cells.get(n, F.lit("x")) for n in names]).alias("line"))
    good, bad = raw.gkg_archives(lines.groupBy("p_brand").applyInPandas(packed, "path string, content binary"))
    rows = good.select(F.lit("row").alias("kind"), F.col("GKGRECORDID").alias("id"), F.col("DocumentIdentifier").alias("document"))
    return rows.unionByName(bad.select(F.lit("rejected").alias("kind"), F.col("path").alias("id"), F.lit(None).cast("string").alias("document")))


@query("scan_bulletin_files", "SELECT string_agg(c_name, chr(10) ORDER BY c_custkey) AS response FROM customer GROUP BY c_mktsegment, c_nationkey")
def _(spark, sf):
    path = shared(spark)
    c = V.table(spark, sf, "customer").groupBy("c_mktsegment", "c_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))), lambda s: s["c_name"]), "\n").alias("value"))
    # A file for each group, and as many that hold nothing or an error.
    rest = F.when(F.col("c_nationkey") % 2 == 0, " \r").otherwise("ERROR: no data")
    c.unionByName(c.select("c_mktsegment", (F.col("c_nationkey") + 1000).alias("c_nationkey"), rest.alias("value"))).write.partitionBy("c_mktsegment", "c_nationkey").text(path)
    return raw.scan_bulletins(spark, f"{path}/*/*").select(F.rtrim("response", F.lit("\n")).alias("response"))


@query("build_feature_set", """SELECT 'success' AS status, count(*) AS n_rows, 'written' AS what FROM (SELECT DISTINCT date_trunc('hour', ts), event_type FROM events)
UNION ALL SELECT 'skipped', 0, 'disabled' UNION ALL SELECT 'skipped', 0, 'no input' UNION ALL SELECT 'empty', 0, 'no output'""")
def _(spark, sf):
    root = shared(spark)
    read = lambda: V.events(spark, sf).withColumn("severity_score", F.col("value") / 100)
    build = lambda df: X.hourly_severity(df, "ts", ["event_type"])
    write = lambda df: tables.write_dataset(df, root, "gold:load:severity", "replace")
    runs = [("written", X.build_feature_set(read, build, write)), ("disabled", X.build_feature_set(read, build, write, enabled=False)), ("no input", X.build_feature_set(lambda: read().filter("false"), build, write)), ("no output", X.build_feature_set(read, lambda df: build(df.filter("false")), write))]
    return spark.createDataFrame([(r["status"], r["rows"], what) for what, r in runs], "status string, n_rows long, what string")


def _hourly(spark, sf):
    """An hourly series of all events: its mean value by the hour and the number of events."""
    return V.events(spark, sf).groupBy(F.date_trunc("hour", "ts").alias("observed_at")).agg(F.avg("value").alias("y"), F.count("*").cast("double").alias("x"))


@query("train_and_forecast_jobs", """SELECT 'train' AS job, 'success' AS status, count(*) AS n_rows FROM (SELECT DISTINCT date_trunc('hour', ts) FROM events)
UNION ALL SELECT 'train again', 'skipped', 0 UNION ALL SELECT 'train by force', 'success', (SELECT count(DISTINCT date_trunc('hour', ts)) FROM events)
UNION ALL SELECT 'train without input', 'failure', 0 UNION ALL SELECT 'forecast', 'success', 24 UNION ALL SELECT 'forecast again', 'success', 24 UNION ALL SELECT 'forecast without model', 'failure', 0 UNION ALL SELECT 'forecasts stored', 'success', 24""")
def _(spark, sf):
    models, forecasts = shared(spark), shared(spark)
    read = lambda: _hourly(spark, sf)
    d = J.Definition("ridge", "y", ("x",), validation_days=3, lookback_days=400)
    other = J.Definition("none", "y", ("x",))
    now = datetime(2024, 6, 1)
    runs = [
        ("train", J.train_job(spark, d, read, models, now)), ("train again", J.train_job(spark, d, read, models, datetime(2024, 6, 1, 5))), ("train by force", J.train_job(spark, d, read, models, datetime(2024, 6, 1, 6), force=True)),
        ("train without input", J.train_job(spark, other, lambda: read().filter("false"), models, now)), ("forecast", J.forecast_job(spark, d, read, models, forecasts, now)), ("forecast again", J.forecast_job(spark, d, read, models, forecasts, now)), ("forecast without model", J.forecast_job(spark, other, read, models, forecasts, now)),
    ]
    rows = [(name, r["status"], r.get("rows_written", r["rows_read"])) for name, r in runs]
    rows.append(("forecasts stored", "success", tables.read_upserted(spark, forecasts).count()))
    return spark.createDataFrame(rows, "job string, status string, n_rows long")


@query("ridge_diagnostics", """WITH h AS (SELECT date_trunc('hour', ts) AS t, avg(value) AS y, CAST(count(*) AS DOUBLE) AS x FROM events GROUP BY 1), m AS (SELECT regr_sxy(y, x) / (regr_sxx(y, x) + 1.0) AS b, avg(y) AS my, avg(x) AS mx, stddev_pop(x) AS sx FROM h)
SELECT round(b, 8) AS coefficient, round(abs(b), 8) AS l1_norm, round(abs(b), 8) AS l2_norm, round(mx, 6) AS feature_mean, round(sx, 6) AS feature_scale, round(1 - (SELECT sum((y - my - b * (x - mx)) ** 2) / sum((y - my) ** 2) FROM h), 6) AS training_r2 FROM m""")
def _(spark, sf):
    row = M.gram(_hourly(spark, sf), ["x"], "y").first()
    coef, _shift = M.solve_ridge(row, 1, 1.0)
    d = M.ridge_diagnostics(row, ["x"], coef)
    made = (d["coefficients"]["x"], d["l1_norm"], d["l2_norm"], d["feature_means"]["x"], d["feature_scales"]["x"], d["training_r2"])
    names = ("coefficient", "l1_norm", "l2_norm", "feature_mean", "feature_scale", "training_r2")
    return spark.createDataFrame([made], ", ".join(f"{n} double" for n in names)).select(*[F.round(n, 8 if k < 3 else 6).alias(n) for k, n in enumerate(names)])


# The model's one feature is centred, so its coefficient and intercept follow from the moments; the feature's last value is carried to all steps.
_FITTED = """h AS (SELECT date_trunc('hour', ts) AS t, avg(value) AS y, CAST(count(*) AS DOUBLE) AS x FROM events GROUP BY 1), m AS (SELECT regr_sxy(y, x) / (regr_sxx(y, x) + 1.0) AS b, avg(y) AS my, avg(x) AS mx, max(t) AS origin, arg_max(x, t) AS last_x, count(*) AS n FROM h)"""
_VALUES = f"SELECT CAST(k AS INTEGER) AS horizon, origin + to_hours(CAST(k AS INTEGER)) AS forecast_for_utc, round(my + b * (last_x - mx), 6) AS value FROM m, range(1, 25) t(k)"


@query("trained_model", f"WITH {_FITTED} SELECT 'ridge' AS model_name, round(b, 8) AS coefficient, round(my - b * mx, 6) AS intercept, n AS rows_trained FROM m")
def _(spark, sf):
    models = shared(spark)
    d = J.Definition("ridge", "y", ("x",), validation_days=3, lookback_days=400)
    made = J.train_job(spark, d, lambda: _hourly(spark, sf), models, datetime(2024, 6, 1))
    row = tables.latest_models(tables.read_models(spark, models))
    return row.select("model_name", F.round(F.get("coefficients", F.lit(0)), 8).alias("coefficient"), F.round("intercept", 6).alias("intercept"), F.lit(made["rows_trained"]).cast("long").alias("rows_trained"))


@query("modelling_workflow", f"WITH {_FITTED} {_VALUES}")
def _(spark, sf):
    """Features, dataset, training and forecasting in one run: the forecasts that it stored."""
    root, models, forecasts = shared(spark), shared(spark), shared(spark)
    d = J.Definition("ridge", "y", ("x",), validation_days=3, lookback_days=400)
    build = lambda: [X.build_feature_set(lambda: _hourly(spark, sf), lambda df: df, lambda df: tables.write_dataset(df, root, "gold:load:hourly", "replace"))]
    read = lambda _d: tables.read_dataset(spark, root, "gold:load:hourly")
    J.modelling_workflow(spark, build, build, [d], read, models, forecasts, datetime(2024, 6, 1))
    return tables.read_upserted(spark, f"{forecasts}/ridge").select("horizon", "forecast_for_utc", F.round("value", 6).alias("value"))
