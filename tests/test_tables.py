"""Sources, sinks, upserts, the model table, jobs and guards on temporary folders."""

import gzip  # noqa: F401  Spark reads compressed text alike
import zipfile
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmill.operators import dedupe as D
from gridmill.operators import enrich, explore, features, modelling, serve, vectors, windows
from gridmill.operators.datasets import one_to_one
from gridmill.operators.guards import require_finite, require_unique
from gridmill.plans import jobs
from gridmill.plans import views as V
from gridmill.plans.jobs import FEATURES, Registry, run_incremental
from gridmill.schema import BRONZE, GKG_COLUMNS
from gridmill.sources import raw, tables
from gridmill.sources.ingested import Store


def test_jsonl_bad_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"source":"s","record_id":"1"}\n\n   \nnot json\n[1]\n{"source":"s","record_id":"2","published_at":"2024-01-01T00:00:00Z"}\n')
    good, bad = raw.scan_jsonl(spark, str(tmp_path))
    assert {r.record_id for r in good.collect()} == {"1", "2"} and bad.count() == 2
    strict, _ = raw.scan_jsonl(spark, str(tmp_path), strict=True)
    with pytest.raises(Exception):
        strict.collect()


def test_jsonl_append_adds_files(spark, tmp_path):
    df = spark.createDataFrame([("s", "1", None, None, "{}")], BRONZE)
    for _ in range(2):
        tables.append_jsonl(df, f"{tmp_path}/b")
    assert raw.scan_jsonl(spark, f"{tmp_path}/b")[0].count() == 2


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, 'q"')], "k int, v string")
    tables.write_csv(df, f"{tmp_path}/c")
    assert raw.scan_csv(spark, f"{tmp_path}/c", "k int, v string").orderBy("k").collect() == df.collect()


def test_gkg_files(spark, tmp_path):
    row = "\t".join(f"v{i}" for i in range(27))
    (tmp_path / "a.csv").write_bytes((row + "\n" + "id2\t2024\xe9\n").encode("latin-1"))
    rows = raw.scan_gkg(spark, str(tmp_path)).orderBy("GKGRECORDID").collect()
    assert rows[0].DATE == "2024é" and rows[0].Extras is None and rows[1].Extras == "v26" and list(rows[0].asDict()) == GKG_COLUMNS
    (tmp_path / "b.csv").write_text(row + "\tmore\n")
    with pytest.raises(Exception):
        raw.scan_gkg(spark, str(tmp_path)).collect()


def test_gkg_archives(spark, tmp_path):
    row = "\t".join(f"v{i}" for i in range(27))

    def pack(name, *members):
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_DEFLATED) as z:
            for k, data in enumerate(members):
                z.writestr(f"m{k}.csv", data)

    pack("good.zip", (row + "\r\n\n" + "id2\t2024\xe9\t\n").encode("latin-1"), b"not\tread")
    pack("long.zip", "\n".join(f"n{i}\t{i}" for i in range(25_000)).encode())
    pack("wide.zip", (row + "\n" + row + "\tmore\n").encode())
    pack("empty.zip")
    pack("blank.zip", b"")
    whole = (tmp_path / "long.zip").read_bytes()
    (tmp_path / "cut.zip").write_bytes(whole[: len(whole) // 2])
    middle = len(whole) // 2
    (tmp_path / "flip.zip").write_bytes(whole[:middle] + bytes(64) + whole[middle + 64 :])
    (tmp_path / "none.zip").write_bytes(b"")
    good, bad = raw.scan_gkg_archives(spark, f"{tmp_path}/*.zip")
    by = {}
    for r in good.collect():
        by.setdefault(r.path.rsplit("/", 1)[1], []).append(r)
    assert {k: len(v) for k, v in by.items()} == {"good.zip": 2, "long.zip": 25_000}
    first, second = sorted(by["good.zip"], key=lambda r: r.Extras is None)
    assert first.Extras == "v26" and (second.DATE, second.SourceCollectionIdentifier, second.Extras) == ("2024\xe9", None, None)
    assert list(first.asDict()) == ["path", *GKG_COLUMNS]
    assert {r.path.rsplit("/", 1)[1] for r in bad.collect()} == {"wide.zip", "empty.zip", "cut.zip", "flip.zip"}  # Spark lists no file of no bytes


def test_bulletin_and_nested_scans(spark, tmp_path):
    for name, text in (("AFDIND.txt", "body"), ("EMPTY.txt", " \n"), ("ERR.txt", "ERROR: no")):
        (tmp_path / "b").mkdir(exist_ok=True)
        (tmp_path / "b" / name).write_text(text)
    assert [tuple(r) for r in raw.scan_bulletins(spark, f"{tmp_path}/b").collect()] == [("AFDIND", "body")]
    (tmp_path / "n").mkdir()
    (tmp_path / "n/a.json").write_text('{"topic": "x",\n "items": [{"id": 1}, {"id": 2}]}')
    (tmp_path / "n/b.json").write_text('{"topic": "y", "items": []}')
    rows = raw.scan_nested(spark, f"{tmp_path}/n", "topic string, items array<struct<id long>>", "items").collect()
    assert sorted((r.topic, r.item.id if r.item else None) for r in rows if r.item) == [("x", 1), ("x", 2)] and len(rows) == 3


def test_scan_reads_only_the_named_columns(spark, sf):
    plan = raw.scan_parquet(spark, f"{sf}/documents.parquet", "doc_id").filter("doc_id > 5")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in plan and "PushedFilters: [IsNotNull(doc_id), GreaterThan(doc_id,5)]" in plan


def test_datasets_by_reference(spark, tmp_path):
    a, b = (spark.createDataFrame([(i, x)], "k int, v string") for i, x in ((1, "a"), (2, "b")))
    root = str(tmp_path)
    tables.write_dataset(a, root, "silver:eia:records", "replace")
    tables.write_dataset(b, root, "silver:eia:records", "append")
    tables.write_dataset(b.withColumn("extra", F.lit(1)), root, "silver:nws:records", "replace")
    got = tables.read_dataset(spark, root, "silver:eia:records")
    assert sorted(got.select("k").collect()) == [(1,), (2,)]
    assert "PartitionFilters: [isnotnull(source" in got._jdf.queryExecution().toString()
    tables.write_dataset(a, root, "silver:eia:records", "replace")
    assert tables.read_dataset(spark, root, "silver:eia:records").count() == 1 and tables.read_dataset(spark, root, "silver:nws:records").count() == 1
    tables.write_dataset(a, root, "gold:load:features", "replace")
    assert (tmp_path / "gold/features/dataset=load").is_dir()
    assert tables.read_dataset(spark, root, "bronze:none:records", BRONZE).count() == 0
    for wrong in ("silver:eia", "tin:a:b", "silver::x"):
        with pytest.raises(ValueError):
            tables.DatasetRef.parse(wrong)
    with pytest.raises(ValueError):
        tables.write_dataset(a, root, "silver:eia:records", "other")


def test_bounded_files_and_deduped_write(spark, tmp_path):
    tables.write_dataset(spark.range(250).coalesce(1).withColumnRenamed("id", "k"), str(tmp_path), "silver:s:t", "replace", rows_per_file=100)
    assert len(list((tmp_path / "silver/source=s/artifact=t").glob("*.parquet"))) == 3
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, seq int, v string")
    for keep, want in (("first", {"a", "c"}), ("last", {"b", "c"}), (False, {"c"})):
        tables.write_deduped(df, str(tmp_path), "silver:s:d", ["k"], "seq", keep)
        assert {r.v for r in tables.read_dataset(spark, str(tmp_path), "silver:s:d").collect()} == want
    with pytest.raises(ValueError):
        D.dedupe(df, ["nope"], "seq")
    with pytest.raises(ValueError):
        D.dedupe(df, ["k"], "seq", "middle")


def test_upserted_table(spark, tmp_path):
    path = f"{tmp_path}/f"
    row = lambda *rows: spark.createDataFrame(list(rows), "id string, seq int, v int")
    with pytest.raises(ValueError):
        tables.read_upserted(spark, path)
    assert tables.upsert_table(spark, path, row(("a", 1, 1), ("b", 1, 1)), ["id"], "seq") == 0
    assert tables.upsert_table(spark, path, row(("a", 2, 9)), ["id"], "seq") == 1
    assert {r.id: r.v for r in tables.read_upserted(spark, path).collect()} == {"a": 9, "b": 1}
    with pytest.raises(ValueError):
        tables.upsert_table(spark, path, row(("a", 2, 9)).drop("v"), ["id"], "seq")


def test_model_versions(spark, tmp_path):
    path = f"{tmp_path}/m"
    make = lambda v, d: {"model_name": "ridge", "version": v, "trained_at": datetime(2024, 1, d), "target": "y", "features": ["x"], "coefficients": [1.0], "intercept": 0.0, "metrics": {"mae": 1.0}}
    assert tables.read_models(spark, path).count() == 0
    tables.write_model(spark, path, make("b", 2))
    tables.write_model(spark, path, make("a", 1))
    assert [r.version for r in tables.read_models(spark, path).collect()] == ["a", "b"]
    assert tables.latest_models(tables.read_models(spark, path)).first().version == "b"
    with pytest.raises(ValueError):
        tables.write_model(spark, path, make("a", 3))


def test_incremental_run_twice(spark, tmp_path):
    landed = spark.createDataFrame([("1", datetime(2024, 1, 1)), ("1", datetime(2024, 1, 2)), ("2", datetime(2024, 1, 3)), ("3", datetime(2024, 2, 3))], "record_id string, published_at timestamp")
    go = lambda end: run_incremental(spark, landed, f"{tmp_path}/t", "published_at", 5, end)
    assert go(datetime(2024, 1, 4)) == {"received": 3, "written": 2, "skipped": 1}
    assert go(datetime(2024, 1, 4)) == {"received": 3, "written": 0, "skipped": 3}
    assert go(datetime(2024, 3, 1))["written"] == 1
    assert sorted(r[0] for r in Store(spark, f"{tmp_path}/t", landed.schema).read().collect()) == ["1", "2", "3"]


def test_registry_and_feature_job(spark):
    r = Registry()
    r.register("a", features.region_daily)
    with pytest.raises(ValueError):
        r.register("a", features.region_daily)
    with pytest.raises(KeyError):
        r.get("b")
    assert FEATURES.get("region_hourly") is features.region_hourly
    df, kept = spark.range(3), []
    run = features.build_feature_set
    assert run(lambda: df, lambda d: d, kept.append, enabled=False)["status"] == "skipped"
    assert run(lambda: df.limit(0), lambda d: d, kept.append)["status"] == "skipped" and run(lambda: df, lambda d: d.limit(0), kept.append)["status"] == "empty"
    assert run(lambda: df, lambda d: d, kept.append) == {"status": "success", "rows": 3} and len(kept) == 1


def test_guards(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan"))], "k string, v double")
    with pytest.raises(ValueError):
        require_unique(df, "k")
    with pytest.raises(ValueError):
        require_finite(df, "v")
    with pytest.raises(ValueError):
        require_finite(df.limit(0), "v")
    with pytest.raises(ValueError):
        require_finite(df, "nope")
    with pytest.raises(ValueError):
        features.long_to_wide(df.withColumn("var", F.lit("x")), ["k"], "var", "v", ["x"])
    with pytest.raises(ValueError):
        features.add_lags(df, "v", [0], ["k"], "v")
    with pytest.raises(ValueError):
        features.expand_dimensions(df.withColumn("m", F.create_map(F.lit("k"), F.lit("x"))), "m", ["k"])
    for bad in (lambda: serve.page(df, ["k"], 0, 0), lambda: serve.page(df, ["k"], 10, -1), lambda: windows.backfill_windows(spark, datetime(2024, 1, 2), datetime(2024, 1, 1), 1), lambda: windows.backfill_windows(spark, datetime(2024, 1, 1), datetime(2024, 1, 2), 0), lambda: windows.incremental_start(F.lit(None), F.lit(None), -1), lambda: windows.direction_filter("a", "k", "k", "sideways"), lambda: modelling.future_grid(F.lit(None), 1, "1w"), lambda: modelling.prepare_time(df.limit(0), "k"), lambda: modelling.time_split(df, "k", datetime(2024, 1, 2), datetime(2024, 1, 2), 1)):
        with pytest.raises(ValueError):
            bad()
    assert windows.backfill_windows(spark, datetime(2024, 1, 1), datetime(2024, 1, 1), 1).count() == 0


def test_clock_changes(spark):
    hours = spark.sql("select explode(sequence(timestamp'2024-11-03 03:00:00', timestamp'2024-11-03 08:00:00', interval 1 hour)) as t")
    local = [r[0] for r in hours.select(features.local_time("t")).collect()]
    assert local.count(datetime(2024, 11, 3, 1)) == 2
    grid = lambda step: [r[0] for r in spark.range(1).select(F.explode(modelling.future_grid(F.lit(datetime(2024, 3, 9, 5)).cast("timestamp"), 2, step))).collect()]
    assert grid("1d") == [datetime(2024, 3, 10, 5), datetime(2024, 3, 11, 4)] and grid("24h") == [datetime(2024, 3, 10, 5), datetime(2024, 3, 11, 5)]
    days = spark.createDataFrame([(datetime(2024, 3, 10, 3), "r", 1.0, None), (datetime(2024, 3, 10, 6), "r", 3.0, None), (datetime(2024, 3, 11, 3), None, 1.0, None)], "observed_at timestamp, region string, actual_load double, net_generation double")
    rows = features.region_daily(days).orderBy("observed_at").collect()
    assert [r.observed_at for r in rows] == [datetime(2024, 3, 9, 5), datetime(2024, 3, 10, 5)] and rows[0].generation_sum == 0.0


def test_holidays():
    days = {str(d) for d in features.federal_holidays(2020, 2022)}
    assert {"2021-12-31", "2021-07-05", "2020-07-03", "2021-06-18", "2022-06-20", "2020-11-26", "2022-05-30", "2021-01-18"} <= days
    assert not {"2020-06-19", "2022-01-01"} & days


def test_autoregression_is_exact_without_noise(spark):
    y = [1.0, 2.0]
    for _ in range(60):
        y.append(0.6 * y[-1] - 0.3 * y[-2] + 1.0)
    at = lambda i: datetime(2024, 1, 1) + timedelta(hours=i)
    rows = [("s", at(i), v) for i, v in enumerate(y[:50])] + [("short", at(0), 7.0)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    out = modelling.arx_forecast(df, "v", "t", ["k"], [1, 2], 5, alpha=1e-12).collect()
    got = [r.forecast for r in sorted(out, key=lambda r: r.horizon) if r.k == "s"]
    assert np.allclose(got, y[50:55], atol=1e-6) and {r.forecast for r in out if r.k == "short"} == {7.0}


def two_regressions(v, x, lags, ma, season, many):
    """The coefficients by plain arrays."""
    y = v[season:] - v[: len(v) - season] if season else v
    x = x[season:]
    ols = lambda a, b: np.linalg.lstsq(np.column_stack([*a, np.ones(len(b))]), b, rcond=None)[0]
    n = len(y)
    first = [y[many - k : n - k] for k in range(1, many + 1)] + [x[many:]]
    e = np.full(n, np.nan)
    e[many:] = y[many:] - np.column_stack([*first, np.ones(n - many)]) @ ols(first, y[many:])
    start = many + max(ma)
    second = [y[start - k : n - k] for k in lags] + [e[start - k : n - k] for k in ma] + [x[start:]]
    return ols(second, y[start:]), y, e


@pytest.mark.parametrize(("season", "chunk"), [(0, 40), (0, None), (12, 60)])
def test_shocks_and_exogenous_terms_against_brute_force(spark, season, chunk):
    rng = np.random.default_rng(11)
    lags, ma, many, steps = [1, 3], [1, 2], 7, 6
    series = {}
    for k, n in (("a", 400), ("b", 250)):
        x, shock, v = rng.normal(size=n + steps), rng.normal(size=n), np.zeros(n)
        for t in range(n):
            v[t] = 0.5 * (v[t - 1] if t else 0) + 0.4 * (shock[t - 1] if t else 0) + 2 * x[t] + shock[t] + 5 * np.sin(t / 12 * 2 * np.pi)
        series[k] = (v, x)
    at = lambda i: datetime(2024, 1, 1) + timedelta(hours=7 * i)  # noqa: E731  over several months
    df = spark.createDataFrame([(k, at(i), float(v[i]), float(x[i])) for k, (v, x) in series.items() for i in range(len(v))], "k string, t timestamp, v double, x double").repartition(5)
    future = spark.createDataFrame([(k, h, float(x[len(v) + h - 1])) for k, (v, x) in series.items() for h in range(1, steps + 1) if (k, h) != ("b", 5)], "k string, horizon int, x double")
    coefs, _ = modelling.arx_fit(df, "v", "t", ["k"], lags, season, 0.0, ma, ["x"], many, chunk)
    out = modelling.arx_forecast(df, "v", "t", ["k"], lags, steps, season, 0.0, ma, ["x"], future, many, chunk)
    assert "InPandas" not in (plan := out._jdf.queryExecution().executedPlan().toString()) or "FlatMapGroups" not in plan
    got = {}
    for r in out.collect():
        got.setdefault(r.k, {})[r.horizon] = r.forecast
    for r in coefs.collect():
        v, x = series[r.k]
        want, y, e = two_regressions(v, x[: len(v)], lags, ma, season, many)
        assert np.allclose([*r.coef, r.intercept], want, atol=1e-6)
        ys, es, levels = list(y), list(e), list(v)
        for h in range(1, steps + 1):
            terms = [ys[-k] for k in lags] + [es[-k] for k in ma] + [x[len(v) + h - 1], 1.0]
            ys.append(float(np.dot(terms, want)))
            es.append(0.0)
            levels.append(ys[-1] + (levels[-season] if season else 0.0))
            if (r.k, h) >= ("b", 5):
                assert got[r.k][h] is None
            else:
                assert abs(got[r.k][h] - levels[-1]) < 1e-5


def test_ridge_against_the_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3)) * [1, 5, 0.1]
    y = x @ [1.0, -2.0, 3.0] + 4 + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, y double")
    for scale in (False, True):
        coef, intercept = modelling.fit_ridge(df, ["a", "b", "c"], "y", 3.0, scale)
        w = x.std(axis=0) if scale else np.ones(3)
        z = (x - x.mean(axis=0)) / w
        want = np.linalg.solve(z.T @ z + 3 * np.eye(3), z.T @ (y - y.mean())) / w
        assert np.allclose(coef, want) and np.isclose(intercept, y.mean() - x.mean(axis=0) @ want)


def test_pluggable_encoder(spark):
    df = spark.createDataFrame([(1, "aa"), (2, "b")], "k long, t string").coalesce(1)
    rows = vectors.encode(df, "t", lambda texts: np.array([[len(t), 1] for t in texts]), "toy").collect()
    assert [list(r.embedding) for r in rows] == [[2.0, 1.0], [1.0, 1.0]] and rows[0].embedding_model == "toy"

    def broken(texts):
        raise RuntimeError("down")

    assert vectors.encode(df, "t", broken, "toy").filter("embedding is null").count() == 2


def test_one_pass_totals_equal_the_join(spark, sf):
    f = V.flows(spark, sf)
    a, b = features.interchange_totals(f, V.OWN), features.interchange_totals_by_join(f, V.OWN)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert enrich.count_failed(spark.createDataFrame([("success",), (None,)], "s string"), "s").first() == (2, 1)


def test_null_orders_and_ties(spark):
    rows = [("a", None, 1), ("b", None, 1), ("b", 5, 2), ("b", 5, 3), ("b", 7, 0), (None, 1, 4), (None, 2, 5)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    last = {r.k: (r.t, r.v) for r in D.dedupe(df, ["k"], "t", "last").collect()}
    assert last == {"a": (None, 1), "b": (7, 0), None: (2, 5)}
    first = {r.k: (r.t, r.v) for r in D.dedupe(df, ["k"], "t", "first").collect()}
    assert first == {"a": (None, 1), "b": (5, 2), None: (1, 4)}
    mapped = df.withColumn("m", F.create_map(F.lit("x"), F.col("v")))
    assert {r.k: r.v for r in D.dedupe(mapped, ["k"], "t", "last").collect()} == {"a": 1, "b": 0, None: 5}
    assert D.append_new(df.limit(0), df.filter("k = 'a'"), "k", "t").collect() == [("a", None, 1)]
    once = df.filter("k = 'a' or v = 5")
    assert D.dedupe(once, ["k"], "t", False).count() == 2


def test_backfill_stops_and_goes_on(spark, tmp_path):
    landed = spark.createDataFrame([(str(i), datetime(2024, 1, 1 + i)) for i in range(9)], "record_id string, at timestamp")
    table, seen = f"{tmp_path}/t", []
    run = lambda ingest=None: jobs.backfill_run(spark, landed, table, "at", datetime(2024, 1, 1), datetime(2024, 1, 10), 3, ingest=ingest)

    def second_fails(a, b):
        seen.append(a)
        if a == datetime(2024, 1, 4):
            raise RuntimeError("down")
        return Store(spark, table, landed.schema).append(landed.filter((F.col("at") >= a) & (F.col("at") < b)), "at", b)

    out = run(second_fails)
    assert out["status"] == "failure" and [w["status"] for w in out["windows"]] == ["success", "failure"] and len(seen) == 2 and out["last_window_end"] == datetime(2024, 1, 4)
    out = run()
    assert out["status"] == "success" and [w["window_no"] for w in out["windows"]] == [1, 2] and out["written"] == 6
    assert run()["windows"] == [] and Store(spark, table, landed.schema).read().count() == 9


def test_train_and_forecast_jobs(spark, tmp_path):
    rows = [(datetime(2024, 1, 1) + timedelta(hours=h), float(h % 24), 3.0 * (h % 24) + 1) for h in range(24 * 20)]
    data = spark.createDataFrame(rows, "observed_at timestamp, x double, y double")
    d = jobs.Definition("m", "y", ("x", "hour"), alpha=1e-9, validation_days=2, lookback_days=30, retrain_after_hours=24, steps=3)
    data = data.withColumn("hour", F.hour("observed_at"))
    models, out, now = f"{tmp_path}/m", f"{tmp_path}/f", datetime(2024, 2, 1)
    assert jobs.forecast_job(spark, d, lambda: data, models, out, now)["status"] == "failure"
    made = jobs.train_job(spark, d, lambda: data.drop("hour").withColumn("hour", F.rand(1)), models, now)
    assert made["status"] == "success" and made["reason"] == "never trained" and made["metrics"]["rmse"] < 1e-3 and abs(made["diagnostics"]["training_r2"] - 1) < 1e-6
    assert jobs.train_job(spark, d, lambda: data, models, now + timedelta(hours=1))["status"] == "skipped"
    assert jobs.train_job(spark, d, lambda: data.filter("false"), models, now + timedelta(hours=30)) | {"error": ""} == {"name": "m", "rows_read": 0, "status": "failure", "error": ""}
    assert jobs.train_job(spark, jobs.Definition("m", "y", ("x",), retrain_after_hours=None), lambda: data, models, now)["status"] == "skipped"
    for _ in range(2):
        got = jobs.forecast_job(spark, d, lambda: data, models, out, now)
        assert got["status"] == "success" and got["rows_written"] == 3
    saved = tables.read_upserted(spark, out).orderBy("forecast_for_utc").collect()
    assert len(saved) == 3 and saved[0].forecast_for_utc == datetime(2024, 1, 21) and all(abs(r.value - 70.0) < 1.0 for r in saved)
    gap = data.withColumn("x", F.lit(None).cast("double"))
    assert "non-finite" in jobs.forecast_job(spark, d, lambda: gap, models, out, now)["error"]


def test_workflows_stop_on_failure():
    seen = []
    stage = lambda name, status="success": (name, lambda: (seen.append(name), [{"status": status}])[1])
    assert list(jobs.workflow(stage("a"), stage("b", "skipped"))) == ["a", "b"]
    with pytest.raises(RuntimeError, match="bad failed for 1 item"):
        jobs.workflow(stage("a"), stage("bad", "failure"), stage("never"))
    assert "never" not in seen
    ok = lambda: [{"status": "success"}]
    assert list(jobs.text_workflow(ok, ok, ok, ok)) == ["ingestion", "standardization", "scraping", "embeddings"]
    with pytest.raises(RuntimeError):
        jobs.historical_workflow(lambda: {"status": "failure"}, ("features", ok))


def test_checks_in_the_plan(spark):
    twice = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 2.0)], "k string, var string, v double")
    assert features.long_to_wide(twice.limit(1), ["k"], "var", "v", ["x", "y"], "plan").collect() == [("a", 1.0, None)]
    with pytest.raises(Exception, match="two rows"):
        features.long_to_wide(twice, ["k"], "var", "v", ["x"], "plan").collect()
    one = twice.select("k", F.lit(1).alias("w")).limit(1)
    with pytest.raises(Exception, match="not unique"):
        one_to_one(one, twice, ["k"], check="plan").collect()
    assert one_to_one(one, twice.limit(1), ["k"], check="plan").count() == 1


def test_quantiles_clusters_and_large_values(spark):
    rng = np.random.default_rng(2)
    values = [("a", float(v)) for v in rng.integers(0, 40, 301)] + [("b", 5.0), ("c", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(values, "g string, v double")
    rows = {r.g: r for r in explore.describe(df, "v", "g").collect()}
    own = [v for g, v in values if g == "a"]
    assert (rows["a"].p25, rows["a"].p50, rows["a"].p75) == tuple(np.quantile(own, [0.25, 0.5, 0.75])) and rows["b"].p50 == 5.0 and rows["c"].p50 is None and rows[None].p50 == 1.5
    assert explore.describe(df, "v").first().p50 == np.quantile([v for _, v in values if v is not None], 0.5)
    x = rng.normal(size=500)
    big = spark.createDataFrame([(1e9 + float(a), 3 * float(a) + 1e9) for a in x], "x double, y double")
    coef, _ = modelling.fit_ridge(big, ["x"], "y", 0.0)
    assert abs(coef[0] - 3) < 1e-3
    points = spark.createDataFrame([(i, [float(i % 3) * 10, float(i % 3)]) for i in range(30)], "k int, v array<double>")
    sweep = {r.k: r.inertia for r in vectors.inertia_sweep(points, "v", [2, 3]).collect()}
    assert sweep[3] < 1e-6 < sweep[2]
    p = vectors.pca(points, "v").collect()
    assert abs(sum(r.projection[0] for r in p)) < 1e-6 and max(abs(r.projection[1]) for r in p) < 1e-6


def test_nearest_rows_match_brute_force(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(300, 8)).round(1)
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(900, [0.0] * 8), (901, None), (902, []), (950, [1.0] * 7), (951, [1.0, None] * 4), (952, [float("nan")] * 8)]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    got = {}
    for r in vectors.cosine_topk(df.filter("k % 50 = 0"), df, "k", "v", 4, block=3).collect():
        got.setdefault(r.query, {})[r["rank"]] = r.match
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    for q in range(0, 300, 50):
        score = np.round(unit @ unit[q], 9)
        order = [i for i in np.lexsort((np.arange(300), -score)) if i != q][:4]
        assert [got[q][k] for k in range(1, 5)] == order
    assert set(got) == set(range(0, 300, 50))


def test_chunks_do_not_change_lags(spark):
    rows = [(g, datetime(2024, 1, 1) + timedelta(hours=31 * i), float(i) if i % 7 else None) for g, n in (("a", 90), ("b", 3), (None, 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, t timestamp, v double").repartition(3)
    key = lambda d: sorted(map(tuple, d.collect()), key=repr)
    for chunk in (1, 5, 17, 1000):
        assert key(features.add_lags(df, "v", [1, 4, 9], ["g"], "t", chunk)) == key(features.add_lags(df, "v", [1, 4, 9], ["g"], "t"))
        assert key(features.add_rolling_means(df, ["v"], [2, 5], ["g"], "t", chunk)) == key(features.add_rolling_means(df, ["v"], [2, 5], ["g"], "t"))


def test_samples_and_hashed_vectors(spark):
    df = spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    first = [r.k for r in explore.hash_sample(df, "k", 20).collect()]
    assert len(set(first)) == 20 and first == [r.k for r in explore.hash_sample(df.repartition(7), "k", 20).collect()] != [r.k for r in explore.hash_sample(df, "k", 20, seed=1).collect()]
    texts = spark.createDataFrame([(1, "b a A"), (2, "a b a"), (3, " "), (4, None), (5, "c")], "k int, t string")
    rows = {r.k: np.array(r.embedding) for r in vectors.hashing_vectors(texts, "t", 32).collect()}
    assert np.allclose(rows[1], rows[2]) and np.isclose(np.linalg.norm(rows[1]), 1) and not rows[3].any() and not rows[4].any() and np.isclose(rows[5].max(), 1)
    assert sorted(rows[1][rows[1] > 0].round(6).tolist()) in ([round(5**-0.5, 6), round(2 * 5**-0.5, 6)], [1.0])


def test_quartiles_are_selected_from_what_lies_between(spark, monkeypatch):
    """Groups larger than the limit, with ties, one value, extremes and infinities, against numpy; no window holds a group."""
    monkeypatch.setattr(explore, "SMALL", 50)
    monkeypatch.setattr(explore, "RANKS", 40)
    rng = np.random.default_rng(7)
    groups = {"even": rng.normal(size=5001), "ties": rng.integers(0, 3, 4000).astype(float), "one": np.full(800, 2.5), "wide": 10.0 ** rng.uniform(-300, 300, 3000), "small": rng.normal(size=7), "ends": np.concatenate([rng.normal(size=300), [np.inf, -np.inf]])}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("even", None), (None, 1.0), (None, 4.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r for r in explore.describe(df, "v", "g").collect()}
    for g, v in groups.items():
        assert (got[g].n, got[g].min, got[g].max) == (len(v), v.min(), v.max())
        assert np.allclose([got[g].p25, got[g].p50, got[g].p75], np.quantile(v, [0.25, 0.5, 0.75]), rtol=1e-12, atol=0)
    assert (got[None].p25, got[None].p50) == (1.75, 2.5) and got["none"].n == 0 and got["none"].p50 is None
    both = [x for g, x in rows if x is not None]
    assert explore.describe(df, "v").first().p50 == np.quantile(both, 0.5)
    assert explore.describe(df.filter("false"), "v", "g").count() == 0
