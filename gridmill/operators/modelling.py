"""Forecast modelling as data jobs (rows M01 to M22). Fits are sums over the rows; only p by p systems are solved on the driver."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.functions.scalars import format_utc
from gridmill.operators.features import CHUNK, EASTERN, add_calendar, add_holiday, add_lags, local_time, ranked
from gridmill.operators.guards import require_columns, require_finite

EPS = 2.220446049250313e-16


def prepare_time(df: DataFrame, time: str) -> DataFrame:
    """The data with a timestamp column in UTC; no rows, no such column or a null stamp is an error. Order comes with the windows that need it."""
    require_columns(df, time)
    out = df.withColumn(time, F.col(time).cast("timestamp"))
    row = out.agg(F.count("*").alias("n"), F.count_if(F.col(time).isNull()).alias("bad")).first()
    if not row.n or row.bad:
        raise ValueError("no rows" if not row.n else "timestamps that are null or unreadable")
    return out


def time_split(df: DataFrame, time: str, start: datetime, end: datetime, lookback_days: int) -> DataFrame:
    """Rows of [start - lookback, start) as train and of [start, end) as validation, in a column ``split``."""
    if end <= start or lookback_days < 1:
        raise ValueError("bounds must be in order and the lookback positive")
    t, a, b = F.col(time), F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    kept = df.filter((t >= a - F.make_interval(days=F.lit(lookback_days))) & (t < b))
    return kept.withColumn("split", F.when(t < a, "train").otherwise("validation"))


def split_bounds(split: DataFrame, time: str) -> DataFrame:
    """Observed bounds and rows of each side."""
    return split.groupBy("split").agg(F.min(time).alias("first"), F.max(time).alias("last"), F.count("*").alias("n"))


def require_both_sides(split: DataFrame) -> None:
    if {r[0] for r in split.select("split").distinct().collect()} < {"train", "validation"}:
        raise ValueError("a side of the split is empty")


def latest_split(df: DataFrame, time: str, validation_days: int, lookback_days: int) -> DataFrame:
    """The last days, newest row included, are validation; the lookback before them is training."""
    if validation_days < 1 or lookback_days < 1:
        raise ValueError("days must be positive")
    edge = df.agg(F.max(time).alias("_max")).select((F.col("_max") - F.make_interval(days=F.lit(validation_days))).alias("_edge"), (F.col("_max") - F.make_interval(days=F.lit(validation_days + lookback_days))).alias("_start"))
    both = df.join(F.broadcast(edge), (F.col(time) > F.col("_start")))
    return both.withColumn("split", F.when(F.col(time) > F.col("_edge"), "validation").otherwise("train")).drop("_edge", "_start")


def folds(first: datetime, count: int, step_days: int, validation_days: int, lookback_days: int) -> list[tuple[int, datetime, datetime, datetime]]:
    """Rolling origins, oldest first: fold, start of training, start and end of validation."""
    if min(count, step_days, validation_days, lookback_days) < 1:
        raise ValueError("counts and days must be positive")
    day = lambda n: timedelta(days=n)
    return [(k, first + day(k * step_days - lookback_days), first + day(k * step_days), first + day(k * step_days + validation_days)) for k in range(count)]


def rolling_splits(df: DataFrame, time: str, spec: list[tuple[int, datetime, datetime, datetime]]) -> DataFrame:
    """Every row once for each fold it is in, labelled train or validation. The fold list is an argument, so each row is matched against it in place."""
    t = F.col(time)
    lit = lambda d: F.lit(d).cast("timestamp")
    of = [F.when((t >= lit(a)) & (t < lit(c)), F.struct(F.lit(k).alias("fold"), F.when(t < lit(b), "train").otherwise("validation").alias("split"))) for k, a, b, c in spec]
    return df.withColumn("_f", F.explode(F.array_compact(F.array(*of)))).select(*df.columns, "_f.fold", "_f.split")


def regression_metrics(df: DataFrame, actual: str, predicted: str, *by: str) -> DataFrame:
    """MAE, RMSE, MAPE (a fraction) and R2, per group if any."""
    y, p = F.col(actual), F.col(predicted)
    e = y - p
    # The total sum of squares from moments about nothing would lose digits; var_pop does not.
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(EPS))).alias("mape"), (1 - F.sum(e * e) / F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0))).alias("r2"))


def _moments(features: list[str], target: str) -> list[Column]:
    """n, means and central products; products about the mean lose no digits to large values, as sums of raw products would."""
    cols = [*features, target]
    d = lambda c: F.col(c).cast("double")
    return [F.count("*").alias("n"), *[F.avg(d(c)).alias(f"m_{i}") for i, c in enumerate(cols)], *[F.covar_pop(d(a), d(b)).alias(f"c_{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j]]


def gram(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """What a least-squares fit needs, one row: n, means and covariances. Rows with a null feature or target are left out."""
    return df.dropna(subset=[*features, target]).agg(*_moments(features, target))


def solve_ridge(row, p: int, alpha: float, scale: bool = False) -> tuple[np.ndarray, float]:
    """Coefficients and intercept from the sums; the intercept is not penalised."""
    n = row["n"]
    if not n:
        raise ValueError("no rows to fit")
    m = np.array([row[f"m_{i}"] for i in range(p + 1)])
    both = n * np.array([[row[f"c_{min(i, j)}_{max(i, j)}"] for j in range(p + 1)] for i in range(p + 1)])
    width = np.sqrt(np.maximum(np.diag(both)[:p] / n, 0)) if scale else np.ones(p)
    width[width == 0] = 1
    a = both[:p, :p] / np.outer(width, width)
    coef = np.linalg.solve(a + alpha * np.eye(p), both[:p, p] / width) / width
    return coef, float(m[p] - coef @ m[:p])


def ridge_diagnostics(row, features: list[str], coef: np.ndarray) -> dict:
    """Coefficients by name with their norms, the training R2, and the features' means and deviations, all from the sums of the fit."""
    p = len(features)
    cov = np.array([[row[f"c_{min(i, j)}_{max(i, j)}"] for j in range(p + 1)] for i in range(p + 1)])
    explained = 2 * coef @ cov[:p, p] - coef @ cov[:p, :p] @ coef
    return {
        "coefficients": dict(zip(features, map(float, coef))), "l1_norm": float(np.abs(coef).sum()), "l2_norm": float(np.sqrt(coef @ coef)), "training_r2": float(explained / cov[p, p]) if cov[p, p] > 0 else float("nan"),
        "feature_means": {f: float(row[f"m_{i}"]) for i, f in enumerate(features)}, "feature_scales": {f: float(np.sqrt(max(cov[i, i], 0.0))) for i, f in enumerate(features)},
    }


def fit_ridge(df: DataFrame, features: list[str], target: str, alpha: float = 1.0, scale: bool = False) -> tuple[np.ndarray, float]:
    """Ridge regression by one aggregation."""
    require_columns(df, target, *features)
    return solve_ridge(gram(df, features, target).first(), len(features), alpha, scale)


def linear(features: list[str], coef, intercept: float) -> Column:
    """The model as a column."""
    total = F.lit(float(intercept))
    for f, c in zip(features, coef):
        total = total + F.col(f).cast("double") * F.lit(float(c))
    return total


def residual_stats(df: DataFrame, actual: str, predicted: str, n_params: int) -> DataFrame:
    """Count, mean, deviation and range of the residuals, with Gaussian AIC and BIC."""
    e = F.col(actual) - F.col(predicted)
    base = df.agg(F.count("*").alias("n"), F.avg(e).alias("residual_mean"), F.stddev_samp(e).alias("residual_std"), F.min(e).alias("residual_min"), F.max(e).alias("residual_max"), F.sum(e * e).alias("sse"))
    log_lik = -F.col("n") / 2 * (F.log(2 * F.pi() * F.col("sse") / F.col("n")) + 1)
    return base.select("*", (2 * n_params - 2 * log_lik).alias("aic"), (n_params * F.log("n") - 2 * log_lik).alias("bic"))


def train(df: DataFrame, features: list[str], target: str, time: str, alpha: float, validation_days: int, lookback_days: int) -> dict:
    """Project, drop rows with nulls, split, fit, score, and fit again on both sides; with the diagnostics of the last fit."""
    data = prepare_time(df.select(time, *features, target).dropna(), time)
    split = latest_split(data, time, validation_days, lookback_days)
    require_both_sides(split)
    coef, intercept = fit_ridge(split.filter("split = 'train'"), features, target, alpha)
    scores = regression_metrics(split.filter("split = 'validation'").withColumn("_p", linear(features, coef, intercept)), target, "_p").first()
    row = gram(split, features, target).first()
    final, shift = solve_ridge(row, len(features), alpha)
    return {"coefficients": final.tolist(), "intercept": shift, "metrics": {k: scores[k] for k in ("mae", "rmse", "mape", "r2")}, "rows": row["n"], "diagnostics": ridge_diagnostics(row, features, final)}


def _differenced(df: DataFrame, value: str, time: str, group: list[str], season: int, chunk: int | None) -> DataFrame:
    """``df`` with ``y``: the value, less that of a season before if there is a season."""
    if not season:
        return df.withColumn("y", F.col(value))
    lagged = f"{value}_lag_{season}"
    return add_lags(df, value, [season], group, time, chunk).withColumn("y", F.col(value) - F.col(lagged)).drop(lagged)


def arx_design(df: DataFrame, value: str, time: str, group: list[str], lags: list[int], season: int = 0, chunk: int | None = CHUNK) -> DataFrame:
    """The rows of an autoregression: the (seasonally) differenced value with its lags; rows whose lags reach before the series are left out. ``chunk`` as for lags: no task holds a series."""
    rows = _differenced(df.select(*group, time, value), value, time, group, season, chunk)
    return add_lags(rows, "y", lags, group, time, chunk).dropna()


def fit_each(df: DataFrame, features: list[str], target: str, group: list[str], alpha: float = 0.0) -> DataFrame:
    """Least squares for each group, its columns with n, coef and intercept: one aggregation of the rows, then one small system a group, solved where its row lies. A group of too few rows has null coefficients."""
    p = len(features)

    def solved(batches):
        for pdf in batches:
            coef, intercept = [], []
            for row in pdf.to_dict("records"):
                enough = row["n"] > p + 1
                c, i = solve_ridge(row, p, alpha) if enough else (None, None)
                coef.append(None if c is None else c.tolist())
                intercept.append(i)
            yield pdf[[*group, "n"]].assign(coef=coef, intercept=pd.array(intercept, dtype="Float64"))

    types = dict(df.dtypes)
    schema = "".join(f"`{g}` {types[g]}, " for g in group) + "n long, coef array<double>, intercept double"
    return df.dropna(subset=[*features, target]).groupBy(*group).agg(*_moments(features, target)).mapInPandas(solved, schema)


def _joined(rows: DataFrame, table: DataFrame, group: list[str], columns: list[str], how: str = "left") -> DataFrame:
    """``rows`` with columns of a table of one row a group; null groups meet null groups."""
    named = table.select(*[F.col(g).alias(f"_g_{g}") for g in group], *columns)
    on = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]
    return rows.join(named, on or F.lit(True), how).drop(*[f"_g_{g}" for g in group])


def arx_fit(df: DataFrame, value: str, time: str, group: list[str], lags: list[int], season: int = 0, alpha: float = 1e-6, ma: list[int] = (), exog: list[str] = (), long_ar: int | None = None, chunk: int | None = CHUNK) -> tuple[DataFrame, DataFrame]:
    """A (seasonally differenced) autoregression with moving-average and exogenous terms, for each series, in two regressions (Hannan and Rissanen).

    The first regresses on many lags and gives the shocks, as its residuals; the second on
    the lags of the value and of the shocks and on the exogenous columns. Without ``ma``
    the second stands alone. Both are sums over rows; lags are taken over chunks, so no
    task holds a series. Gives the coefficients (group, n, coef in the order lags, ma,
    exog, intercept) and the rows with y and the shocks e.
    """
    if min([*lags, *ma], default=0) < 1 or not lags:
        raise ValueError("at least one lag is needed, and lags are positive")
    exog = list(exog)
    rows = _differenced(df.select(*group, time, value, *exog).dropna(), value, time, group, season, chunk)
    if ma:
        many = range(1, (long_ar or max(lags) + 2 * max(ma)) + 1)
        names = [f"y_lag_{n}" for n in many]
        wide = add_lags(rows, "y", list(many), group, time, chunk)
        first = _joined(wide, fit_each(wide, [*names, *exog], "y", group, alpha), group, ["coef", "intercept"])
        terms = F.zip_with("coef", F.array(*[F.col(c).cast("double") for c in [*names, *exog]]), lambda b, x: b * x)
        rows = first.withColumn("e", F.col("y") - F.col("intercept") - F.aggregate(terms, F.lit(0.0), lambda total, t: total + t)).drop("coef", "intercept", *names)
    else:
        rows = rows.withColumn("e", F.lit(0.0))
    both = add_lags(rows.withColumn("_s", F.struct("y", "e")), "_s", sorted({*lags, *ma}), group, time, chunk)
    names = [f"y_{n}" for n in lags] + [f"e_{n}" for n in ma]
    design = both.select(*group, "y", *exog, *[F.col(f"_s_lag_{n}.y").alias(f"y_{n}") for n in lags], *[F.col(f"_s_lag_{n}.e").alias(f"e_{n}") for n in ma])
    return fit_each(design, [*names, *exog], "y", group, alpha), rows.select(*group, time, value, "y", "e")


def arx_forecast(df: DataFrame, value: str, time: str, group: list[str], lags: list[int], steps: int, season: int = 0, alpha: float = 1e-6, ma: list[int] = (), exog: list[str] = (), future: DataFrame | None = None, long_ar: int | None = None, chunk: int | None = CHUNK) -> DataFrame:
    """Several steps ahead for each series, by ``arx_fit`` and recursion from the series' last few rows; shocks to come are nought.

    ``future`` has the group, ``horizon`` (from 1) and the exogenous columns of the steps;
    a step without them, and all after it that need it, is null. Only as many rows a
    series as the longest lag come together. A series too short to fit gives its last
    value, or its last season. No likelihood is maximised: not the estimates of an exact
    ARIMA, though exact for a noise-free autoregressive series.
    """
    exog, ma = list(exog), list(ma)
    if exog and future is None:
        raise ValueError("exogenous columns need their future values")
    coefs, rows = arx_fit(df, value, time, group, lags, season, alpha, ma, exog, long_ar, chunk)
    reach = max(*lags, *ma, season, 1)
    sizes = rows.groupBy(*group).agg(F.count("*").alias("_size"))
    last = _joined(ranked(rows, group, time), sizes, group, ["_size"]).filter(F.col("_rank") >= F.col("_size") - reach)
    tails = last.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("_rank", F.col(value).cast("double").alias("v"), F.col("y").cast("double").alias("y"), "e"))).alias("tail"))
    state = _joined(tails, coefs, group, ["coef", "intercept"])
    if exog:
        ahead = future.filter(F.col("horizon").between(1, steps)).groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct(F.col("horizon").cast("int"), F.array(*[F.col(c).cast("double") for c in exog])))).alias("ahead"))
        state = _joined(state, ahead, group, ["ahead"])
    else:
        state = state.withColumn("ahead", F.create_map().cast("map<int,array<double>>"))

    def run(batches):
        for pdf in batches:
            out = {**{g: [] for g in group}, "horizon": [], "forecast": []}
            for row in pdf.to_dict("records"):
                tail = list(row["tail"])
                level, y, e = [t["v"] for t in tail], [t["y"] for t in tail], [t["e"] for t in tail]
                ahead, coef = dict(row["ahead"]) if row["ahead"] is not None else {}, row["coef"]
                for h in range(1, steps + 1):
                    if coef is None:
                        nxt = 0.0 if season else level[-1]
                    else:
                        x = ahead.get(h, [None]) if exog else []
                        terms = [y[-n] if n <= len(y) else None for n in lags] + [e[-n] if n <= len(e) else None for n in ma] + list(x)
                        known = all(t is not None and t == t for t in terms)
                        nxt = row["intercept"] + sum(c * t for c, t in zip(coef, terms, strict=True)) if known else None
                    y.append(nxt)
                    e.append(0.0)
                    back = (level[-season] if season <= len(level) else 0.0) if season else 0.0
                    level.append(None if nxt is None or back is None else nxt + back)
                    for g in group:
                        out[g].append(row[g])
                    out["horizon"].append(h)
                    out["forecast"].append(level[-1])
            yield pd.DataFrame(out).astype({"horizon": "int32", "forecast": "Float64"})

    types = dict(df.dtypes)
    return state.mapInPandas(run, "".join(f"`{g}` {types[g]}, " for g in group) + "horizon int, forecast double")


def should_train(trained_at: Column, now: Column, retrain_after_hours: int | None) -> Column:
    """Never trained: yes; no limit: no; else once the limit has passed."""
    if retrain_after_hours is None:
        return trained_at.isNull()
    return trained_at.isNull() | (now >= trained_at + F.make_interval(hours=F.lit(retrain_after_hours)))


def model_version(trained_at: Column) -> Column:
    """The version name of a training time."""
    return F.date_format(trained_at, "yyyyMMdd'T'HHmmss.SSSSSS'Z'")


def forecast_origin(df: DataFrame, time: str, target: str, *by: str) -> DataFrame:
    """The newest row with a known target, per series if keys are named."""
    return df.groupBy(*by).agg(F.max(F.when(F.col(target).isNotNull(), F.col(time))).alias("origin"))


def future_grid(origin: Column, steps: int, step: str, timezone: str = EASTERN) -> Column:
    """The next stamps as an array: hours and minutes are absolute, days keep the local wall clock across clock changes."""
    count, unit = int(step[:-1] or 1), step[-1]
    if count < 1 or steps < 1 or unit not in "dhm":
        raise ValueError("a step is a positive number of d, h or m")
    numbers = F.sequence(F.lit(1), F.lit(steps))
    if unit == "d":
        local = F.from_utc_timestamp(origin, timezone)
        return F.transform(numbers, lambda k: F.to_utc_timestamp(local + F.make_interval(days=k * count), timezone))
    seconds = count * (3600 if unit == "h" else 60)
    return F.transform(numbers, lambda k: F.timestamp_micros(F.unix_micros(origin) + k.cast("long") * (seconds * 1_000_000)))


def future_rows(df: DataFrame, time: str, target: str, steps: int, step: str, timezone: str = EASTERN, by: tuple[str, ...] = ()) -> DataFrame:
    """The origin of every series, and a row for each of its future stamps with the horizon."""
    origin = forecast_origin(df, time, target, *by).filter("origin is not null")
    return origin.select(*by, "origin", F.posexplode(future_grid(F.col("origin"), steps, step, timezone)).alias("at", time)).select(*by, "origin", time, (F.col("at") + 1).alias("horizon"))


def last_known(history: DataFrame, asks: DataFrame, by: list[str], time: str, at: str, columns: list[str], grain: str = "day") -> DataFrame:
    """The as-of join: every ask with the series' last value of each column, nulls passed over, at or before its time ``at``.

    History and asks are put into one sequence, which is ordered within each series' day
    (or another ``grain``); what was last known before a day comes from a table of one
    row a series and day. So each history row and each ask moves once, however many asks
    there are, and no task holds a series. Of values of one time the greatest by the
    columns in turn is the last. Null series are series of their own; an ask without a
    time knows nothing; asks that repeat are answered each.
    """
    kinds = dict(history.dtypes)
    own = [F.col(c) for c in by]
    asked = asks.select(*own, F.col(at).alias("_t")).distinct().filter("_t is not null")
    past = history.filter(F.col(time).isNotNull()).select(*own, F.col(time).alias("_t"), F.lit(0).alias("_kind"), *columns)
    rows = past.unionByName(asked.select("*", F.lit(1).alias("_kind"), *[F.lit(None).cast(kinds[c]).alias(c) for c in columns])).withColumn("_day", F.date_trunc(grain, "_t"))
    so_far = Window.partitionBy(*by, "_day").orderBy("_t", "_kind", *columns).rowsBetween(Window.unboundedPreceding, 0)
    within = rows.withColumns({f"_own_{c}": F.last(c, ignorenulls=True).over(so_far) for c in columns}).filter("_kind = 1")
    days = rows.groupBy(*by, "_day").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("_t", *columns))).alias(c) for c in columns])
    before = Window.partitionBy(*by).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select(*[F.col(k).alias(f"_s_{k}") for k in [*by, "_day"]], *[F.last(c, ignorenulls=True).over(before).alias(f"_old_{c}") for c in columns])
    met = within.join(carried, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in [*by, "_day"]])
    answers = met.select(*[F.col(k).alias(f"_a_{k}") for k in by], "_t", *[F.coalesce(f"_own_{c}", f"_old_{c}").alias(c) for c in columns])
    on = [F.col(k).eqNullSafe(F.col(f"_a_{k}")) for k in by] + [F.col(at) == F.col("_t")]
    return asks.join(answers, on, "left").select(*asks.columns, *columns)


def carried_features(df: DataFrame, future: DataFrame, time: str, features: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Future rows with calendar features of their own time and the series' last known value of all others at or before the origin. Any number of origins a series, by an as-of join."""
    calendar = {"hour", "day_of_week", "day_name", "day_type", "month", "is_weekend", "is_holiday"}
    carried = [f for f in features if f not in calendar]
    out = add_holiday(add_calendar(future, time), time)
    if carried:
        out = last_known(df, out, list(by), time, "origin", carried)
    return out.select(*by, "origin", time, "horizon", *features)


def known_features(df: DataFrame, future: DataFrame, time: str, features: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Future rows with the features of the data's own future rows."""
    return future.join(df.select(*by, time, *features), [*by, time], "left").select(*by, "origin", time, "horizon", *features)


def require_no_gap(future: DataFrame, features: list[str]) -> None:
    require_finite(future, *features)


def forecast_id(name: Column, version: Column, origin: Column, at: Column) -> Column:
    """The same forecast always has the same id."""
    return F.sha2(F.concat_ws("|", name, version, format_utc(origin), format_utc(at)), 256)


def forecast_rows(future: DataFrame, time: str, name: str | Column, version: str, target: str, value: Column, generated_at: Column) -> DataFrame:
    """The forecast table's rows; the model's name may be a column, for one model a series."""
    name = F.lit(name) if isinstance(name, str) else name
    return future.select(forecast_id(name, F.lit(version), F.col("origin"), F.col(time)).alias("forecast_id"), name.alias("model_name"), F.lit(version).alias("model_version"), F.lit(target).alias("target"), F.col("origin").alias("forecast_origin_utc"), F.col(time).alias("forecast_for_utc"), local_time(time).alias("forecast_for_local"), F.col("horizon").cast("int").alias("horizon"), value.alias("value"), generated_at.alias("generated_at_utc"))


def backtest(df: DataFrame, features: list[str], target: str, time: str, spec: list, alpha: float = 1.0) -> DataFrame:
    """Metrics per fold. All folds' sums come from one job and all their scores from another; only the p by p systems are solved in between."""
    split = rolling_splits(df.select(time, *features, target).dropna(), time, spec)
    sums = split.filter("split = 'train'").groupBy("fold").agg(*_moments(features, target))
    predicted = F.lit(None).cast("double")
    for row in sums.collect():  # one row for each fold of the given list
        coef, intercept = solve_ridge(row, len(features), alpha)
        predicted = F.when(F.col("fold") == row["fold"], linear(features, coef, intercept)).otherwise(predicted)
    return regression_metrics(split.filter("split = 'validation'").withColumn("_p", predicted), target, "_p", "fold")


def best_candidate(results: DataFrame) -> DataFrame:
    """The candidate with the least mean RMSE over its folds; ties go to the first name."""
    by = results.groupBy("candidate").agg(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"), F.count("*").alias("folds"))
    return by.agg(F.min(F.struct("rmse", "candidate", "mae", "folds")).alias("b")).select("b.candidate", "b.rmse", "b.mae", "b.folds")
