"""Named functions and composed jobs (rows I02, I03, M20, U01, U02)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.operators import features as feats
from gridmill.operators.datasets import load_dataset
from gridmill.operators.dedupe import append_new
from gridmill.operators.modelling import carried_features, forecast_rows, future_rows, linear, prepare_time, require_no_gap, train
from gridmill.operators.records import require_ids
from gridmill.operators.windows import backfill_windows, in_window
from gridmill.sources import tables
from gridmill.sources.ingested import Store


class Registry:
    """Functions from frames to a frame, by name; a name taken or unknown is an error."""

    def __init__(self):
        self._by: dict[str, Callable[..., DataFrame]] = {}

    def register(self, name: str, function: Callable[..., DataFrame]) -> None:
        if name in self._by:
            raise ValueError(f"there is a {name!r} already")
        self._by[name] = function

    def get(self, name: str) -> Callable[..., DataFrame]:
        if name not in self._by:
            raise KeyError(f"no {name!r}; there are {', '.join(sorted(self._by)) or 'none'}")
        return self._by[name]


FEATURES = Registry()
for _name in ("region_hourly", "region_daily", "interchange_hourly", "interchange_daily", "hourly_severity", "hourly_text"):
    FEATURES.register(_name, getattr(feats, _name))


def ingest_window(landed: DataFrame, stored: DataFrame, time: str, start, end, key: str = "record_id") -> tuple[DataFrame, DataFrame]:
    """What of one window is to be appended, and a row of counts: received, written, skipped."""
    got = require_ids(landed.filter(in_window(F.col(time), start, end)), key)
    new = append_new(stored, got, key, time)
    counts = got.agg(F.count("*").alias("received")).join(new.agg(F.count("*").alias("written"))).withColumn("skipped", F.col("received") - F.col("written"))
    return new, counts


def run_incremental(spark: SparkSession, landed: DataFrame, table: str, time: str, lookback_days: int, end: datetime, key: str = "record_id") -> dict:
    """One incremental run: window, append, and the new checkpoint with the commit of the run. A second run over the same rows writes nothing; one that failed before its commit left nothing."""
    if lookback_days < 0:
        raise ValueError("lookback must not be negative")
    store = Store(spark, table, landed.schema, key)
    until = F.lit(end).cast("timestamp")
    start = F.coalesce(F.lit(store.state().checkpoint).cast("timestamp"), until) - F.make_interval(days=F.lit(lookback_days))
    return store.append(landed.filter(in_window(F.col(time), start, until)), time, end)


def backfill_run(spark: SparkSession, landed: DataFrame, table: str, time: str, start: datetime, end: datetime, days: int, key: str = "record_id", resume: bool = True, ingest=None) -> dict:
    """The windows of a backfill in order, one run each; the first that fails stops the backfill.

    A window that succeeds moves the store's checkpoint to its end in the same commit, so
    with ``resume`` a second backfill over the same bounds goes on where the last one
    stopped. A window reads the landed rows that fall into it and the index of ids,
    never the stored rows. ``ingest`` stands in for the append of one window, (start,
    end) to its counts. The number of windows is that of the bounds given, not of the
    data.
    """
    store = Store(spark, table, landed.schema, key)

    def append(a: datetime, b: datetime) -> dict:
        return store.append(landed.filter(in_window(F.col(time), F.lit(a).cast("timestamp"), F.lit(b).cast("timestamp"))), time, b)

    done = store.state().checkpoint if resume else None
    results: list[dict] = []
    for row in backfill_windows(spark, start, end, days).orderBy("window_no").collect():
        if done is not None and row.window_end <= done:
            continue
        result = {"window_no": row.window_no, "window_start": row.window_start, "window_end": row.window_end}
        try:
            counts = (ingest or append)(row.window_start, row.window_end)
        except Exception as error:  # noqa: BLE001  a window's failure is a result
            results.append(result | {"status": "failure", "error": str(error), "received": 0, "written": 0, "skipped": 0})
            break
        results.append(result | {"status": "success", "error": None} | counts)
    good = [r for r in results if r["status"] == "success"]
    return {"status": "failure" if len(good) < len(results) else "success", "windows": results, "last_window_end": good[-1]["window_end"] if good else None, **{k: sum(r[k] for r in results) for k in ("received", "written", "skipped")}}


@dataclass(frozen=True)
class Definition:
    """What a train or forecast job needs to know of a model."""

    name: str
    target: str
    features: tuple[str, ...]
    time: str = "observed_at"
    alpha: float = 1.0
    validation_days: int = 14
    lookback_days: int = 730
    retrain_after_hours: int | None = 24
    steps: int = 24
    step: str = "1h"


def _due(trained_at: datetime | None, now: datetime, after_hours: int | None) -> tuple[bool, str]:
    """M12 for one model: whether to train, and why."""
    if trained_at is None:
        return True, "never trained"
    if after_hours is None:
        return False, "trained, and no age asks for more"
    due = now >= trained_at + timedelta(hours=after_hours)
    return due, f"trained {'more' if due else 'less'} than {after_hours} hours ago"


def train_job(spark: SparkSession, definition: Definition, read: Callable[[], DataFrame], models: str, now: datetime, force: bool = False) -> dict:
    """Trains and stores a new version if one is due. The result says skipped, success or failure; a failed job stores nothing."""
    d, base = definition, {"name": definition.name, "rows_read": 0}
    try:
        newest = tables.latest_models(tables.read_models(spark, models).filter(F.col("model_name") == d.name)).first()
        due, reason = (True, "forced") if force else _due(newest.trained_at if newest else None, now, d.retrain_after_hours)
        if not due:
            return base | {"status": "skipped", "reason": reason, "version": newest.version, "trained_at": newest.trained_at}
        data = read()
        base["rows_read"] = data.count()
        made = train(data, list(d.features), d.target, d.time, d.alpha, d.validation_days, d.lookback_days)
        version = now.strftime("%Y%m%dT%H%M%S.%fZ")
        tables.write_model(spark, models, {"model_name": d.name, "version": version, "trained_at": now, "target": d.target, "features": list(d.features), "coefficients": made["coefficients"], "intercept": made["intercept"], "metrics": {k: v for k, v in made["metrics"].items() if v is not None}})
        return base | {"status": "success", "reason": reason, "version": version, "trained_at": now, "rows_trained": made["rows"], "metrics": made["metrics"], "diagnostics": made["diagnostics"]}
    except Exception as error:  # noqa: BLE001  a job's failure is a result
        return base | {"status": "failure", "error": str(error)}


def forecast_job(spark: SparkSession, definition: Definition, read: Callable[[], DataFrame], models: str, forecasts: str, now: datetime) -> dict:
    """The next steps by the newest version of a model, upserted by forecast id, so that a job run twice leaves one row each. Fails where there is no model or a feature has a gap."""
    d, base = definition, {"name": definition.name, "rows_read": 0, "rows_written": 0}
    try:
        model = tables.latest_models(tables.read_models(spark, models).filter(F.col("model_name") == d.name)).first()
        if model is None:
            raise ValueError(f"no model {d.name!r} has been trained")
        data = read()
        base["rows_read"] = data.count()
        data = prepare_time(data, d.time)
        future = future_rows(data, d.time, d.target, d.steps, d.step)
        filled = carried_features(data, future, d.time, list(model.features))
        require_no_gap(filled, list(model.features))
        rows = forecast_rows(filled, d.time, d.name, model.version, d.target, linear(list(model.features), model.coefficients, model.intercept), F.lit(now).cast("timestamp"))
        written = rows.count()
        tables.upsert_table(spark, forecasts, rows, ["forecast_id"], "generated_at_utc")
        return base | {"status": "success", "version": model.version, "rows_written": written}
    except Exception as error:  # noqa: BLE001  a job's failure is a result
        return base | {"status": "failure", "error": str(error)}


Stage = tuple[str, Callable[[], list[dict]]]


def workflow(*stages: Stage) -> dict[str, list[dict]]:
    """Stages in order; each gives a list of results, and one whose status is failure stops the workflow with an error."""
    results: dict[str, list[dict]] = {}
    for name, stage in stages:
        results[name] = stage()
        failed = sum(r.get("status") == "failure" for r in results[name])
        if failed:
            raise RuntimeError(f"{name} failed for {failed} item(s)")
    return results


def modelling_stages(spark: SparkSession, features: Callable[[], list[dict]], datasets: Callable[[], list[dict]], definitions: list[Definition], read: Callable[[Definition], DataFrame], models: str, forecasts: str, now: datetime, force: bool = False) -> list[Stage]:
    """The stages from features to forecasts, without new source data."""
    return [
        ("features", features), ("datasets", datasets),
        ("training", lambda: [train_job(spark, d, lambda: read(d), models, now, force) for d in definitions]),
        ("forecasting", lambda: [forecast_job(spark, d, lambda: read(d), models, f"{forecasts}/{d.name}", now) for d in definitions]),
    ]


def modelling_workflow(*args, **named) -> dict[str, list[dict]]:
    """Features, datasets, training, forecasting."""
    return workflow(*modelling_stages(*args, **named))


def numeric_workflow(ingestion: Callable[[], list[dict]], standardization: Callable[[], list[dict]], *args, **named) -> dict[str, list[dict]]:
    """Ingestion and standardisation, then the modelling stages."""
    return workflow(("ingestion", ingestion), ("standardization", standardization), *modelling_stages(*args, **named))


def text_workflow(ingestion: Callable[[], list[dict]], standardization: Callable[[], list[dict]], scraping: Callable[[], list[dict]], embeddings: Callable[[], list[dict]]) -> dict[str, list[dict]]:
    """Ingestion, standardisation, scraping, embeddings."""
    return workflow(("ingestion", ingestion), ("standardization", standardization), ("scraping", scraping), ("embeddings", embeddings))


def historical_workflow(backfill: Callable[[], dict], *downstream: Stage) -> dict[str, list[dict]]:
    """A backfill, and the stages after it if any are given."""
    return workflow(("backfill", lambda: [backfill()]), *downstream)


def numeric_job(obs: DataFrame, flows: DataFrame, own: str, target: str = "actual_load") -> DataFrame:
    """Observations and flows to the hourly training set, one lazy plan; repeated keys are an error when it is computed."""
    return load_dataset(feats.region_hourly(obs, "plan"), feats.interchange_hourly(flows, own), target, "plan")
