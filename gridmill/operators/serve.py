"""Reads of finished tables (rows Q01 to Q04)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.operators.dedupe import dedupe


def page(df: DataFrame, key: list[str], limit: int, offset: int, most: int = 1000) -> DataFrame:
    """Q01: one page in the order of the key, with the total; limits beyond 1 to ``most`` and negative offsets are errors."""
    if not 1 <= limit <= most or offset < 0:
        raise ValueError(f"limit must be within 1 and {most}, offset not negative")
    total = df.agg(F.count("*").alias("total"))
    return df.orderBy(*key).offset(offset).limit(limit).join(F.broadcast(total))


def latest_forecasts(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Q02: newest first by the time forecast and then by when it was made."""
    out = df.orderBy(F.desc("forecast_for_utc"), F.desc("generated_at_utc"), "forecast_id")
    return out.limit(limit) if limit else out


def latest_per_target(df: DataFrame) -> DataFrame:
    """Q03: for each model, target and time the forecast made last."""
    return dedupe(df, ["model_name", "target", "forecast_for_utc"], "generated_at_utc", "last")


def run_summary(runs: DataFrame) -> DataFrame:
    """Q04: items and rows per stage and status."""
    return runs.groupBy("stage", "status").agg(F.count("*").alias("items"), F.sum("row_count").alias("row_count"))
