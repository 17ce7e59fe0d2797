"""Checks that stop a job with one aggregate over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def require_unique(df: DataFrame, *keys: str) -> None:
    """An error if any key occurs twice."""
    if not duplicates(df, *keys).isEmpty():
        raise ValueError(f"rows are not unique by {', '.join(keys)}")


def bad_values(df: DataFrame, *columns: str) -> DataFrame:
    """For each column how many values are null, NaN or infinite, in one pass."""
    odd = lambda c: F.col(c).isNull() | F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf"))
    return df.agg(*[F.count_if(odd(c)).alias(c) for c in columns])


def require_finite(df: DataFrame, *columns: str) -> None:
    require_columns(df, *columns)
    row = df.agg(F.count("*").alias("_n")).crossJoin(bad_values(df, *columns)).first()
    if not row["_n"]:
        raise ValueError("no rows")
    wrong = [c for c in columns if row[c]]
    if wrong:
        raise ValueError(f"null or non-finite values in {', '.join(wrong)}")
