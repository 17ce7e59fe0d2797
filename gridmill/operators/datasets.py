"""Model datasets from feature sets (rows D01 to D03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmill.operators.guards import require_columns, require_unique

KEY = ["observed_at", "region"]


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str] = KEY, how: str = "left", check: bool | str = True) -> DataFrame:
    """A join that is an error if a key occurs twice on either side: at once (``check=True``, two jobs), or when the result is computed (``check="plan"``), or never.

    The check in the plan counts over windows of the join's own keys, so the sides are
    shuffled no more than the join itself asks for.
    """
    if check is True:
        require_unique(left, *keys)
        require_unique(right, *keys)
    if check == "plan":
        left, right = _once(left, keys), _once(right, keys)
    return left.join(right, keys, how)


def _once(df: DataFrame, keys: list[str]) -> DataFrame:
    twice = F.count("*").over(Window.partitionBy(*keys)) > 1
    message = F.lit(f"rows are not unique by {', '.join(keys)}")
    return df.withColumn("_once", F.when(twice, F.raise_error(message).cast("boolean")).otherwise(True)).filter("_once").drop("_once")


def load_dataset(region: DataFrame, interchange: DataFrame, target: str = "actual_load", check: bool | str = True) -> DataFrame:
    """Region features with the interchange features of the same time and region; the target must be there."""
    require_columns(region, target)
    clash = [c for c in interchange.columns if c in region.columns and c not in KEY]
    return one_to_one(region, interchange.drop(*clash), KEY, "left", check)
