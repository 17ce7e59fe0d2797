"""Where queries are registered with their oracles."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmill.plans.views import ntz

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def shared(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder. Where none is set a temporary one is, for a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/query-{uuid.uuid4().hex}"


def query(name: str, sql: str | None = None):
    """Registers ``f(spark, sf_dir)`` under the name; timestamps leave without zone, as the oracle's do."""

    def add(f):
        if name in QUERIES:
            raise ValueError(f"two queries are called {name}")
        QUERIES[name] = lambda spark, sf_dir: ntz(f(spark, sf_dir))
        if sql:
            ORACLES[name] = sql.strip()
        return f

    return add
