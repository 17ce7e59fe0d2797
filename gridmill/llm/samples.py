"""Bounded labelled samples for fitting, and the small logistic fit that calibrates scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: F.Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """About ``per_class`` documents of each class (doc_id, text, y), and how many usable labels each class has.

    Members are chosen by a hash of doc_id. Labels other than 0 and 1 and null ids are
    passed over; a document labelled both ways counts as 1. The ids joined to the
    documents are bounded by ``per_class``, so they are broadcast.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    part = F.lit(0.0)
    for y, n in counts.items():
        part = F.when(F.col("y") == y, F.lit(per_class / n)).otherwise(part)
    ids = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(1 << 30)) < part * (1 << 30))
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "y"), counts


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Coefficients of a weighted logistic fit, intercept first, by damped Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.ones(len(x)) if weight is None else weight
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (y - p)) - penalty * beta
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        beta += step
        if np.abs(step).max() < 1e-7:
            break
    return beta


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
