"""Keep-first, keep-last and drop-all de-duplication, upserts and anti-joins (rows S12, S15, I05, I06, C01, C05, E02)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmill.operators.guards import require_columns


def dedupe(df: DataFrame, keys: list[str], order: str, keep: str | bool = "last") -> DataFrame:
    """One row per key, the first or last by ``order``; ``keep=False`` drops every row of a key that occurs twice.

    Keep-first and keep-last are aggregates of one struct, so that rows combine before
    the shuffle and a hot key stays small. A row whose order is null is kept only where
    its key has no other; of rows with one order the least (first) or greatest (last)
    by its columns is kept, those with maps left out of the comparison.
    """
    require_columns(df, *keys, order)
    if keep is False:
        once = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n = 1").drop("_n")
        on = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]
        return df.alias("a").join(once.alias("b"), on, "left_semi")
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first', 'last' or False")
    names = [F.col(f"`{c}`") for c in df.columns]
    by, row = F.col(f"`{order}`"), F.struct(*names)
    known = by.isNull() if keep == "first" else by.isNotNull()
    plain = [c for c, f in zip(names, df.schema.fields) if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    if len(plain) == len(names):
        best = (F.min if keep == "first" else F.max)(F.struct(known.alias("known"), by.alias("by"), row.alias("row")))
        return df.groupBy(*keys).agg(best.alias("_best")).select("_best.row.*")
    best = (F.min_by if keep == "first" else F.max_by)(row, F.struct(known.alias("known"), by.alias("by"), F.struct(*plain).alias("tie")))
    return df.groupBy(*keys).agg(best.alias("_row")).select("_row.*")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The union, keeping the last row of each key; both sides must have the same columns."""
    if set(old.columns) != set(new.columns):
        raise ValueError("the columns of both sides must be the same")
    return dedupe(old.unionByName(new), keys, order, "last")


def append_new(stored: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """The rows of the batch to append: the first of each key, without keys already stored."""
    return dedupe(batch, [key], order, "first").join(stored.select(key).distinct(), key, "left_anti").select(*batch.columns)


def unprocessed(rows: DataFrame, done: DataFrame, key: str, order: str, status: str = "status", retry_failed: bool = False) -> DataFrame:
    """The last row of each id that is not done; with ``retry_failed`` only final states count as done."""
    finished = done.filter(F.col(status).isin("success", "forbidden", "not_found")) if retry_failed else done
    return dedupe(rows, [key], order, "last").join(finished.select(key).distinct(), key, "left_anti").select(*rows.columns)


def numbered(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """Rows with their place ``rn`` within the key, for top-n per group."""
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
