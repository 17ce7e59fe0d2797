"""Exact de-duplication by two-pass Bloom filtering.

Pass one hashes every text and builds a counting Bloom filter of bounded size; pass
two sends on to the grouping shuffle only rows whose hash may occur twice. All other
rows pass straight through as groups of one. Grouping is by SHA-256, so a false
positive of the filter costs a little shuffle and never a wrong answer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from gridmill.llm import bloom
from gridmill.llm.common import documents, numbered, raw_texts, stored

MOST_LOG2_BITS = 28


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256 and a 64-bit hash of each text, lower-cased in A-Z only; null counts as empty."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [hashlib.sha256(raw.lower()).digest() for raw in raw_texts(batch.column(1))]
            h = np.frombuffer(b"".join(d[:8] for d in digests), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([d.hex() for d in digests], pa.string()), pa.array(h, pa.int64())], ["doc_id", "text_sha256", "h"])

    return docs.select("doc_id", "text").mapInArrow(hashed, "doc_id long, text_sha256 string, h long")


def exact_groups(docs: DataFrame, most_log2_bits: int = MOST_LOG2_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    The largest doc_id of equal texts stays. Null texts equal empty ones. Rows that
    repeat a doc_id count as members of their own, and all those with the keeping id
    are kept; a null doc_id is never the keeper unless its whole group has none, and
    then every member stays. An empty table gives an empty result. Other columns of
    ``docs`` are not looked at.
    """
    slim, seen = _first_pass(docs, most_log2_bits)

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(2).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(seen.value.maybe(h))], ["doc_id", "text_sha256", "again"])

    rows = slim.mapInArrow(flagged, "doc_id long, text_sha256 string, again boolean")
    once = rows.filter(~F.col("again")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    again = rows.filter("again").select("doc_id", "text_sha256")
    several = again.join(_groups(again), "text_sha256").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return once.unionByName(several)


def _first_pass(docs: DataFrame, most_log2_bits: int):
    """The hashes of all rows, stored, and the filter over them."""
    slim = stored(fingerprints(docs))
    return slim, bloom.repeats(slim, "h", bloom.size_for(slim.count(), most_log2=most_log2_bits))


def _groups(again: DataFrame) -> DataFrame:
    """Keeper and size of each group. Stored, so that a join with it is one that adaptive execution can split where a group is large."""
    return stored(again.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))


def without_copies(docs: DataFrame, most_log2_bits: int = MOST_LOG2_BITS) -> DataFrame:
    """``docs`` with the keeper of each distinct text, all columns kept, whatever their names.

    Only rows that may have a copy are shuffled; the others pass straight through. Null
    texts equal empty ones; a null doc_id goes unless its whole group has none; repeated
    rows with the keeping id all stay; an empty table gives none.
    """
    _, seen = _first_pass(docs, most_log2_bits)
    plain, place, own = numbered(docs), docs.columns.index("text"), f"c{docs.columns.index('doc_id')}"
    names = plain.columns

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [hashlib.sha256(raw.lower()).digest() for raw in raw_texts(batch.column(place))]
            h = np.frombuffer(b"".join(d[:8] for d in digests), np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([d.hex() for d in digests], pa.string()), pa.array(seen.value.maybe(h), pa.bool_())], [*names, "digest", "again"])

    rows = plain.mapInArrow(flagged, StructType([*plain.schema.fields, StructField("digest", StringType()), StructField("again", BooleanType())]))
    several = rows.filter("again")
    groups = _groups(several.select(F.col(own).alias("doc_id"), F.col("digest").alias("text_sha256"))).select(F.col("text_sha256").alias("digest"), "keep_id")
    kept = several.join(groups, "digest").filter(F.col(own).eqNullSafe(F.col("keep_id")))
    return rows.filter("not again").select(*names).union(kept.select(*names)).toDF(*docs.columns)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir, "doc_id", "text"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP3_SQL = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents),
h AS (SELECT doc_id, sha256(norm) AS text_sha256 FROM t)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM h WINDOW w AS (PARTITION BY text_sha256)
"""
