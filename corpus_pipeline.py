"""The corpus pipeline: from raw documents to packed sequences, five stages of one operator each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmill.llm import exact_dedup, packing, secrets, simhash, toxicity
from gridmill.llm.common import documents, held_out, labels, stored


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar calls toxic go. Null and empty texts stay; repeated rows go or stay alike; extra columns are kept."""
    return toxicity.without_toxic(docs, labels(spark, sf_dir), ~held_out(4, 2))


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays. Null equals empty; a null id goes where its group has another; all rows with the keeping id stay; extra columns are kept."""
    return exact_dedup.without_copies(docs)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts alike in 0.8 or more of their five-word shingles the document with the smallest id stays. Rows with a null id stay; of rows that repeat an id those with a similar text go; extra columns are kept."""
    return simhash.without_near_copies(docs)


def secrets_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; no row goes. Null texts stay null; repeated rows are redacted each; extra columns are kept."""
    return secrets.without_secrets(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens, packed into sequences. A null or empty text is one id; a null id stays null; repeated rows are packed each; an empty table gives none."""
    return packing.packed_documents(docs, packing.default_tokenizer())


STAGES = [
    ("toxicity", toxic_out),
    ("exact_dedup", copies_out),
    ("simhash_near_dedup", near_copies_out),
    ("secret_scans", secrets_out),
    ("best_fit_packing", sequences),
]

#: Fitted scores, fingerprints and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table, each written and read again before the next."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
