"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The documents table; only the named columns are read."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return table.select(*columns) if columns else table


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new path below the shared checkpoint folder.

    Where no folder is set a temporary one is, but only for a local master, whose one
    machine shares it with itself; on a cluster the setting is asked for.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/corpus-{uuid.uuid4().hex}"


def quoted(name: str) -> str:
    """A column's name as it may stand in an expression, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns called c0, c1, ...: Arrow functions take columns by name and stumble over some names."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each made longer until no column has it (in any case)."""
    taken = {c.lower() for c in columns}
    made = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        made.append(name)
    return made


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here and lost executors cost nothing."""
    path = shared_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(modulus: int, rest: int, doc_id: str = "doc_id") -> F.Column:
    """Whether crc32(doc_id as text) leaves ``rest``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == rest, F.lit(False))


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string or binary Arrow column, null as empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that any bits of the result may serve as an address."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))
