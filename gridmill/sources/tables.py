"""Datasets by reference, writes, upserts and the model table (rows S02, S04, S07 to S15)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from gridmill.operators.dedupe import dedupe
from gridmill.schema import MODEL
from gridmill.sources.keyed import BUCKETS, KeyedTable

LAYERS = ("bronze", "silver", "gold")
ROWS_PER_FILE = 100_000


@dataclass(frozen=True)
class DatasetRef:
    """``layer:source:artifact``."""

    layer: str
    source: str
    artifact: str

    @classmethod
    def parse(cls, text: str) -> DatasetRef:
        parts = text.split(":")
        if len(parts) != 3 or not all(parts) or parts[0] not in LAYERS:
            raise ValueError(f"not a dataset reference: {text!r}")
        return cls(*parts)

    def under(self, root: str) -> tuple[str, dict[str, str]]:
        """The table's folder and the partition that the reference names; gold tables lie under their artifact."""
        if self.layer == "gold":
            return f"{root}/gold/{self.artifact}", {"dataset": self.source}
        return f"{root}/{self.layer}", {"source": self.source, "artifact": self.artifact}


def read_dataset(spark: SparkSession, root: str, ref: str, schema: StructType | None = None) -> DataFrame:
    """The dataset's partition alone; columns of all its parts by name (datasets of one layer may differ). A missing dataset is an empty frame of the schema given, else an error."""
    path, part = DatasetRef.parse(ref).under(root)
    try:
        df = spark.read.option("mergeSchema", True).option("basePath", path).parquet("/".join([path, *(f"{k}={v}" for k, v in part.items())]))
    except AnalysisException:
        if schema is None:
            raise
        return spark.createDataFrame([], schema)
    for k, v in part.items():
        df = df.filter(F.col(k) == v)
    return df.drop(*part)


def write_dataset(df: DataFrame, root: str, ref: str, mode: str = "append", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Parquet, zstd, files of bounded size; ``replace`` swaps the reference's partition alone; any other mode is an error."""
    if mode not in ("append", "replace"):
        raise ValueError("mode must be append or replace")
    path, part = DatasetRef.parse(ref).under(root)
    for k, v in part.items():
        df = df.withColumn(k, F.lit(v))
    out = df.write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).partitionBy(*part)
    out.mode("overwrite" if mode == "replace" else "append").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_deduped(df: DataFrame, root: str, ref: str, keys: list[str], order: str, keep: str | bool = "last", mode: str = "replace") -> None:
    """As ``write_dataset``, one row per key."""
    write_dataset(dedupe(df, keys, order, keep), root, ref, mode)


def append_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines in new files beside those there."""
    df.write.mode("append").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row."""
    df.write.mode("overwrite").csv(path, header=True)


def upsert_table(spark: SparkSession, path: str, new: DataFrame, keys: list[str], order: str, buckets: int = BUCKETS) -> int:
    """Puts the new rows into the table, the last of each key kept; the columns must be the same. Only the hash buckets of the new rows' keys are read and rewritten. Returns the version."""
    return KeyedTable(spark, path, keys, order, buckets=buckets).upsert(new)["version"]


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is now; one that was never written is an error."""
    return KeyedTable.open(spark, path).read()


def write_model(spark: SparkSession, path: str, row: dict) -> None:
    """Appends a version of a model; one that is there already is an error."""
    if not read_models(spark, path).filter((F.col("model_name") == row["model_name"]) & (F.col("version") == row["version"])).isEmpty():
        raise ValueError("this version of the model is there already")
    spark.createDataFrame([tuple(row.get(f) for f in MODEL.names)], MODEL).write.mode("append").parquet(path)


def read_models(spark: SparkSession, path: str) -> DataFrame:
    """All versions, oldest first; empty where there are none."""
    try:
        return spark.read.schema(MODEL).parquet(path).orderBy("trained_at")
    except AnalysisException:
        return spark.createDataFrame([], MODEL)


def latest_models(models: DataFrame) -> DataFrame:
    """The newest version of every model."""
    return dedupe(models, ["model_name"], "trained_at", "last")
