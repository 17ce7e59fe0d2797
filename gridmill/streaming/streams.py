"""Streaming forms of the incremental jobs (rows I15, P32, X01 to X04)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridmill.sources.keyed import KeyedTable


def read_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A stream of the files that land in a folder, under a declared schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(path)


def deduped(stream: DataFrame, key: str, time: str, lookback: str) -> DataFrame:
    """The first row of each id. State is bounded by the lookback: an id older than that can come again, other than in the batch form."""
    return stream.withWatermark(time, lookback).dropDuplicatesWithinWatermark([key])


def standardized(stream: DataFrame, standardize: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The batch expressions on a stream; the checkpoint knows which files are done."""
    return stream.transform(standardize)


def hourly_counts(stream: DataFrame, time: str, key: str, lateness: str = "1 day", severe: float = 0.7) -> DataFrame:
    """Counts, totals and severities (mean, greatest, number of severe rows) per hour and key; rows up to ``lateness`` late still count."""
    w, score = F.window(time, "1 hour"), F.col("severity_score")
    made = stream.withWatermark(time, lateness).groupBy(w.alias("w"), F.col(key)).agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"), F.avg(score).alias("severity_mean"), F.max(score).alias("severity_max"), F.count_if(score >= severe).alias("severe_document_count"))
    return made.select(F.col("w.start").alias("hour"), key, "n", "total", "severity_mean", "severity_max", "severe_document_count")


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Everything that is there now, appended to a Parquet table."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def upsert_to(stream: DataFrame, table: KeyedTable, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Keeps the last row of each key in a keyed table, everything that is there now. Only the parts that a batch falls into are read and rewritten. The table's manifest holds the last batch of this checkpoint, so a batch that is run again after a failure changes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        table.upsert(batch, checkpoint, number)

    return stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windows_table(spark: SparkSession, path: str, key: str, hour: str = "hour") -> KeyedTable:
    """The table of an hourly aggregate, in parts of a day. A window's row count only grows, so the row with the greatest ``n`` is its newest."""
    return KeyedTable(spark, path, [hour, key], "n", part=f"date_format(`{hour}`, 'yyyy-MM-dd')")


def windows_to(stream: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Merges an hourly aggregate into its table, everything that is there now.

    In update mode a batch gives the windows that it changed, and only their days are
    rewritten. Windows that the watermark has passed leave the state, so the state holds
    the windows of the lateness and of the newest rows, however long the stream runs;
    rows that come later than that are dropped.
    """
    return upsert_to(stream, table, checkpoint, "update")
