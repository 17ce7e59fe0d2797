"""An ingestion store: rows by run, and a bucketed index of their ids (rows I03, I05, I08).

Every run writes its rows and its ids as folders of its own number and then commits that
number. A run that failed before its commit is done again under the same number and
writes over what it left, so each row lands once. A batch is held against the ids of
committed runs alone, in a table bucketed by id: the batch is shuffled to the buckets,
and what is stored is read where it lies.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridmill.operators.dedupe import dedupe
from gridmill.sources.keyed import Folder

BUCKETS = 64
#: The partition column of runs; rows have no column of this name.
RUN = "_run"
RUNS = "run int, received long, written long, moved_to timestamp"


class IdIndex:
    """The ids of all runs, bucketed by id in files of the run's folder.

    The catalog only needs the table's definition, so any session can open the files;
    the number of buckets is part of the definition and fixed by the first use.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "record_id", buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.table = f"ids_{hashlib.sha256(f'{path} {key} {buckets}'.encode()).hexdigest()[:24]}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (`{key}` STRING, {RUN} INT) USING parquet OPTIONS (path '{path}') PARTITIONED BY ({RUN}) CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS")

    def add(self, ids: DataFrame, run: int) -> None:
        """The ids of a run, in place of any that an attempt at it left. One file a bucket."""
        view = f"{self.table}_new"
        ids.select(F.col(self.key).cast("string")).repartition(self.buckets, self.key).createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION ({RUN} = {run}) SELECT `{self.key}` FROM {view}")
        self.spark.catalog.dropTempView(view)

    def known(self, below: int) -> DataFrame:
        """The ids of the runs below a number."""
        if Folder(self.spark, self.path).names():
            self.spark.catalog.recoverPartitions(self.table)  # other sessions may have added runs
        return self.spark.table(self.table).filter(F.col(RUN) < below).select(self.key)

    def unseen(self, rows: DataFrame, below: int) -> DataFrame:
        """The rows whose id no run below the number has. The index is neither shuffled nor broadcast: the join is by its buckets."""
        return rows.hint("merge").join(self.known(below).hint("merge"), self.key, "left_anti").select(*rows.columns)


class Store:
    """Landed rows, each id once, under ``path``: rows/run=N, ids/run=N, and the log of committed runs."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str = "record_id", buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.index = IdIndex(spark, f"{self.path}/ids", key, buckets)

    def runs(self) -> DataFrame:
        """The committed runs."""
        there = "runs" in Folder(self.spark, self.path).names()
        return self.spark.read.schema(RUNS).json(f"{self.path}/runs") if there else self.spark.createDataFrame([], RUNS)

    def state(self):
        """next_run, and how far committed runs have moved the checkpoint."""
        return self.runs().agg((F.coalesce(F.max("run"), F.lit(-1)) + 1).alias("next_run"), F.max("moved_to").alias("checkpoint")).first()

    def read(self) -> DataFrame:
        """The rows of all committed runs."""
        if "rows" not in Folder(self.spark, self.path).names():
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")
        return rows.filter(F.col(RUN) < self.state().next_run).select(*self.schema.names)

    def append(self, landed: DataFrame, time: str, moved_to=None) -> dict:
        """One run: the first row of each id that is new, by time. Gives received, written, skipped.

        A first look at the ids alone counts the landed rows; a missing id is an error
        before anything is written.
        """
        seen = landed.agg(F.count("*").alias("received"), F.count_if(F.coalesce(F.trim(self.key), F.lit("")) == "").alias("missing")).first()
        if seen.missing:
            raise ValueError("rows without an id")
        run = self.state().next_run
        folder = f"{self.path}/rows/{RUN}={run}"
        self.index.unseen(dedupe(landed, [self.key], time, "first"), run).write.mode("overwrite").option("compression", "zstd").parquet(folder)
        written = self.spark.read.schema(self.schema).parquet(folder)
        self.index.add(written, run)
        counts = {"received": seen.received, "written": written.count()}
        self.spark.createDataFrame([(run, counts["received"], counts["written"], moved_to)], RUNS).coalesce(1).write.mode("append").json(f"{self.path}/runs")
        return counts | {"skipped": counts["received"] - counts["written"]}
