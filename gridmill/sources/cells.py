"""An inverted-file index of vectors by k-means cells (rows E06, E08).

Cells are fitted once, on a bounded sample; every row is then stored under the cell whose
centre has the largest cosine to it. A cell's rows are dealt to chunks of bounded size,
and the table is bucketed by cell and chunk: however many rows a cell holds, its chunks
are spread over the buckets, and a search shuffles its queries to them, never what is
stored. A search multiplies each block of queries with the chunks of the cells next to
them, so its candidates are ranked by their exact cosines.

Each cell's widest angle is kept, too. A row of a cell lies at least at the angle
between query and centre less that width, so the cells that may hold a nearer row than
those found are known: an exact search looks into them in a second round.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.operators.dedupe import numbered
from gridmill.operators.vectors import CHUNK, products
from gridmill.sources.keyed import Folder

BUCKETS = 64
#: Rows of the sample for each cell.
SAMPLE = 64
#: The centres go to every task; they take at most so many bytes.
MOST_BYTES = 1 << 25
#: Queries in a block.
BLOCK = 64
#: Rows whose exact neighbours say how many cells a search has to look into.
MEASURED = 256
#: Angles are taken as wider by this much, for the rounding of cosines near one.
SLACK = 1e-6


def unit(vectors: list, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors can be compared (``width`` entries, none null or not finite, not all zero), and those at length one."""
    good = np.array([v is not None and len(v) == width for v in vectors], bool)
    out = np.array([np.asarray(v, float) for v, yes in zip(vectors, good) if yes]).reshape(good.sum(), width)
    with np.errstate(all="ignore"):
        out = out / np.linalg.norm(out, axis=1, keepdims=True)
    fine = np.isfinite(out).all(axis=1)
    good[good] = fine
    return good, out[fine]


def slices(frames: Iterator[pd.DataFrame], entries: int) -> Iterator[pd.DataFrame]:
    """The rows of the frames, so many at a time that ``entries`` numbers for each of them take ``MOST_BYTES`` at most."""
    step = max(1, MOST_BYTES // (8 * max(1, entries)))
    for pdf in frames:
        for at in range(0, len(pdf), step):
            yield pdf.iloc[at : at + step].reset_index(drop=True)


class CellIndex:
    """Vectors under ``path``: centres, and rows by cell in numbered runs.

    Ids are of the column ``key``; a row with a null id, or with a vector that is null,
    of another length than the centres, without length or with entries that are null or
    not finite, is left out. An id that comes twice is stored twice.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, kind: str = "bigint", buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.kind, self.buckets = spark, path.rstrip("/"), key, kind, buckets
        self.table = f"cells_{hashlib.sha256(f'{self.path} {kind} {buckets}'.encode()).hexdigest()[:24]}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (cell INT, chunk INT, least DOUBLE, rows ARRAY<STRUCT<match: {kind}, v: ARRAY<DOUBLE>>>, run INT)"
            f" USING parquet OPTIONS (path '{self.path}/rows') PARTITIONED BY (run) CLUSTERED BY (cell, chunk) INTO {buckets} BUCKETS"
        )

    def fit(self, rows: DataFrame, vector: str, cells: int | None = None, seed: int = 42) -> int:
        """Fits the cells, by default the square root of the number of rows, and says how many there are.

        They are fitted on about ``SAMPLE`` rows a cell, chosen by a hash of the id; there
        are never more than ``MOST_BYTES`` of centres. The length of the vectors is that
        which most of the sample has. A table without vectors gives no cells.
        """
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        n = rows.count()
        wanted = cells or max(1, int(n**0.5))
        x = F.col(vector).cast("array<double>")
        fine = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(x, lambda v: v != 0)
        share = min(1.0, wanted * SAMPLE / max(n, 1))
        sample = rows.filter(F.pmod(F.xxhash64(self.key), F.lit(1 << 30)) < int(share * (1 << 30))).select(x.alias("x")).filter(fine)
        common = sample.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), "width").first()
        centres = []
        if common:
            k = max(1, min(wanted, MOST_BYTES // (8 * common.width)))
            points = sample.filter(F.size("x") == common.width).select(array_to_vector("x").alias("features"))
            # By blocks: by rows, each round has a task for each cell and sends all pairs of centres to the driver. A block's products with the centres are bounded, too.
            block = min(1.0, MOST_BYTES / (1 << 20) * common.width / k)
            means = KMeans(k=k, seed=seed, distanceMeasure="cosine", maxIter=20, solver="block", maxBlockSizeInMB=block)
            centres = means.fit(points).clusterCenters() if k > 1 else [np.asarray(points.first()[0].toArray())]
            centres = [c.tolist() for c in centres if np.any(c)]
        self.spark.createDataFrame(list(enumerate(centres)), "cell int, centre array<double>").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/centres")
        self.__dict__.pop("centres", None)
        return len(centres)

    @cached_property
    def centres(self) -> np.ndarray:
        """The centres at length one, by cell; bounded by ``MOST_BYTES``."""
        made = [r.centre for r in self.spark.read.parquet(f"{self.path}/centres").orderBy("cell").collect()]
        return unit(made, len(made[0]))[1] if made else np.zeros((0, 0))

    def add(self, rows: DataFrame, vector: str, run: int) -> None:
        """Stores a batch as a run, in place of any attempt at that run before. Nothing stored is read."""
        centres = self.centres

        def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in slices(frames, len(centres)):
                good, u = unit(pdf["v"].tolist(), centres.shape[1])
                if len(u) and len(centres):
                    cosines = u @ centres.T
                    yield pdf[good].assign(cell=cosines.argmax(axis=1).astype(np.int32), cosine=cosines.max(axis=1))

        kept = rows.filter(F.col(self.key).isNotNull()).select(F.col(self.key).cast(self.kind).alias("match"), F.col(vector).cast("array<double>").alias("v"))
        dealt = kept.mapInPandas(assign, f"match {self.kind}, v array<double>, cell int, cosine double")
        # One row a cell, of which there are at most MOST_BYTES / 8.
        sizes = F.broadcast(dealt.groupBy("cell").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")))
        chunked = dealt.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("match"), F.col("chunks")).cast("int"))
        packed = chunked.groupBy("cell", "chunk").agg(F.min("cosine").alias("least"), F.collect_list(F.struct("match", "v")).alias("rows"))
        view = f"{self.table}_new"
        packed.repartition(self.buckets, "cell", "chunk").createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION (run = {int(run)}) SELECT cell, chunk, least, rows FROM {view}")
        self.spark.catalog.dropTempView(view)

    def stored(self) -> DataFrame:
        """cell, chunk, least (the smallest cosine to the centre), rows of all runs."""
        if Folder(self.spark, f"{self.path}/rows").names():
            self.spark.catalog.recoverPartitions(self.table)  # other sessions may have added runs
        return self.spark.table(self.table)

    def cells(self) -> DataFrame:
        """One row a cell that holds rows: its chunks and its smallest cosine. No vectors are read."""
        return self.stored().groupBy("cell").agg((F.max("chunk") + 1).alias("chunks"), F.min("least").alias("least"))

    def search(self, queries: DataFrame, vector: str, k: int, probes: int = 8, exact: bool = False) -> DataFrame:
        """query, match, similarity, rank: for each row of the query set its ``k`` nearest stored rows in the ``probes`` cells next to it, ties by id.

        A row is not its own match; similarities have nine digits, so that ties are ties.
        With ``exact`` the cells that may hold something as near are searched as well,
        and the result is that of a search of all rows.
        """
        asked = queries.filter(F.col(self.key).isNotNull()).select(F.col(self.key).cast(self.kind).alias("query"), F.col(vector).cast("array<double>").alias("qv"))
        first = self._ranked(self._pairs(asked.mapInPandas(self._nearest_cells(probes), f"query {self.kind}, qv array<double>, cell int"), k), k)
        if not exact:
            return first
        first = self._kept(first)
        so_far = first.groupBy("query").agg(F.count("*").alias("found"), F.min("similarity").alias("worst"))
        least = F.when(F.col("found") >= k, F.col("worst"))
        bounded = asked.join(so_far, "query", "left").select("query", "qv", least.alias("worst"))
        more = bounded.mapInPandas(self._open_cells(probes), f"query {self.kind}, qv array<double>, cell int")
        return self._ranked(first.drop("rank").unionByName(self._pairs(more, k)), k)

    def calibrate(self, rows: DataFrame, vector: str, k: int, target: float = 0.97) -> int:
        """How many cells a search has to probe so that a share ``target`` of the ``k`` nearest rows lies in them.

        Measured by an exact search for ``MEASURED`` of the rows, chosen by a hash of the
        id; 1 where there is nothing to measure.
        """
        sample = self._kept(rows.filter(F.col(self.key).isNotNull()).select(self.key, vector).orderBy(F.xxhash64(self.key, F.lit(7))).limit(MEASURED))
        near = self._kept(self.search(sample, vector, k, exact=True).select("query", "match"))
        asked = F.broadcast(sample.select(F.col(self.key).cast(self.kind).alias("query"), F.col(vector).cast("array<double>").alias("qv")))
        held = self.stored().select("cell", F.explode("rows.match").alias("match")).join(F.broadcast(near), "match").join(asked, "query")
        found = held.select("qv", "cell").collect()  # MEASURED times k rows
        good, u = unit([r.qv for r in found], self.centres.shape[1])
        if not len(u):
            return 1
        cells = np.array([r.cell for r in found])[good]
        cosines = u @ self.centres.T
        before = (cosines > np.take_along_axis(cosines, cells[:, None], axis=1)).sum(axis=1)
        return int(np.quantile(before, target, method="higher")) + 1

    def _kept(self, df: DataFrame) -> DataFrame:
        """The rows as a table in the index's folder."""
        path = f"{self.path}/searches/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _nearest_cells(self, probes: int):
        centres = self.centres

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in slices(frames, centres.size):
                good, u = unit(pdf["qv"].tolist(), centres.shape[1])
                if len(u) and len(centres):
                    first = np.argsort(-(u @ centres.T), axis=1, kind="stable")[:, :probes]
                    out = pdf[good].loc[lambda d: d.index.repeat(first.shape[1])]
                    yield out.assign(cell=first.ravel().astype(np.int32))

        return run

    def _open_cells(self, probes: int):
        """The cells not probed yet that may hold a row as near as the worst found."""
        centres, width = self.centres, np.full(len(self.centres), -np.inf)
        for r in self.cells().select("cell", "least").collect():  # one row a cell
            width[r.cell] = np.arccos(min(1.0, max(-1.0, r.least)))

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            # A query may be sent to every cell, with its vector.
            for pdf in slices(frames, centres.size):
                good, u = unit(pdf["qv"].tolist(), centres.shape[1])
                if not len(u) or not len(centres):
                    continue
                cosines = np.clip(u @ centres.T, -1, 1)
                angles = np.arccos(np.clip(pdf["worst"][good].fillna(-1.0).to_numpy(float), -1, 1))
                may = np.arccos(cosines) - width <= angles[:, None] + SLACK
                np.put_along_axis(may, np.argsort(-cosines, axis=1, kind="stable")[:, :probes], False, axis=1)
                row, cell = np.nonzero(may)
                yield pdf[good].iloc[row][["query", "qv"]].assign(cell=cell.astype(np.int32))

        return run

    def _pairs(self, asked: DataFrame, k: int) -> DataFrame:
        """The best ``k`` of each chunk, and what ties with them, for queries dealt to cells."""
        # Both are one row a cell.
        blocks = F.broadcast(asked.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")))
        block = F.pmod(F.xxhash64("query"), F.col("blocks")).alias("block")
        packed = asked.join(blocks, "cell").groupBy("cell", block).agg(F.collect_list(F.struct("query", "qv")).alias("qs"))
        placed = packed.join(F.broadcast(self.cells()), "cell").select("cell", "qs", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
        met = placed.hint("merge").join(self.stored().select("cell", "chunk", "rows").hint("merge"), ["cell", "chunk"])
        return met.select("qs", "rows").mapInArrow(products(k), f"query {self.kind}, match {self.kind}, similarity double")

    def _ranked(self, pairs: DataFrame, k: int) -> DataFrame:
        return numbered(pairs, ["query"], F.desc("similarity"), F.asc("match")).filter(F.col("rn") <= k).withColumnRenamed("rn", "rank")


def recall(found: DataFrame, true: DataFrame) -> DataFrame:
    """n_queries, n_nearest, n_found, recall of a search against an exact one, matched by query and match."""
    hit = found.select("query", "match", F.lit(True).alias("hit"))
    both = true.select("query", "match").join(hit, ["query", "match"], "left")
    counts = both.agg(F.count_distinct("query").alias("n_queries"), F.count("*").alias("n_nearest"), F.count("hit").alias("n_found"))
    return counts.withColumn("recall", F.try_divide("n_found", "n_nearest"))
