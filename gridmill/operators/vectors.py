"""Embedding dataflow and vector analytics (rows E01 to E09)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.functions.scalars import join_nonblank
from gridmill.operators.dedupe import dedupe, numbered

#: About so many rows of the base are multiplied with a block of queries at a time.
CHUNK = 2048


def embedding_text(*columns: Column) -> Column:
    """The columns' trimmed non-blank texts joined by a blank line; '' where all are blank."""
    return join_nonblank(*columns)


def select_to_embed(rows: DataFrame, stored: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """The last row of each id that has text and no vector yet."""
    return dedupe(rows, [key], order, "last").filter(F.trim(text) != "").join(stored.select(key).distinct(), key, "left_anti")


def encode(df: DataFrame, text: str, encoder: Callable[[list[str]], np.ndarray], model: str) -> DataFrame:
    """Vectors from a pluggable encoder (texts to an array of rows), called on Arrow batches. A batch that fails keeps its rows, with null vectors to be counted."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            try:
                vectors = list(np.asarray(encoder(pdf[text].tolist()), np.float32))
            except Exception:  # noqa: BLE001
                vectors = [None] * len(pdf)
            yield pdf.assign(embedding=vectors, embedding_model=model)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, f"{schema}, embedding array<float>, embedding_model string")


def hashing_vectors(df: DataFrame, text: str, width: int = 64) -> DataFrame:
    """The default encoder, in the JVM: hashed word counts, scaled to length one; a text without words has the zero vector."""
    from pyspark.ml.feature import HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), lambda w: w != "")
    counts = HashingTF(numFeatures=width, inputCol="_words", outputCol="_counts").transform(df.withColumn("_words", words))
    scaled = Normalizer(p=2.0, inputCol="_counts", outputCol="_scaled").transform(counts)
    return scaled.withColumn("embedding", vector_to_array("_scaled")).drop("_words", "_counts", "_scaled")


def embed_status(total: Column, fresh: Column) -> Column:
    """Empty, up_to_date or success."""
    return F.when(total == 0, "empty").when(fresh == 0, "up_to_date").otherwise("success")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """The cosine of two vectors; null where either has no length."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def directions(items: pa.StructArray, width: int) -> tuple[pa.Array, np.ndarray]:
    """Ids and vectors at length one, of those with ``width`` entries, none null or not finite, not all zero."""
    ids, v = items.flatten()
    fits = pc.equal(pc.list_value_length(v), width).fill_null(False)
    ids, m = ids.filter(fits), v.filter(fits).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    with np.errstate(all="ignore"):
        m = m / np.linalg.norm(m, axis=1, keepdims=True)
    fine = np.isfinite(m).all(axis=1)
    return ids.filter(pa.array(fine)), m[fine]


def products(k: int):
    """Of arrays ``qs`` (query, qv) and ``rows`` (match, v) the cosines of each query with the rows: its best ``k`` and what ties with them.

    Vectors without length, empty, with nulls or not finite are left out, and so is a row
    met by itself; vectors of different lengths are not compared.
    """

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for qs, rows in zip(*([item.values for item in column] for column in batch.columns)):
                widths = [set(pc.unique(pc.list_value_length(side.field(1))).to_pylist()) for side in (qs, rows)]
                for width in (widths[0] & widths[1]) - {0, None}:
                    (queries, a), (matches, b) = directions(qs, width), directions(rows, width)
                    if not len(a) or not len(b):
                        continue
                    scores = np.round(a @ b.T, 9)
                    # One more than k, as a row may meet itself.
                    least = np.partition(scores, -k - 1, axis=1)[:, [-k - 1]] if len(b) > k + 1 else -np.inf
                    q, m = np.nonzero(scores >= least)
                    made = pa.RecordBatch.from_arrays([queries.take(pa.array(q)), matches.take(pa.array(m)), pa.array(scores[q, m])], ["query", "match", "similarity"])
                    same = pc.or_(pc.equal(made[0], made[1]).fill_null(False), pc.and_(made[0].is_null(), made[1].is_null()))
                    yield made.filter(pc.invert(same))

    return nearest


def cosine_topk(queries: DataFrame, base: DataFrame, key: str, vector: str, k: int, block: int = 64) -> DataFrame:
    """The k nearest rows of ``base`` for each row of the stated query set, ties by key; similarities have nine digits, so that ties are ties.

    Queries are packed into blocks of ``block`` rows and the base into chunks; every
    block meets every chunk once, as a product of two matrices of rows of length one.
    Of each product the best k for a query (and what ties with them) go to the ranking's
    shuffle. Vectors without length, empty or with nulls are near to nothing and left out.
    Both sides are shuffled: the blocks are small, but as many times as there are chunks
    they are not, and nothing of them passes the driver.
    """
    spark = base.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-queries.count() // block))
    chunks = max(1, -(-base.count() // (parts * CHUNK)))
    kind = base.schema[key].dataType.simpleString()
    packed = queries.groupBy(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("_block")).agg(F.collect_list(F.struct(F.col(key).alias("query"), F.col(vector).cast("array<double>").alias("qv"))).alias("qs"))
    everywhere = packed.select("_block", "qs", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part"))
    dealt = base.select(F.col(key).alias("match"), F.col(vector).cast("array<double>").alias("v"), F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("_part"))
    # Rows of one chunk of the base, once for each block of queries.
    chunked = dealt.groupBy("_part", F.pmod(F.xxhash64("match", F.lit(1)), F.lit(chunks)).alias("_chunk")).agg(F.collect_list(F.struct("match", "v")).alias("rows"))

    pairs = chunked.hint("merge").join(everywhere.hint("merge"), "_part").select("qs", "rows").mapInArrow(products(k), f"query {kind}, match {kind}, similarity double")
    return numbered(pairs, ["query"], F.desc("similarity"), F.asc("match")).filter(F.col("rn") <= k).withColumnRenamed("rn", "rank")


def pca(df: DataFrame, vector: str, k: int = 2) -> DataFrame:
    """Projections on the first k principal components of the centred vectors."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = df.withColumn("_x", array_to_vector(F.col(vector).cast("array<double>")))
    v = StandardScaler(inputCol="_x", outputCol="_c", withMean=True, withStd=False).fit(v).transform(v)
    out = PCA(k=k, inputCol="_c", outputCol="_p").fit(v).transform(v)
    return out.withColumn("projection", vector_to_array("_p")).drop("_x", "_c", "_p")


def kmeans(df: DataFrame, vector: str, k: int, seed: int = 42) -> tuple[DataFrame, float]:
    """A cluster for every row, and the inertia."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    v = df.withColumn("_x", array_to_vector(F.col(vector).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_x", predictionCol="cluster").fit(v)
    return model.transform(v).drop("_x"), model.summary.trainingCost


def inertia_sweep(df: DataFrame, vector: str, ks: list[int], seed: int = 42) -> DataFrame:
    """The inertia for each number of clusters, one fit each."""
    return df.sparkSession.createDataFrame([(k, float(kmeans(df, vector, k, seed)[1])) for k in ks], "k int, inertia double")
