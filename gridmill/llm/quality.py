"""Quality scores from compression: how well a text packs with a dictionary of good text and with one of bad text.

Two zstandard dictionaries are built from a bounded sample of labelled texts. A text
is cut into blocks of fixed size, so that the dictionary and not the text's own past
is what helps, and every block is compressed with both. The difference of the two
compressed sizes, divided by the text's length, goes through a logistic curve fitted
on whole sample texts that the dictionaries have not seen. The driver gets blocks of
the one part of the sample and differences of the other, never texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from gridmill.llm.common import documents, held_out, labels, raw_texts, stored
from gridmill.llm.samples import labelled_sample, logistic

PER_CLASS = 1500
BLOCK = 512
DICTIONARY = 112_640
LEVEL = 3
#: About so many blocks of each class, chosen by a hash from all blocks of the sample texts, make a dictionary.
BLOCKS = 8000


class Compression:
    """The two dictionaries (bad, good) and the curve. Without both classes every score is the share of good labels."""

    def __init__(self, bad: bytes, good: bytes, curve: list[float]):
        self.bad, self.good, self.curve = bad, good, curve

    def compressors(self):
        import zstandard

        of = lambda d: zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d) if d else None, write_content_size=False, write_checksum=False, write_dict_id=False)
        return of(self.bad), of(self.good)


def difference(raw: bytes, bad, good) -> float:
    """Bytes saved for each byte of text when the good dictionary is used instead of the bad one; 0 for an empty text."""
    saved = 0
    for at in range(0, len(raw), BLOCK):
        part = raw[at : at + BLOCK]
        saved += len(bad.compress(part)) - len(good.compress(part))
    return saved / max(1, len(raw))


def _dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary, or the joined blocks themselves where there is too little to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY:]


def blocks_of(sample: DataFrame, per_class: int = BLOCKS) -> dict[int, list[bytes]]:
    """For each class about ``per_class`` of the blocks of all its texts, in an order that follows from the blocks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, y in zip(raw_texts(batch.column(0)), batch.column(1).to_pylist()):
                blocks = [raw[at : at + BLOCK] for at in range(0, len(raw), BLOCK)]
                if blocks:
                    yield pa.RecordBatch.from_arrays([pa.array([y] * len(blocks), pa.int32()), pa.array(range(len(blocks)), pa.int64()), pa.array(blocks, pa.binary())], ["y", "at", "block"])

    blocks = sample.select("text", "y").mapInArrow(cut, "y int, at long, block binary").withColumn("h", F.xxhash64("block", "at"))
    share = F.lit(1.0)
    for r in blocks.groupBy("y").count().collect():
        share = F.when(F.col("y") == r["y"], F.lit(per_class / r["count"])).otherwise(share)
    rows = blocks.filter(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).orderBy("h", "block").collect()
    return {y: [bytes(r.block) for r in rows if r.y == y] for y in (0, 1)}


def differences(docs: DataFrame, model: Compression, *kept: str) -> DataFrame:
    """The named columns of every row and x, the difference of its text in percent."""
    columns = [docs.schema[c] for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bad, good = model.compressors()
        for batch in batches:
            x = [difference(raw, bad, good) * 100 for raw in raw_texts(batch.column(len(kept)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(x, pa.float64())], [*kept, "x"])

    return docs.select(*kept, "text").mapInArrow(run, StructType([*columns, StructField("x", DoubleType())]))


def fit(docs: DataFrame, marks: DataFrame, usable: F.Column, per_class: int = PER_CLASS) -> Compression:
    """Fits on about ``per_class`` texts of each quality, of any length; two thirds make the dictionaries and one third the curve. Null texts count as empty."""
    sample, counts = labelled_sample(docs, marks, "quality", usable, per_class)
    sample = stored(sample.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(3)).cast("int")))
    total = sum(counts.values())
    prior = (counts.get(1, 0) + 1) / (total + 2)
    plain = Compression(b"", b"", [float(np.log(prior / (1 - prior))), 0.0])
    blocks = blocks_of(sample.filter("part < 2"))
    if not blocks[0] or not blocks[1]:
        blocks = blocks_of(sample)
    if not blocks[0] or not blocks[1]:
        return plain
    model = Compression(_dictionary(blocks[0]), _dictionary(blocks[1]), [])
    rows = differences(sample.select("doc_id", "text", "y", "part"), model, "doc_id", "y", "part").orderBy("doc_id", "x").collect()
    chosen = []
    for y in (0, 1):
        of = [r for r in rows if r.y == y]
        chosen += [r for r in of if r.part == 2] or of
    y = np.array([r.y for r in chosen], float)
    if len(set(y)) < 2:
        return plain
    weight = np.where(y == 1, counts[1] / total / y.sum(), counts[0] / total / (len(y) - y.sum())) * len(y)
    model.curve = logistic(np.array([r.x for r in chosen])[:, None], y, weight).tolist()
    return model


def scored(docs: DataFrame, model: Compression) -> DataFrame:
    """doc_id, score, predicted for every row of ``docs``.

    Null and empty texts get the curve's value at no difference. Repeated rows and null
    ids each get a row; an empty table gives none; other columns are not looked at.
    """
    z = F.lit(model.curve[0]) + F.col("x") * model.curve[1]
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return differences(slim, model, "doc_id").select("doc_id", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = fit(docs, labels(spark, sf_dir), ~held_out(3, 1))
    return scored(docs, model).select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")
