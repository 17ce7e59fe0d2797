"""Language identification by error-correcting output codes over byte trigrams.

Every language has a codeword; for each of its bits a binary classifier is learned
that tells the languages with a one from those with a zero. A classifier is linear:
for each hashed trigram the log-odds between the two sides, from the counts of all
training texts, gathered in one Spark aggregation. A text's language is the codeword
with the least loss against its margins, each bit weighted by the least margin that it
is expected to have on any language; where the two nearest codewords are close the
answer is flagged.

Weights are whole numbers (of 2^-20), so sums over a text are exact and a text's score
follows from the text alone, whatever texts it is taken with.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.llm.common import documents, held_out, raw_texts

BUCKETS_LOG2 = 14
LETTER = re.compile(r"[^\W\d_]")
PIECE = 1 << 20
UNIT = 1 << 20
#: A flag is set where the best codeword has less than this share against the second best.
AMBIGUOUS = 0.6


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` languages: all distinct splits while they are few, else a random code with the largest least distance of 50 drawn."""
    if n <= 6:
        bits = [[1 if i == 0 or (j >> (i - 1)) & 1 else -1 for j in range(2 ** (n - 1) - 1)] for i in range(n)]
        return np.array(bits, np.int8).reshape(n, -1)
    rng = np.random.default_rng(seed)
    width = 10 * int(np.ceil(np.log2(n)))
    best, far = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (n, width))
        least = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if least > far and not (np.abs(code.sum(axis=0)) == n).any():
            best, far = code, least
    return best


def _trigrams(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of the texts, each between two spaces, and how many each text has: as many as bytes. None spans two texts."""
    x = np.frombuffer(b"".join(b" " + r + b" " for r in raws), np.uint8).astype(np.uint32)
    sizes = np.array([len(r) for r in raws], np.int64)
    code = (x[:-2] | (x[1:-1] << np.uint32(8)) | (x[2:] << np.uint32(16))) * np.uint32(0x9E3779B1)
    inside = np.ones(len(x), bool)
    ends = np.cumsum(sizes + 2)
    inside[ends - 1] = inside[ends - 2] = False
    return (code >> np.uint32(32 - BUCKETS_LOG2)).astype(np.int32)[inside[: len(code)]], sizes


def _portions(raws: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about a megabyte, with the index of the first."""
    at, size, start = [], 0, 0
    for i, raw in enumerate(raws):
        at.append(raw)
        size += len(raw)
        if size >= PIECE:
            yield start, at
            at, size, start = [], 0, i + 1
    if at:
        yield start, at


class Code:
    """Languages, their codewords, the classifiers' weights (bucket by bit) and the bits' weights."""

    def __init__(self, langs: list[str], words: np.ndarray, weights: np.ndarray, bit_weight: np.ndarray):
        self.langs, self.words, self.weights, self.bit_weight = langs, words, weights, bit_weight

    def margins(self, raws: list[bytes]) -> np.ndarray:
        """The mean weight over each text's trigrams, for every bit."""
        found = np.zeros((len(raws), self.words.shape[1]))
        columns = np.ascontiguousarray(self.weights.T)
        for start, part in _portions(raws):
            grams, sizes = _trigrams(part)
            ends = np.cumsum(sizes)
            for bit, weight in enumerate(columns):
                total = np.concatenate(([0], np.cumsum(weight[grams], dtype=np.int64)))
                found[start : start + len(part), bit] = (total[ends] - total[ends - sizes]) / (np.maximum(sizes, 1) * float(UNIT))
        return found

    def decode(self, margins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text the nearest codeword and its share among all codewords."""
        sharp = np.minimum(np.sqrt(sizes), 40.0)[:, None]
        loss = np.zeros((len(margins), len(self.langs)))
        for i, word in enumerate(self.words):
            loss[:, i] = (self.bit_weight * np.logaddexp(0, -margins * word * sharp)).sum(axis=1)
        share = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        return loss.argmin(axis=1), share.max(axis=1)


def fit(docs: DataFrame, usable: F.Column) -> Code:
    """Learns from text and lang of all usable rows; null texts and languages teach nothing, repeated rows count each. The driver gets one count for each language and bucket, whatever the number of rows."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & usable).select("lang", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            raws = list(raw_texts(batch.column(1)))
            for start, part in _portions(raws):
                grams, sizes = _trigrams(part)
                of = np.repeat(np.arange(start, start + len(part)), sizes)
                names, place = np.unique(langs[start : start + len(part)].astype(str), return_inverse=True)
                own = place[of - start]
                hist = np.bincount(own * (1 << BUCKETS_LOG2) + grams, minlength=len(names) << BUCKETS_LOG2).reshape(len(names), -1)
                for name, h in zip(names, hist):
                    totals[name] = totals.get(name, 0) + h
        for name, h in totals.items():
            used = np.flatnonzero(h)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(h[used], pa.int64())], ["lang", "bucket", "n"])

    counts = rows.mapInArrow(counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(counts.column("lang").to_pylist()))
    if not langs:
        return Code([], np.zeros((0, 0), np.int8), np.zeros((1 << BUCKETS_LOG2, 0), np.int32), np.zeros(0))
    table = np.full((len(langs), 1 << BUCKETS_LOG2), 0.5)
    place = {x: i for i, x in enumerate(langs)}
    np.add.at(table, (np.array([place[x] for x in counts.column("lang").to_pylist()]), counts.column("bucket").to_numpy()), counts.column("n").to_numpy())
    share = table / table.sum(axis=1, keepdims=True)
    words = codewords(len(langs))
    weights, strength = np.zeros((1 << BUCKETS_LOG2, words.shape[1])), np.zeros(words.shape[1])
    for bit in range(words.shape[1]):
        ones, zeros = share[words[:, bit] > 0].mean(axis=0), share[words[:, bit] < 0].mean(axis=0)
        weights[:, bit] = np.log(ones) - np.log(zeros)
        expected = share @ weights[:, bit] * words[:, bit]
        strength[bit] = 1 / (1 + np.exp(-10 * expected.min()))
    return Code(langs, words, np.rint(np.clip(weights, -4, 4) * UNIT).astype(np.int32), strength / max(strength.sum(), 1e-9) * 2)


def predicted(docs: DataFrame, code: Code) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous for every row of ``docs``.

    ``und`` with score 0 where the text is null or has no letter, or nothing was
    learned; with one language learned it is the answer for every other text. Repeated
    rows and null ids each get a row; an empty table gives none; other columns are not
    looked at.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(code)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            letters = np.array([bool(t and LETTER.search(t)) for t in texts], bool) & bool(c.langs)
            raws = [(t or "").encode() for t in texts]
            if len(c.langs) > 1 and len(raws):
                best, score = c.decode(c.margins(raws), np.array([len(r) for r in raws]))
            else:
                best, score = np.zeros(len(raws), int), np.ones(len(raws))
            langs = [c.langs[b] if ok else "und" for b, ok in zip(best, letters)]
            score = np.round(np.where(letters, score, 0.0), 9)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(letters & (score < AMBIGUOUS))], ["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    code = fit(docs, ~held_out(3, 1))
    return predicted(docs, code).select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score", "ambiguous")
