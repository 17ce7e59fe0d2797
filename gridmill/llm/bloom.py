"""A counting Bloom filter over hashes, built in Spark, that answers "may this hash occur twice?".

The filter is split into blocks by the top bits of the hash. Map tasks send each
block the hashes that fall into it; the reducer of a block counts bit positions up
to 255 and keeps two bitmaps: positions hit twice or more, and positions hit ``hot``
times or more. The bitmaps together have ``2 * 2**log2_bits`` bits whatever the
input, so sending them to the tasks has a fixed bound. A filter too small for its
input lets more hashes pass; it never loses a repeated one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_LOG2 = 18
HASHES = 3
#: Hashes that a map task gathers before it sends them off.
HELD = 2_000_000


def size_for(n: int, bits_per_hash: int = 12, most_log2: int = 28) -> int:
    """log2 of the bits for ``n`` hashes, between one block and ``2**most_log2`` bits."""
    return min(most_log2, max(BLOCK_LOG2, math.ceil(math.log2(max(1, n) * bits_per_hash))))


def _positions(h: np.ndarray) -> np.ndarray:
    """The positions of each hash in its block, one row for each of the three."""
    mask = np.uint64((1 << BLOCK_LOG2) - 1)
    return np.stack([(h >> np.uint64(BLOCK_LOG2 * i)) & mask for i in range(HASHES)]).astype(np.int64)


def _block(h: np.ndarray, log2_bits: int) -> np.ndarray:
    return (h >> np.uint64(BLOCK_LOG2 * HASHES)).astype(np.int64) % (1 << (log2_bits - BLOCK_LOG2))


class Repeats:
    """The finished filter, as tasks get it."""

    def __init__(self, log2_bits: int, twice: np.ndarray, hot: np.ndarray):
        self.log2_bits, self.twice, self.hot = log2_bits, twice, hot

    def _all_set(self, bits: np.ndarray, h: np.ndarray) -> np.ndarray:
        at = _positions(h) + (_block(h, self.log2_bits) << BLOCK_LOG2)
        return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)

    def maybe(self, h: np.ndarray) -> np.ndarray:
        """Whether each hash may occur twice or more."""
        return self._all_set(self.twice, h)

    def frequent(self, h: np.ndarray) -> np.ndarray:
        """Whether each hash may occur ``hot`` times or more."""
        return self._all_set(self.hot, h)


def repeats(hashes: DataFrame, column: str, log2_bits: int, hot: int = 255):
    """Broadcasts the filter over a long column of well-mixed 64-bit hashes. Nulls are ignored; no rows give an empty filter."""
    spark = hashes.sparkSession
    blocks = 1 << (log2_bits - BLOCK_LOG2)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            h = batch.column(0).drop_null().to_numpy(zero_copy_only=False).view(np.uint64)
            held.append(h)
            size += len(h)
            if size >= HELD:
                yield by_block(np.concatenate(held))
                held, size = [], 0
        if size:
            yield by_block(np.concatenate(held))

    def by_block(h: np.ndarray) -> pa.RecordBatch:
        block = _block(h, log2_bits)
        order = np.argsort(block, kind="stable")
        block, h = block[order], h[order]
        cuts = np.flatnonzero(np.diff(block)) + 1
        firsts = block[np.concatenate(([0], cuts))]
        return pa.RecordBatch.from_arrays([pa.array(firsts, pa.int32()), pa.array([p.tobytes() for p in np.split(h, cuts)], pa.binary())], ["block", "hs"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, hs in zip(batch.column(0).to_pylist(), batch.column(1)):
                at = _positions(np.frombuffer(hs.as_py(), np.uint64)).ravel()
                had = counts.setdefault(block, np.zeros(1 << BLOCK_LOG2, np.uint8))
                if len(at) > 20_000:
                    had[:] = np.minimum(had + np.bincount(at, minlength=len(had)), 255)
                else:
                    places, more = np.unique(at, return_counts=True)
                    had[places] = np.minimum(had[places] + more, 255)
        for block, had in counts.items():
            # Where a block is so full that many counts are high by chance, nothing in it is called frequent.
            marks = (had >= 2, had >= (hot if had.mean() * 8 < hot else 256))
            packed = [np.packbits(m, bitorder="little").tobytes() for m in marks]
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), *(pa.array([p], pa.binary()) for p in packed)], ["block", "twice", "hot"])

    parts = min(blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = hashes.select(column).mapInArrow(dealt, "block int, hs binary").repartition(parts, "block").mapInArrow(counted, "block int, twice binary, hot binary")
    twice, often = np.zeros(1 << (log2_bits - 3), np.uint8), np.zeros(1 << (log2_bits - 3), np.uint8)
    width = 1 << (BLOCK_LOG2 - 3)
    for row in rows.collect():  # of fixed size in all, see above
        twice[row.block * width : (row.block + 1) * width] = np.frombuffer(row.twice, np.uint8)
        often[row.block * width : (row.block + 1) * width] = np.frombuffer(row.hot, np.uint8)
    return spark.sparkContext.broadcast(Repeats(log2_bits, twice, often))
