"""A bitmap of marked 64-bit hashes as a small broadcast table, in DataFrame functions only.

A hash marks one place of ``2**log2`` places. The places are kept as rows of 32,768
bits, so the table has ``2**log2 / 8`` bytes at most, whatever the input; that bounds
the broadcast. A row whose place is unmarked has a hash that was not marked; a marked
place may belong to another hash, so what passes the test has to be joined exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.llm.common import fresh, stored

ROW_LOG2 = 15
#: 2^28 places are 32 MB. More hashes than fit well make more rows pass the test, and nothing is lost.
MOST_LOG2 = 28


def size_for(n: int, places_per_hash: int = 32) -> int:
    """log2 of the places for ``n`` hashes, between one row of bits and the most."""
    return min(MOST_LOG2, max(ROW_LOG2, math.ceil(math.log2(max(1, n) * places_per_hash))))


def _place(hashed: F.Column, log2: int) -> F.Column:
    return hashed.bitwiseAND(F.lit((1 << log2) - 1))


def bitmap(hashes: DataFrame, column: str, log2: int, least: int = 1) -> DataFrame:
    """(slot, bits): the places that ``least`` or more of the hashes mark, stored. Rows combine before each shuffle; nulls mark nothing."""
    places = hashes.filter(F.col(column).isNotNull()).groupBy(_place(F.col(column), log2).alias("p")).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    slot = F.shiftright("p", ROW_LOG2).cast("int").alias("slot")
    return stored(places.groupBy(slot).agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit((1 << ROW_LOG2) - 1))).alias("bits")))


def tested(rows: DataFrame, hashed: F.Column, bits: DataFrame, log2: int, name: str) -> DataFrame:
    """``rows`` with a boolean column: whether the hash's place is marked. ``bits`` is broadcast, see above for its size."""
    place, slot, own = fresh([*rows.columns, name], "place", "slot", "bits")
    with_place = rows.withColumn(place, _place(hashed, log2))
    at = F.col(place).bitwiseAND(F.lit((1 << ROW_LOG2) - 1)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(own), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.coalesce(F.getbit(byte, at.bitwiseAND(F.lit(7))) == 1, F.lit(False))
    table = F.broadcast(bits.select(F.col("slot").alias(slot), F.col("bits").alias(own)))
    joined = with_place.join(table, F.shiftright(F.col(place), ROW_LOG2).cast("int") == F.col(slot), "left")
    return joined.withColumn(name, marked).drop(place, slot, own)
