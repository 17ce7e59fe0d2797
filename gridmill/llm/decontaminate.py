"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item's windows (10 consecutive words, or all words of a shorter item) are sets of
shingles of three words (fewer in a window of fewer). A window lies in a document only
if all its shingles do, one after the other, so its rarest shingle is a prefix that a
document cannot lack. The steps:

1. One pass over the documents keeps the shingles that some window may hold, by a bitmap
   of bounded size, with the few words around each.
2. The kept shingles are counted, and every window's are ordered by rarity.
3. Kept shingles are joined to the windows whose rarest shingle they are. Its place in
   the window fixes where the window would begin (the positional bound), the words from
   there have to be enough (the length bound), and they are compared word by word.

Matches are then united by document.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.llm import bitmaps
from gridmill.llm.common import documents, stored

WINDOW = 10
SHINGLE = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Letters beyond ASCII that a lower-casing of the whole text might change, and code points that the pattern's tables may not know.
CASED = r"[[^\x00-\x7F]&&[\p{Lu}\p{Lt}\p{Nl}\p{So}\p{Cn}]]"
#: Places of the bitmap that stands in the plan: 512 for a shingle, 2^22 (half a megabyte) at most. Where fewer than 8 a shingle fit, a broadcast bitmap of 32 MB at most stands in for it.
PLACES, MOST_LOG2, FEWEST_PLACES = 512, 22, 8

def lowered(text: F.Column) -> F.Column:
    """The text with A-Z lower-cased and nothing else: the fast built-in where it does the same."""
    same = (F.octet_length(text) == F.length(text)) | ~F.rlike(text, F.lit(CASED))
    return F.when(same, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: F.Column) -> F.Column:
    """The words of a text; none of a null."""
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), BETWEEN, -1), "")


def _shingle(w: F.Column, at: F.Column, k: int) -> F.Column:
    """A hash of the k words from ``at`` (0-based)."""
    return F.xxhash64(*[F.get(w, at + i) for i in range(k)])


def _shingles(w: F.Column, k: int) -> F.Column:
    """The hashes of all shingles of k words; ``w`` has k or more."""
    return F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: _shingle(w, i, k))


def _size_class(n: F.Column) -> F.Column:
    return F.least(n, F.lit(SHINGLE))


class Windows:
    """The windows of all items: ``windows`` (wid, w, m, k), each different one once; ``links`` (wid, item_id); ``shingles`` (wid, k, h, p). All stored."""

    def __init__(self, benchmark: DataFrame):
        items = benchmark.select("item_id", words(F.col("text")).alias("all")).filter(F.size("all") > 0)
        starts = F.sequence(F.lit(1), F.greatest(F.size("all") - (WINDOW - 1), F.lit(1)))
        cut = stored(items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("all", i, F.lit(WINDOW)))).alias("w")).distinct())
        made = cut.select("w").distinct().select(F.monotonically_increasing_id().alias("wid"), "w", F.size("w").alias("m"), _size_class(F.size("w")).alias("k"))
        self.windows = stored(made)
        self.links = stored(cut.filter("item_id is not null").join(self.windows, "w").select("wid", "item_id"))
        parts = [self.windows.filter(F.col("k") == k).select("wid", "k", F.posexplode(_shingles(F.col("w"), k)).alias("p", "h")) for k in range(1, SHINGLE + 1)]
        self.shingles = stored(parts[0].unionByName(parts[1]).unionByName(parts[2]))
        #: For each shingle size in use the number of shingles that the shortest window has.
        self.least = {r.k: r.n for r in self.windows.groupBy("k").agg((F.min("m") - F.col("k") + 1).alias("n")).collect()}

    def marks(self, most_log2: int = MOST_LOG2) -> tuple[F.Column, int] | None:
        """The shingles' bitmap as an array of longs and its size's log2; None where they are too many for one."""
        distinct = self.shingles.select("h").distinct()
        n = distinct.count()
        log2 = min(most_log2, max(10, math.ceil(math.log2(max(1, n) * PLACES))))
        if n * FEWEST_PLACES > 1 << log2:
            return None
        place = F.col("h").bitwiseAND(F.lit((1 << log2) - 1))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
        filled = distinct.groupBy(F.shiftright(place, 6).cast("int").alias("slot")).agg(F.bit_or(one).alias("bits"))
        bits = ["0"] * (1 << (log2 - 6))
        for r in filled.collect():  # at most 2^16 rows
            bits[r.slot] = str(r.bits)
        return F.split(F.lit(",".join(bits)), ",").cast("array<bigint>"), log2


def kept_shingles(docs: DataFrame, windows: Windows, most_log2: int = MOST_LOG2) -> DataFrame:
    """row, doc_id, n_words, at, h1..h3, first, near of every row of ``docs``, stored; ``row`` is a number of its own for each.

    Every row of ``docs`` has one with ``at`` -1, and one for each place that has
    shingles that may be a window's: their hashes by size, the words around them, and
    where these begin. Not a bit of it is a lambda, so the pass is one stage of
    generated code, and a text's words are held once.
    """
    sizes, w, at = sorted(windows.least), F.col("w"), F.col("at")
    split = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col("text")).alias("w"))
    # Not explode: a filter on the sequence's size would be inferred, which splits the text again.
    placed = split.select("row", "doc_id", "w", F.explode_outer(F.sequence(F.lit(-1), F.greatest(F.size("w") - min(sizes, default=1), F.lit(-1)))).alias("at"))
    marks, kept = windows.marks(most_log2), {}
    if marks is None:
        log2 = bitmaps.size_for(windows.shingles.count())
        bits = bitmaps.bitmap(windows.shingles, "h", log2)
        for k in sizes:
            placed = bitmaps.tested(placed, _shingle(w, at, k), bits, log2, f"marked{k}")
            kept[k] = F.col(f"marked{k}")
    else:

        def marked(i: F.Column, k: int) -> F.Column:
            place = _shingle(w, i, k).bitwiseAND(F.lit((1 << marks[1]) - 1))
            return F.call_function("getbit", F.get(marks[0], F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")) == 1

        for k in sizes:
            kept[k] = marked(at, k)
    kept = {k: (at >= 0) & (at + k <= F.size("w")) & c for k, c in kept.items()}
    either = at < 0
    for c in kept.values():
        either = either | c
    first = F.greatest(at - (WINDOW - 1), F.lit(0))
    hashes = [F.when(kept[k], _shingle(w, at, k)).alias(f"h{k}") if k in kept else F.lit(None).cast("long").alias(f"h{k}") for k in range(1, SHINGLE + 1)]
    near = F.when(at >= 0, F.slice("w", first + 1, at - first + WINDOW))
    return stored(placed.filter(either).select("row", "doc_id", F.size("w").alias("n_words"), "at", *hashes, first.alias("first"), near.alias("near")))


def rarest(windows: Windows, counts: DataFrame) -> DataFrame:
    """wid, k, h, p, w, m: every window with its rarest shingle by ``counts`` (k, h, n). Windows with a shingle that is nowhere are left out. Ties go by hash and place."""
    counted = windows.shingles.join(counts, ["k", "h"], "left")
    least = counted.groupBy("wid").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "p")).alias("s")).filter("s.n > 0")
    return least.join(windows.windows, "wid").select("wid", "k", "s.h", "s.p", "w", "m")


def matches(kept: DataFrame, windows: Windows) -> DataFrame:
    """row, start, m, wid of every occurrence of a window, stored."""
    places = kept.filter("at >= 0")
    shingles = [places.filter(f"h{k} is not null").select("row", F.lit(k).alias("k"), F.col(f"h{k}").alias("h"), "at", "first", "near") for k in sorted(windows.least)]
    shingles = functools.reduce(DataFrame.unionByName, shingles)
    prefixes = stored(rarest(windows, shingles.groupBy("k", "h").agg(F.count("*").alias("n"))))
    start = F.col("at") - F.col("p")
    offset = start - F.col("first")
    met = shingles.join(prefixes, ["k", "h"]).filter((offset >= 0) & (offset + F.col("m") <= F.size("near")))
    # A row out of bounds never asks for a slice from a negative start.
    equal = F.slice("near", F.greatest(offset, F.lit(0)) + 1, F.col("m")) == F.col("w")
    return stored(met.filter(equal).select("row", start.alias("start"), "m", "wid"))


def _united(spans: F.Column) -> F.Column:
    """How many words the spans (start, m), sorted, cover together."""
    first = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(state: F.Column, s: F.Column) -> F.Column:
        end = F.greatest(s["start"] + s["m"], state["end"])
        return F.struct(end.alias("end"), (state["n"] + end - F.greatest(state["end"], s["start"])).alias("n"))

    return F.aggregate(spans, first, step, lambda state: state["n"])


def contaminated(docs: DataFrame, benchmark: DataFrame, most_log2: int = MOST_LOG2) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null or empty text has no words and no hit; very long texts are split in memory,
    one at a time. Repeated rows and rows without a doc_id are each looked at. Items
    that repeat an id count as one; an item without an id hits words and is not counted;
    a null or empty item has no window. An empty benchmark hits nothing, and an empty
    table gives none. Other columns are not looked at.
    """
    windows = Windows(benchmark)
    kept = kept_shingles(docs, windows, most_log2)
    base = kept.filter("at < 0").select("row", "doc_id", "n_words")
    if windows.least:
        found = matches(kept, windows)
        hits = found.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "m"))).alias("spans")).select("row", _united(F.col("spans")).cast("long").alias("n_hit"))
        items = found.select("row", "wid").distinct().join(windows.links, "wid").select("row", F.col("item_id").cast("string").alias("item")).distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
        base = base.join(hits, "row", "left").join(items, "row", "left")
    else:
        base = base.select("*", F.lit(None).cast("long").alias("n_hit"), F.lit(None).cast("array<string>").alias("items"))
    listed, n_hit = F.coalesce("items", F.array().cast("array<string>")), F.coalesce("n_hit", F.lit(0).cast("long"))
    return base.select("doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS m, unnest(range(1, greatest(len(w) - 8, 2))) AS i, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM bw),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM win))),
hit AS (SELECT DISTINCT doc_id, i, m FROM dw SEMI JOIN win USING (m, s)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM dw JOIN win USING (m, s) WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""
