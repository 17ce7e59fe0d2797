"""Removal of repeated passages with a logarithmic family of suffix arrays.

A byte goes if it lies in a string of ``SPAN`` bytes that starts earlier in the
corpus, too. The work is dealt to Spark by content, so that equal strings meet:

* Every string of SPAN bytes is led by an anchor, the run of GRAM bytes in it that
  hashes lowest (the leftmost of equals). Equal strings have equal anchors. The strings
  that one anchor leads are a stretch of text. A pass over the texts sends, for every
  stretch, the hashes of its anchor and of the whole stretch and where it starts; of
  equal stretches in one batch of texts only the first.
* Shuffled and sorted by anchor, equal stretches are neighbours. All but the first are
  repeats, and need no look at their bytes. Where an anchor leads several different
  stretches, the first of each is asked for its bytes. No filter stands before this, so
  nothing fills up as the corpus grows, and what is asked for is what differs.
* The asked-for stretches are cut from their texts and meet again under their anchor.
  A batch of them gets a suffix array: the starts of its strings, sorted by their bytes
  to the depth of SPAN. Neighbours with SPAN bytes in common are a match; in a run of
  them all but the earliest in the corpus are repeats. An anchor that leads more than
  HOT different stretches is not compared as such: its strings go one by one under
  their own hashes, so no group that a task holds is larger than that.
* Repeats come back as runs of starts per document, and are cut out of its text.

``Levels`` keeps what has been seen for batches to come, as stored tables: the
stretches' hashes and starts in the order of the anchors, and the texts. A new batch is
scanned against the stretches of all levels in the one sort above, which merges them,
and then becomes a level of its own; levels of like size are merged, so n texts lie in
about log n levels and each is rewritten about log n times.

Hashes have 64 bits and are polynomials over random byte values, finalised. Stretches
of equal anchor and equal hash count as equal; two that differ do so with a chance of
about 2^-64.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from gridmill.llm import bitmaps
from gridmill.llm.common import documents, mixed, raw_texts, shared_dir, stored

SPAN = 100
GRAM = 24
#: Bytes of text worked on at once; a longer text is taken in overlapping tiles.
TILE = 1 << 18
HOT = 200
#: Strings that are put into suffix order at once.
SORTED = 100_000

_random = np.random.default_rng(20_240_101)
VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_random.integers(1, 1 << 62)) * 8 + 5


class Powers:
    """Powers of the base and of its inverse, modulo 2^64, for a tile."""

    def __init__(self, n: int):
        with np.errstate(over="ignore"):
            self.up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, BASE % (1 << 64), np.uint64))))
            self.down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, pow(BASE, -1, 1 << 64), np.uint64))))


_powers: list[Powers] = []


def powers(n: int) -> Powers:
    if not _powers or len(_powers[0].up) <= n:
        _powers[:] = [Powers(max(n, 2 * TILE + SPAN))]
    return _powers[0]


def prefix_sums(x: np.ndarray) -> np.ndarray:
    """Sums of byte values times powers, from which the hash of any stretch follows."""
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(VALUES[x] * powers(len(x)).up[: len(x)], out=total[1:])
    return total


def stretch_hash(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((total[end] - total[start]) * powers(len(total)).down[start])


class Led:
    """The stretches of some joined texts: anchor hash ``key``, ``start`` of the first and ``count`` of the strings that the anchor leads."""

    def __init__(self, x: np.ndarray, ends: np.ndarray):
        """``ends``: where each text ends in ``x``; strings across an end are none."""
        n = len(x) - SPAN + 1
        self.x, self.total = x, prefix_sums(x)
        self.begins = np.concatenate(([0], ends[:-1]))
        grams = np.arange(len(x) - GRAM + 1)
        h = stretch_hash(self.total, grams, grams + GRAM)
        low = np.uint64((1 << 22) - 1)
        value = (h & ~low) | grams.astype(np.uint64)
        width, least = 1, value
        many = SPAN - GRAM + 1
        while width * 2 <= many:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < many:
            least = np.minimum(least[:n], least[many - width : many - width + n])
        at = (least[:n] & low).astype(np.int64)
        starts = np.arange(n)
        text = np.searchsorted(ends, starts, side="right")
        good = starts + SPAN <= ends[np.minimum(text, len(ends) - 1)]
        good &= text < len(ends)
        new = good.copy()
        new[1:] &= (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | ~good[:-1]
        last = good.copy()
        last[:-1] &= new[1:] | ~good[1:]
        self.start = np.flatnonzero(new)
        self.count = np.flatnonzero(last) - self.start + 1
        # An anchor's hash is the least of many, so its high bits say little; mixed once more they are even again.
        self.key = mixed(h[at[self.start]] ^ np.uint64(0x9E3779B97F4A7C15))
        self.text = text[self.start]

    def stretches(self) -> np.ndarray:
        """A hash of each whole stretch and of where the anchor's strings start in it."""
        return stretch_hash(self.total, self.start, self.start + self.count + SPAN - 1) ^ self.key


def tiles(ids: list, raws: list[bytes]) -> Iterator[tuple[list, list[int], Led]]:
    """Document ids, first positions and stretches, about TILE bytes at a time. A long text comes in tiles that share SPAN - 1 bytes."""
    at_ids, firsts, parts, size = [], [], [], 0

    def done():
        return at_ids, firsts, Led(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts]))

    for doc_id, raw in zip(ids, raws):
        for first in range(0, max(1, len(raw) - SPAN + 1), TILE):
            part = raw[first : first + TILE + SPAN - 1]
            if len(part) < SPAN:
                continue
            at_ids.append(doc_id), firsts.append(first), parts.append(part)
            size += len(part)
            if size >= TILE:
                yield done()
                at_ids, firsts, parts, size = [], [], [], 0
    if parts:
        yield done()


#: What a row tells: a stretch (whose bytes are to be compared), strings known to be repeats, strings to be compared one by one.
STRETCH, REPEAT, SINGLE = 0, 1, 2
PLACE = "age int, row long, tag int, start int, count int, kind int"
#: ``k`` deals the rows, ``s`` is the hash of a whole stretch; ``age`` is 0 for what lies in a level.
SEEN = f"k long, s long, {PLACE}"
ASKED = f"k long, {PLACE}"
SENT = f"k long, {PLACE}, body binary"


def _batch(schema: str, **columns) -> pa.RecordBatch:
    """A batch of the named numpy columns; numbers stand for columns of one value."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split(" ") for f in schema.split(", ")]
    n = max(len(c) for c in columns.values() if not isinstance(c, int))
    made = []
    for name, kind in fields:
        c = columns.get(name)
        if c is None:
            made.append(pa.nulls(n, kinds[kind]))
        elif isinstance(c, int):
            made.append(pa.array(np.full(n, c), kinds[kind]))
        else:
            made.append(pa.array(c.view(np.int64) if isinstance(c, np.ndarray) and c.dtype == np.uint64 else c, kinds[kind]))
    return pa.RecordBatch.from_arrays(made, [name for name, _ in fields])


def _repeats(schema: str, age: int, runs: np.ndarray) -> pa.RecordBatch:
    """Known repeats (row, tag, start, count), dealt evenly: they only pass through the next shuffle."""
    row, tag, start, count = _adjoined(runs)
    return _batch(schema, k=mixed(row.astype(np.uint64) ^ start.astype(np.uint64)), s=0, age=age, row=row, tag=tag, start=start, count=count, kind=REPEAT)


def _adjoined(runs: np.ndarray) -> np.ndarray:
    """Runs (row, tag, start, count) in order, those that follow on each other as one."""
    runs = runs[:, np.lexsort((runs[2], runs[1], runs[0]))]
    row, tag, start, count = runs
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] != start[:-1] + count[:-1])
    at = np.flatnonzero(new)
    return np.stack([row[at], tag[at], start[at], np.add.reduceat(count, at) if len(at) else count])


class Met:
    """Which hashes have been met before: sorted arrays of them, a new one merged with the one before it while that is not larger than twice itself."""

    def __init__(self):
        self.parts: list[np.ndarray] = []

    def again(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each of the hashes, in corpus order, was met before it; they count as met from now on."""
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        first = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.empty(0, bool)
        distinct = ranked[first]
        known = np.zeros(len(distinct), bool)
        for part in self.parts:
            at = np.searchsorted(part, distinct)
            at[at == len(part)] = 0
            known |= part[at] == distinct
        if not known.all():
            self.parts.append(distinct[~known])
        while len(self.parts) > 1 and len(self.parts[-2]) <= 2 * len(self.parts[-1]):
            b, a = self.parts.pop(), self.parts.pop()
            both = np.concatenate((a, b))
            both.sort(kind="stable")
            self.parts.append(both)
        repeated = np.empty(len(hashes), bool)
        repeated[order] = ~first | known[np.cumsum(first) - 1]
        return repeated


def seen_stretches(texts: DataFrame) -> DataFrame:
    """SEEN rows of (row, tag, text): the stretches of every text, and what is a repeat within its batch of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            raws, alike = list(raw_texts(batch.column(2))), {}
            for i in np.lexsort((tags, ids)).tolist():
                alike.setdefault((ids[i], tags[i], raws[i]), i)
            order, met = list(alike.values()), Met()
            for own, firsts, led in tiles(order, [raws[i] for i in order]):
                own, firsts = np.array(own, np.int64)[led.text], np.array(firsts, np.int64)[led.text]
                row, tag, start, s = ids[own], tags[own], firsts + led.start - led.begins[led.text], led.stretches()
                again = met.again(s)
                if again.any():
                    yield _repeats(SEEN, 1, np.stack([row, tag, start, led.count])[:, again])
                if not again.all():
                    new = ~again
                    yield _batch(SEEN, k=led.key[new], s=s[new], age=1, row=row[new], tag=tag[new], start=start[new], count=led.count[new], kind=STRETCH)

    return texts.select("row", "tag", "text").mapInArrow(run, SEEN)


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {name: batch.column(i).to_numpy() for i, name in enumerate(batch.schema.names) if name != "body"}


def _taken(rows: dict[str, np.ndarray], which: np.ndarray) -> dict[str, np.ndarray]:
    return {name: c[which] for name, c in rows.items()}


def _changes(rows: dict[str, np.ndarray], before: tuple | None, *names: str) -> np.ndarray:
    """Where any of the named columns differs from the row before; ``before`` has the values that came before the first."""
    new = np.zeros(len(rows[names[0]]), bool)
    for i, name in enumerate(names):
        c = rows[name]
        new[1:] |= c[1:] != c[:-1]
        new[:1] |= before is None or before[i] != c[0]
    return new


def asked(seen: DataFrame) -> DataFrame:
    """ASKED rows: what is a repeat by the hashes of stretches, and what has to be compared by bytes. All rows of an anchor are in one partition, sorted."""
    place = ("age", "row", "tag", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, pending, hot = None, None, None
        for batch in _with_end(batches):
            if batch is not None:
                rows = _columns(batch)
                done = rows["kind"] == REPEAT
                if done.any():
                    yield _batch(ASKED, **{n: c for n, c in _taken(rows, done).items() if n != "s"})
                rows = _taken(rows, ~done)
                if not len(rows["k"]):
                    continue
                keys = ("k", "s", *place)
                new = _changes(rows, before, *keys)
                first = _changes(rows, before and before[:2], "k", "s")
                before = tuple(rows[n][-1] for n in keys)
                again = new & ~first & (rows["age"] == 1)
                if again.any():
                    yield _batch(ASKED, **{n: c[again] for n, c in rows.items() if n not in ("s", "kind")}, kind=REPEAT)
                rows = _taken(rows, first)
                if pending is not None:
                    rows = {n: np.concatenate((pending[n], c)) for n, c in rows.items()}
            elif pending is None:
                return
            else:
                rows = pending
            # Groups that are whole: all but that of the last anchor, which may go on.
            if not len(rows["k"]):
                pending = None
                continue
            begins = np.flatnonzero(_changes(rows, None, "k"))
            sizes = np.diff(np.append(begins, len(rows["k"])))
            young = np.add.reduceat((rows["age"] == 1).astype(np.int64), begins)
            many = (sizes > HOT) | (rows["k"][begins] == hot if hot is not None else False)
            whole = np.ones(len(begins), bool)
            whole[-1] = batch is None or bool(many[-1])
            kind = np.where(many, SINGLE, STRETCH)
            wanted = np.repeat(whole & (many | ((sizes > 1) & (young > 0))), sizes)
            if wanted.any():
                yield _batch(ASKED, **{n: c[wanted] for n, c in rows.items() if n not in ("s", "kind")}, kind=np.repeat(kind, sizes)[wanted])
            hot = rows["k"][-1] if many[-1] else None
            pending = None if whole[-1] else _taken(rows, np.arange(begins[-1], len(rows["k"])))

    return seen.repartition("k").sortWithinPartitions("k", "s", *place).mapInArrow(run, ASKED)


def _with_end(batches):
    yield from batches
    yield None


def bodies(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """SENT rows: the asked-for stretches with their bytes, and single strings under their own hashes (of equal ones in a batch the first)."""
    lists = wanted.groupBy("age", "row", "tag").agg(F.collect_list(F.struct("k", "start", "count", "kind")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            age, row, tag = (batch.column(i).to_numpy() for i in range(3))
            raws, met, done = list(raw_texts(batch.column(3))), Met(), set()
            for i in np.lexsort((tag, row, age)).tolist():
                if (one := (age[i], row[i], tag[i], raws[i])) in done:
                    continue
                done.add(one)
                want = batch.column(4)[i].values
                k, start, count, kind = (want.field(j).to_numpy() for j in range(4))
                raw, own = raws[i], {"age": int(age[i]), "row": int(row[i]), "tag": int(tag[i])}
                whole = kind == STRETCH
                if whole.any():
                    cut = [raw[a : a + n + SPAN - 1] for a, n in zip(start[whole].tolist(), count[whole].tolist())]
                    yield _batch(SENT, k=k[whole], **own, start=start[whole], count=count[whole], kind=STRETCH, body=cut)
                if not whole.all():
                    places = np.unique(np.concatenate([np.arange(a, a + n) for a, n in zip(start[~whole].tolist(), count[~whole].tolist())]))
                    strings = np.empty(len(places), np.uint64)
                    for at in range(0, len(places), TILE):
                        part = places[at : at + TILE]
                        low = int(part[0])
                        for lo in np.unique((part - low) // TILE).tolist():
                            inside = (part - low) // TILE == lo
                            base = low + lo * TILE
                            total = prefix_sums(np.frombuffer(raw, np.uint8)[base : base + TILE + SPAN - 1])
                            strings[at : at + len(part)][inside] = stretch_hash(total, part[inside] - base, part[inside] - base + SPAN)
                    again = met.again(strings)
                    if again.any() and own["age"] == 1:
                        n = int(again.sum())
                        yield _repeats(SENT, 1, np.stack([np.full(n, own["row"]), np.full(n, own["tag"]), places[again], np.ones(n, np.int64)]))
                    if not again.all():
                        yield _batch(SENT, k=strings[~again], **own, start=places[~again], count=1, kind=SINGLE)

    # Texts that nothing is asked of are not shuffled.
    tested = _marked(texts, wanted).filter("marked")
    return tested.join(lists, ["age", "row", "tag"]).select("age", "row", "tag", "text", "asked").mapInArrow(run, SENT)


def _marked(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """``texts`` with a column ``marked``: false where no row of ``rows`` (a stored table) is of that text."""
    mark, log2 = F.xxhash64("row", "tag"), bitmaps.size_for(min(rows.count(), texts.count()))
    return bitmaps.tested(texts, mark, bitmaps.bitmap(rows.select(mark.alias("h")), "h", log2), log2, "marked")


def suffix_repeats(parts: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Which strings of some stretches, in corpus order, equal an earlier one: the suffix array of the stretches' starts to the depth of SPAN, and a scan of its neighbours."""
    x = np.frombuffer(b"".join(parts), np.uint8)
    sizes = counts + SPAN - 1
    begins = np.cumsum(sizes) - sizes
    starts = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    strings = np.ndarray((len(x) - SPAN + 1,), f"S{SPAN}", x, strides=(1,))[starts]
    order = np.argsort(strings, kind="stable")
    ranked = strings[order]
    repeated = np.zeros(len(strings), bool)
    repeated[order[1:]] = ranked[1:] == ranked[:-1]
    return repeated


def repeated_runs(sent: DataFrame) -> DataFrame:
    """(row, tag, start, count): runs of starts of repeated strings, from SENT rows."""
    place = ("age", "row", "tag", "start")

    def compared(rows: dict[str, np.ndarray], parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        """Whole groups, about SORTED strings at a time."""
        begins = np.flatnonzero(_changes(rows, None, "k"))
        total = np.cumsum(rows["count"].astype(np.int64))
        cuts, base = [0], 0
        for b, e in zip(begins[1:].tolist(), total[begins[1:] - 1].tolist()):
            if e - base >= SORTED:
                cuts.append(b)
                base = e
        cuts.append(len(parts))
        for a, z in zip(cuts, cuts[1:]):
            counts = rows["count"][a:z].astype(np.int64)
            own = np.repeat(np.arange(a, z), counts)
            step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            bad = suffix_repeats(parts[a:z], counts) & (rows["age"][own] == 1)
            opens, closes = bad.copy(), bad.copy()
            opens[1:] &= ~bad[:-1] | (own[1:] != own[:-1])
            closes[:-1] &= ~bad[1:] | (own[1:] != own[:-1])
            i, j = np.flatnonzero(opens), np.flatnonzero(closes)
            if len(i):
                yield _batch(RUNS, row=rows["row"][own[i]], tag=rows["tag"][own[i]], start=rows["start"][own[i]] + step[i], count=j - i + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, pending, parts = None, None, []
        for batch in batches:
            rows = _columns(batch)
            done = rows["kind"] == REPEAT
            if done.any():
                yield _batch(RUNS, **{n: rows[n][done] for n in ("row", "tag", "start", "count")})
            at = np.flatnonzero(~done)
            if not len(at):
                continue
            rows = _taken(rows, at)
            keys = ("k", *place)
            new = _changes(rows, before, *keys)
            first = _changes(rows, before and before[:1], "k")
            before = tuple(rows[n][-1] for n in keys)
            again = new & ~first & (rows["kind"] == SINGLE) & (rows["age"] == 1)
            if again.any():
                yield _batch(RUNS, **{n: rows[n][again] for n in ("row", "tag", "start", "count")})
            kept = new & (rows["kind"] == STRETCH)
            rows, found = _taken(rows, kept), batch.column(7).take(pa.array(at[kept])).to_pylist()
            if pending is not None:
                rows, found = {n: np.concatenate((pending[n], c)) for n, c in rows.items()}, parts + found
            pending, parts = rows, found
            if len(parts):
                end = int(np.flatnonzero(_changes(rows, None, "k"))[-1])
                if end:
                    yield from compared({n: c[:end] for n, c in rows.items()}, parts[:end])
                    pending, parts = {n: c[end:] for n, c in rows.items()}, parts[end:]
        if parts:
            yield from compared(pending, parts)

    return sent.repartition("k").sortWithinPartitions("k", *place).mapInArrow(run, RUNS)


RUNS = "row long, tag int, start int, count int"


class Levels:
    """The stored family: levels of stretches seen and their texts, the largest first. A new folder is an empty family."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or f"{shared_dir(spark)}-levels"

    def listed(self) -> list[tuple[str, int]]:
        """Name and size of each level, by the newest list."""
        try:
            lists = self.spark.read.schema("version long, names array<string>, sizes array<long>").json(f"{self.path}/lists")
            row = lists.agg(F.max(F.struct("version", "names", "sizes")).alias("r")).first().r
        except AnalysisException:
            return []
        return list(zip(row.names, row.sizes)) if row else []

    def _table(self, kind: str, schema: str, names: list[str]) -> DataFrame:
        paths = [f"{self.path}/{kind}/{n}" for n in names]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def seen(self, names: list[str] | None = None) -> DataFrame:
        """SEEN rows of the levels, of age 0."""
        return self._table("seen", SEEN, [n for n, _ in self.listed()] if names is None else names)

    def texts(self, names: list[str] | None = None) -> DataFrame:
        return self._table("texts", "row long, tag int, text string", [n for n, _ in self.listed()] if names is None else names)

    def add(self, seen: DataFrame, texts: DataFrame) -> None:
        """A batch as a new level; while the level before is not larger than twice the last, the two become one."""
        levels = self.listed()
        name = self._write(seen, texts)
        levels.append((name, self.texts([name]).count()))
        while len(levels) > 1 and levels[-2][1] <= 2 * levels[-1][1]:
            (a, n), (b, m) = levels[-2:]
            levels[-2:] = [(self._write(self.seen([a, b]), self.texts([a, b])), n + m)]
        version = self.spark.read.schema("version long").json(f"{self.path}/lists").count() if self.listed() else 0
        self.spark.createDataFrame([(version, [n for n, _ in levels], [m for _, m in levels])], "version long, names array<string>, sizes array<long>").write.mode("append").json(f"{self.path}/lists")

    def _write(self, seen: DataFrame, texts: DataFrame) -> str:
        name = uuid.uuid4().hex
        places = seen.filter(F.col("kind") == STRETCH).withColumn("age", F.lit(0))
        places.repartition("k").sortWithinPartitions("k", "s", "row", "tag", "start").write.option("compression", "zstd").parquet(f"{self.path}/seen/{name}")
        texts.select("row", "tag", "text").write.option("compression", "zstd").parquet(f"{self.path}/texts/{name}")
        return name


def spans_of(starts: list[int], counts: list[int]) -> list[tuple[int, int]]:
    """The maximal runs of bytes that strings at the given runs of starts cover."""
    spans: list[tuple[int, int]] = []
    for a, n in sorted(zip(starts, counts)):
        b = a + n - 1 + SPAN
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    return spans


def without_repeats(docs: DataFrame, with_text: bool = False, levels: Levels | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs``, and the removed ``spans`` and ``kept`` bytes if asked for.

    Texts are taken in the order of doc_id, null ids first. Rows with one doc_id and
    different texts are ordered and told apart by a 32-bit hash of the text; rows alike
    in both count as one text, and each gets its result.
    Null texts are empty; texts of less than SPAN bytes lose nothing and take nothing
    from others. An empty table gives none. Other columns are not looked at.

    With ``levels``, all texts of earlier batches come before those of this one, and
    this one is added; so batches in the order of doc_id give what one batch of them all
    would.
    """
    ids = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("row"), F.hash("text").alias("tag"), "text")
    seen, texts = seen_stretches(ids), ids.select(F.lit(1).alias("age"), "row", "tag", "text")
    both, every = seen, texts
    if levels is not None:
        seen = stored(seen)
        both, every = seen.unionByName(levels.seen()), texts.unionByName(levels.texts().select(F.lit(0).alias("age"), "row", "tag", "text"))
    found = stored(asked(both))
    known = found.filter(F.col("kind") == REPEAT).select("row", "tag", "start", "count")
    runs = stored(known.unionByName(repeated_runs(bodies(every, found.filter(F.col("kind") != REPEAT)))))
    if levels is not None:
        levels.add(seen, ids.select("row", "tag", "text").dropDuplicates(["row", "tag"]))
    by_row = runs.groupBy("row", "tag").agg(F.collect_list(F.struct("start", "count")).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw, found in zip(raw_texts(batch.column(1)), batch.column(2).to_pylist()):
                spans = spans_of([r["start"] for r in found or []], [r["count"] for r in found or []])
                edges = [0, *(e for s in spans for e in s), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), *(([list(s) for s in spans], kept) if with_text else ())))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary())
            columns = list(zip(*rows)) or [()] * (6 if with_text else 4)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"][: 1 + len(columns)])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", spans array<array<long>>, kept binary" if with_text else "")
    # Only texts that may lose something are shuffled.
    tested = _marked(ids, runs)
    untouched = tested.filter(~F.col("marked")).select("doc_id", "text", F.lit(None).cast("array<struct<start: int, count: int>>").alias("runs"))
    touched = tested.filter("marked").join(by_row, ["row", "tag"], "left").select("doc_id", "text", "runs")
    return untouched.mapInArrow(cut, schema).unionByName(touched.mapInArrow(cut, schema))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir, "doc_id", "text"))
