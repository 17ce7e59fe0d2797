"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents become runs of token ids; a run too long for a sequence is cut so that only
its first piece may be short. The pieces are dealt by hash into blocks of bounded
size. Every block is evolved on several islands that start from different seeds. The
genes of the algorithm are whole bins: crossover injects well-filled bins of one
parent into the other, drops the bins that hold the same pieces, and best-fits the
displaced pieces again, after those that fill an open bin better in place of one or two
of its pieces have changed places with them. Fewer bins are fitter; of as many, those are
whose room is left in as few bins as can be. An island ends when a stated number of
generations has not saved a bin. After each epoch the best packing of every island migrates
to the next island of its block, and at the end the best of all islands is taken.

A block's last bins may be half empty. The bins that are not all but full are therefore
taken up again, those of all blocks together, as the pieces of a further round with
fewer blocks, until one block is left.

An epoch is one Spark job over (block, island) groups; the packings between epochs
are rows of a stored table.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.llm.common import documents, stored

ROOM = 2048
BLOCK = 8192
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
#: Generations of a packing that cannot have fewer bins, and those without fewer bins after which the others end.
GENERATIONS = 5
PATIENCE = 12
MOST_GENERATIONS = 400
#: Of the displaced pieces so many are tried in pairs.
PAIRED = 48
#: A bin is well filled, and may be injected, from this share of the room on.
WELL = 0.98
#: A bin filled less than this is taken up again with those of other blocks.
CLOSED = 0.998

#: The word pattern of byte-level BPE vocabularies of this family (fixed), with possessive runs.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: Of the texts one in so many, chosen by its bytes, and the first of each Arrow batch are compared with the library's ids.
CHECKED = 64


class Tokens:
    """Token ids of texts under a byte-level BPE vocabulary file of the tokenizers library.

    Where the file's merges are in the order of their ids, as is usual, texts are
    encoded over the same table by tiktoken, which is some four times as fast; texts
    with special tokens, and all texts under other files, by the library itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        ids = model["vocab"]
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        ranks = [ids[m] for m in merges]
        self.fast = None
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not spec.get("normalizer")
        if plain and ranks == sorted(ranks) and not model.get("ignore_merges"):
            # The printable stand-ins of bytes: visible Latin-1 characters stand for themselves, the others from U+0100 on.
            seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
            byte = {chr(b): b for b in seen} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in seen)}
            table = {bytes(byte[c] for c in t): i for t, i in ids.items() if t not in self.special}
            self.fast = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encoded(self, text: str) -> bytes:
        """The ids, four bytes each."""
        if self.fast is None or any(s in text for s in self.special):
            return self.whole(text)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def pieces(docs: DataFrame, tokenizer_path: str, room: int = ROOM) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the pieces of every row: its ids and then id 0, cut into ``room`` ids with the short piece first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        library = tokens(tokenizer_path)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py() or ""
                ids = library.encoded(text)
                if (not rows or zlib.crc32(text.encode()) % CHECKED == 0) and ids != library.whole(text):
                    raise ValueError(f"the two encoders differ on a text of {len(text)} characters")
                ids += b"\0\0\0\0"
                n = len(ids) // 4
                cuts = [0, *range(n % room or room, n, room), n]
                rows += [(doc_id, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """A packing under construction: bins by what room they have left, the tightest fit found with a bit mask."""

    def __init__(self, sizes: list[int], room: int):
        self.sizes, self.room = sizes, room
        self.bins: list[list[int]] = []
        self.left: list[int] = []
        self.by_left: list[list[int]] = [[] for _ in range(room + 1)]
        self.mask = 0

    def _offer(self, b: int) -> None:
        left = self.left[b]
        if left:
            self.by_left[left].append(b)
            self.mask |= 1 << left

    def take(self, items: list[int], left: int) -> None:
        """A whole bin as it is."""
        self.bins.append(items)
        self.left.append(left)
        self._offer(len(self.bins) - 1)

    def replace(self, b: int, out, into: list[int], left: int) -> None:
        """Pieces of a bin by others."""
        at = self.by_left[self.left[b]]
        at.remove(b)
        if not at:
            self.mask &= ~(1 << self.left[b])
        self.bins[b] = [i for i in self.bins[b] if i not in out] + into
        self.left[b] = left
        self._offer(b)

    def best_fit(self, items) -> None:
        """Each item into the fullest bin that it fits, or else into a new one."""
        sizes = self.sizes
        for i in items:
            size = sizes[i]
            fits = self.mask >> size
            if fits:
                left = size + (fits & -fits).bit_length() - 1
                at = self.by_left[left]
                b = at.pop()
                if not at:
                    self.mask &= ~(1 << left)
                self.bins[b].append(i)
                self.left[b] = left - size
                self._offer(b)
            else:
                self.take([i], self.room - size)


def crossed(a: Bins, b: Bins, rng: np.random.Generator) -> Bins:
    """``a`` with some well-filled bins of ``b``: bins of ``a`` that share a piece with them go, their other pieces are best-fitted anew."""
    most = int(b.room * (1 - WELL))
    well = [k for k, left in enumerate(b.left) if left <= most]
    chosen = [k for k, yes in zip(well, rng.random(len(well)) < rng.uniform(0.2, 0.6)) if yes]
    taken = {i for k in chosen for i in b.bins[k]}
    # The worst-filled bins of a are broken up, too, as a mutation, and some of those that are not full.
    order = sorted((k for k, left in enumerate(a.left) if left), key=lambda k: -a.left[k])
    least = max(2, len(a.bins) // 50)
    worst = {*order[:least], *(k for k, yes in zip(order, rng.random(len(order)) < rng.uniform(0, 0.4)) if yes)}
    child, displaced = Bins(a.sizes, a.room), []
    for k in chosen:
        child.take(list(b.bins[k]), b.left[k])
    for k, items in enumerate(a.bins):
        if k in worst or not taken.isdisjoint(items):
            displaced += [i for i in items if i not in taken]
        else:
            child.take(list(items), a.left[k])
    child.best_fit(sorted(exchanged(child, displaced, rng), key=lambda i: -a.sizes[i]))
    return child


def exchanged(p: Bins, displaced: list[int], rng: np.random.Generator) -> list[int]:
    """Puts displaced pieces for pieces of open bins where that leaves less room; gives the pieces displaced then.

    In each bin one or two pieces go out and one comes in, or two go out and two of a
    bounded draw of the displaced come in, whichever fits best. A bin is looked at once.
    """
    sizes = p.sizes
    loose = sorted((sizes[i], i) for i in displaced)
    drawn = [loose[k] for k in sorted(rng.choice(len(loose), min(PAIRED, len(loose)), replace=False))] if loose else []
    pairs = sorted((x[0] + y[0], x, y) for k, x in enumerate(drawn) for y in drawn[:k])
    gone: set[int] = set()
    for b, items in enumerate(p.bins):
        if not loose or not p.left[b]:
            continue
        outs = [(i,) for i in items] + [(i, j) for k, i in enumerate(items) for j in items[:k]]
        best = (p.left[b], None, None)
        for out in outs:
            freed = sum(sizes[i] for i in out)
            most = freed + p.left[b]
            at = bisect_right(loose, (most, len(sizes))) - 1
            if at >= 0 and most - loose[at][0] < best[0]:
                best = (most - loose[at][0], out, (loose[at],))
            at = bisect_right(pairs, most, key=lambda pair: pair[0]) - 1 if len(out) == 2 else -1
            while at >= 0 and most - pairs[at][0] < best[0] and not gone.isdisjoint((pairs[at][1][1], pairs[at][2][1])):
                at -= 1
            if at >= 0 and most - pairs[at][0] < best[0]:
                best = (most - pairs[at][0], out, pairs[at][1:])
        left, out, into = best
        if out is None:
            continue
        p.replace(b, out, [i for _, i in into], left)
        for piece in into:
            loose.remove(piece)
            gone.add(piece[1])
        for i in out:
            insort(loose, (sizes[i], i))
    return [i for _, i in loose]


def fitness(p: Bins) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (the mean square of the fill)."""
    fill = 1 - np.array(p.left, float) / p.room
    return -len(p.bins), float((fill**2).mean()) if len(fill) else 0.0


def genome(p: Bins) -> bytes:
    """The bin of every piece."""
    at = np.zeros(len(p.sizes), np.int32)
    for b, items in enumerate(p.bins):
        at[items] = b
    return at.tobytes()


def from_genome(sizes: list[int], room: int, blob: bytes) -> Bins:
    made = Bins(sizes, room)
    at = np.frombuffer(blob, np.int32)
    order = np.argsort(at, kind="stable")
    for items in np.split(order, np.flatnonzero(np.diff(at[order])) + 1) if len(at) else []:
        items = items.tolist()
        made.take(items, room - sum(sizes[i] for i in items))
    return made


def settled(p: Bins, total: int) -> bool:
    """Whether nothing can be gained: as few bins as there can be, and room in one of them only."""
    return len(p.bins) * p.room - total < p.room and sum(1 for left in p.left if left) <= 1


def evolved(sizes: list[int], room: int, seed: int, migrants: list[bytes], population: int = POPULATION, generations: int = MOST_GENERATIONS, patience: int = PATIENCE) -> tuple[Bins, int]:
    """The best packing after some generations, and how many crossovers were made.

    It ends after ``patience`` generations without fewer bins (``GENERATIONS`` where there cannot be fewer).

    The first members are the migrants, best fit in falling order, and best fit in
    orders near it. Sizes are taken in falling order, so a packing of the same sizes
    is found again whatever their order was.
    """
    rng = np.random.default_rng(seed)
    members = [from_genome(sizes, room, m) for m in migrants]
    weights = np.array(sizes, float)
    for k in range(max(1, population - len(members))):
        first = Bins(sizes, room)
        noise = 0.0 if k == 0 and not migrants else 0.1
        first.best_fit(np.argsort(-weights * (1 + noise * rng.standard_normal(len(sizes))), kind="stable").tolist())
        members.append(first)
    total, crossings = sum(sizes), 0
    members.sort(key=fitness, reverse=True)
    fewest = -(-total // room)
    best, since = len(members[0].bins), 0
    for _ in range(generations):
        if settled(members[0], total) or since >= (GENERATIONS if best == fewest else patience):
            break
        a, b = rng.choice(len(members), 2, replace=len(members) < 2)
        child = crossed(members[a], members[b], rng)
        crossings += 1
        if len(members) >= population:
            members.pop()
        members.append(child)
        members.sort(key=fitness, reverse=True)
        best, since = len(members[0].bins), since + 1 if len(members[0].bins) == best else 0
    return members[0], crossings


ITEM = "block int, doc_id long, piece int, start long, length long, ids_crc32 long"
GENOMES = "block int, island int, bins int, fill double, crossings int, genome binary"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _ordered(items: pa.Table) -> pa.Table:
    """The items in an order of their own, whatever order they came in."""
    return items.sort_by([(c, "ascending") for c in ("doc_id", "piece", "length", "ids_crc32", "start")])


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split(" ") for f in schema.split(", "))])


def _epoch(room: int, epoch: int):
    """Evolves the packing of one block on one island, with the packings that it starts from."""

    def run(key, items: pa.Table, came: pa.Table) -> pa.Table:
        block, island = (k.as_py() for k in key)
        if not items.num_rows:
            return _arrow(GENOMES).empty_table()
        seed = (block * 1_000_003 + island * 1_009 + epoch) % (1 << 31)
        found, crossings = evolved(_ordered(items).column("length").to_pylist(), room, seed, came.column("genome").to_pylist())
        bins, fill = fitness(found)
        return pa.Table.from_pylist([{"block": block, "island": island, "bins": -bins, "fill": fill, "crossings": crossings, "genome": genome(found)}], _arrow(GENOMES))

    return run


def evolution(dealt: DataFrame, room: int, islands: int, epochs: int) -> DataFrame:
    """Every block's packings (see GENOMES) after all epochs, stored; ``crossings`` counts over the epochs of an island."""
    on_islands = dealt.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    best = dealt.sparkSession.createDataFrame([], GENOMES)
    for epoch in range(epochs):
        # An island goes on from its own best packing and that of the island before it.
        moved = best.unionByName(best.withColumn("island", ((F.col("island") + 1) % islands).cast("int"))).dropDuplicates(["block", "island", "genome"])
        made = on_islands.groupBy("block", "island").cogroup(moved.groupBy("block", "island")).applyInArrow(_epoch(room, epoch), GENOMES)
        before = best.groupBy("block", "island").agg(F.sum("crossings").alias("crossed"))
        best = stored(made.join(before, ["block", "island"], "left").select("block", "island", "bins", "fill", (F.col("crossings") + F.coalesce("crossed", F.lit(0))).cast("int").alias("crossings"), "genome"))
    return best


def _placed(room: int, round_: int, last: bool):
    """The items of a block in their bins. But for the last round, bins that are not closed have no sequence."""

    def run(key, items: pa.Table, winner: pa.Table) -> pa.Table:
        if not items.num_rows:
            return _arrow(PLACED).empty_table()
        items = _ordered(items)
        at, length = np.frombuffer(winner.column("genome")[0].as_py(), np.int32), items.column("length").to_numpy()
        order = np.argsort(at, kind="stable")
        ends = np.cumsum(length[order])
        begins = ends - length[order]
        first = np.concatenate(([True], np.diff(at[order]) > 0))
        offset = np.empty(len(at), np.int64)
        offset[order] = begins - np.maximum.accumulate(np.where(first, begins, 0))
        sequence = (np.int64(round_) << 58) + (np.int64(key[0].as_py()) << 26) + at
        open_ = np.zeros(len(at), bool) if last else np.bincount(at, length)[at] < CLOSED * room
        made = [items.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        return pa.Table.from_arrays([*made, pa.array(sequence, pa.int64(), mask=open_), pa.array(offset)], schema=_arrow(PLACED))

    return run


def packed(parts: DataFrame, room: int = ROOM, block: int = BLOCK, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """The rows of ``parts`` (see ``pieces``) with sequence_id and offset. No piece is lost; none may be longer than ``room``."""
    left, done, round_, before = stored(parts), None, 0, None
    while True:
        n = left.count()
        blocks = max(1, -(-n // block))
        dealt = left.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "length", "ids_crc32", F.lit(round_)), F.lit(blocks)).cast("int")).select(*[f.split(" ")[0] for f in ITEM.split(", ")])
        chosen = evolution(dealt, room, islands, epochs).groupBy("block").agg(F.min_by("genome", F.struct("bins", -F.col("fill"), "island")).alias("genome"))
        # A round in one block is the last, and so is one whose pieces fell by less than a tenth: those bins stay open for want of fitting pieces.
        last = blocks == 1 or (before is not None and 10 * n > 9 * before)
        placed = dealt.groupBy("block").cogroup(chosen.groupBy("block")).applyInArrow(_placed(room, round_, last), PLACED)
        if last:
            return placed if done is None else done.unionByName(placed)
        placed = stored(placed)
        full = placed.filter("sequence_id is not null")
        done = full if done is None else done.unionByName(full)
        left = placed.filter("sequence_id is null").select("doc_id", "piece", "start", "length", "ids_crc32")
        round_, before = round_ + 1, n


def packed_documents(docs: DataFrame, tokenizer_path: str, room: int = ROOM) -> DataFrame:
    """The pieces of all rows of ``docs``, packed.

    Null and empty texts are one piece of one id; a null doc_id stays null; repeated
    rows are packed each; an empty table gives none; other columns are not looked at.
    """
    return packed(pieces(docs, tokenizer_path, room), room)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(documents(spark, sf_dir, "doc_id", "text"), default_tokenizer())
