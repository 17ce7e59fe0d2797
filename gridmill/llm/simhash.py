"""SimHash near-duplicates found through a pigeonring filter.

A fingerprint is cut into a ring of four 16-bit segments. If two fingerprints differ
in at most three bits, then by the pigeonring principle some segment starts a chain
whose running differences stay within the proportional budgets 3/4, 6/4, 9/4 and 3:
the first segment is equal, the next adds at most one bit, the third brings the sum
to two at most. The index therefore keys each distinct fingerprint by a segment and
one half of the following segment (one of the halves must be equal, too): eight keys
of 24 bits. Pairs that meet under a key are held against the chain budgets before the
full Hamming check. Keys with very many members are split further by parts of the
third and fourth segment. What is still large is dealt to parts of bounded size, each of
which meets the same few hubs of its bucket, so that a group of near copies becomes one
component in work that grows with its size; then only members outside the bucket's
largest component meet all others, block by block. No task holds more than a bounded
number of fingerprints, and no link is lost.

For a similarity of 0.8 on five-word shingles three bits are far too few: such texts
differ in about 15 % of all bits. ``similar_groups`` serves that case with prints of
256 bits, a ring of sixteen 16-bit segments, whose differing share gives the angle
between two texts to about two percent. With budgets of several bits no segment need be
equal, so segments can't be keys; texts meet under any of eight least shingle hashes,
which texts that similar share with near certainty. Pairs that meet go through the ring:
from some segment on, the running differences of a chain have to stay within the
proportional budgets, or the pair is dropped before the full Hamming check. What passes
becomes a link by the Jaccard similarity of the whole shingle sets.

Equal fingerprints are collapsed to one class before anything is compared, and a
bucket sends out a spanning forest of its links, never all its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.llm import bitmaps, bloom
from gridmill.llm.common import documents, fresh, mixed, quoted, raw_texts, stored
from gridmill.llm.components import components

SEED = 42
SHINGLE = 3
BITS = 3
MOST_IN_BUCKET = 1024
#: Members of a large bucket that each of its parts is held against.
HUBS = 32
#: Segments that a chain over wide prints is followed for.
CHAIN = 3


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of one text: words are lower-cased in A-Z, split at ASCII white space and joined in runs of ``shingle``."""
    words = raw.lower().split()
    if not words:
        return 0
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(run, SEED) for run in runs), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the fingerprint as a long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(raw, shingle) for raw in raw_texts(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(hashed, "doc_id long, fp long")


def _bits(first: int, count: int) -> F.Column:
    """Bits of the rotated fingerprint ``r``, from bit ``first`` on."""
    return F.shiftrightunsigned("r", first).bitwiseAND((1 << count) - 1)


def _keys(classes: DataFrame) -> DataFrame:
    """Eight rows for each class: the fingerprint rotated so that the starting segment is in its low bits, and the key."""
    starts = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), (F.shiftrightunsigned("fp", 16 * i).bitwiseOR(F.shiftleft("fp", 64 - 16 * i)) if i else F.col("fp")).alias("r")) for i in range(4)]))
    turned = classes.select("node", starts.alias("s")).select("node", "s.i", "s.r")
    halves = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), _bits(16 + 8 * j, 8).alias("half")) for j in range(2)]))
    keyed = turned.select("node", "r", "i", halves.alias("h"))
    return keyed.select("node", "r", (((F.col("i") * 2 + F.col("h.j")).cast("long") * (1 << 24)) + _bits(0, 16) * 256 + F.col("h.half")).alias("key"))


def _narrower(keyed: DataFrame) -> DataFrame:
    """The rows of large buckets under narrower keys: of the third segment one of three parts is equal (two bits at most differ so far), of the fourth one of four."""
    thirds = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), _bits(32 + 5 * a, 6 if a == 2 else 5).alias("x")) for a in range(3)]))
    fourths = F.explode(F.array(*[F.struct(F.lit(b).alias("b"), _bits(48 + 4 * b, 4).alias("y")) for b in range(4)]))
    parts = keyed.select("node", "r", "key", thirds.alias("t")).select("node", "r", "key", "t", fourths.alias("f"))
    return parts.select("node", "r", (F.col("key") * (1 << 14) + (F.col("t.a") * 4 + F.col("f.b")) * 1024 + F.col("t.x") * 16 + F.col("f.y")).alias("key"))


def _sized(keyed: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Rows of buckets with ``most`` members at most, and the rest with the bucket's size."""
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    sized = keyed.join(counts, "key")
    return sized.filter(F.col("n") <= most).drop("n"), sized.filter(F.col("n") > most)


def _linked(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Whether pairs of rotated fingerprints pass the chain budgets and then the full check."""
    x = a ^ b
    low = np.uint64(0xFFFF)
    one = np.bitwise_count((x >> np.uint64(16)) & low)
    two = one + np.bitwise_count((x >> np.uint64(32)) & low)
    ring = ((x & low) == 0) & (one * 4 <= 2 * bits) & (two * 4 <= 3 * bits)
    return ring & (np.bitwise_count(x) <= bits)


def _ring(bits: int):
    return lambda a, b: _linked(a, b, bits)


def _chained(x: np.ndarray, most: int) -> np.ndarray:
    """Whether differences (several words each, the last axis) have a chain: from some 16-bit segment on, the running sums over 1, 2, ... ``CHAIN`` segments stay within their shares of ``most``. No difference of ``most`` bits or less lacks one."""
    segments = np.bitwise_count(np.ascontiguousarray(x).view(np.uint16)).astype(np.int16)
    n = segments.shape[-1]
    running, good = np.zeros_like(segments), np.ones(segments.shape, bool)
    for k in range(CHAIN):
        running += np.roll(segments, -k, axis=-1)
        good &= running * n <= (k + 1) * most
    return good.any(axis=-1)


def _wide(most: int):
    """Prints of several words a row (the last axis) that have a chain and then differ in ``most`` bits at most."""

    def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a ^ b
        near = _chained(x, most)
        near[near] = np.bitwise_count(x[near]).sum(axis=-1, dtype=np.int32) <= most
        return near

    return linked


def _labels(r: np.ndarray, linked) -> np.ndarray:
    """The part of each member of one bucket: its first member that is reached by links."""
    n = len(r)
    near = np.zeros((n, n), bool)
    for i in range(0, n, 64):
        near[i : i + 64] = linked(r[i : i + 64, None], r[None, :])
    label = np.arange(n)
    while True:
        new = np.where(near, label[None, :], n).min(axis=1)
        new = np.minimum(new[new], new)
        if (new == label).all():
            return label
        label = new


def _forest(node: np.ndarray, r: np.ndarray, linked) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is linked in one bucket: each member to the least member of its part."""
    label = _labels(r, linked)
    rank = np.full(len(node), np.iinfo(np.int64).max)
    np.minimum.at(rank, label, node)
    other = rank[label] != node
    return node[other], rank[label][other]


def _buckets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Key, node and print of whole buckets, many at a time, with the buckets' starts and sizes."""
    rest = None
    for batch in _with_end(batches):
        if batch is not None:
            prints = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64).reshape(-1, words) if words else batch.column(2).to_numpy().view(np.uint64)
            now = (batch.column(0).to_numpy(), batch.column(1).to_numpy(), prints)
            now = now if rest is None else tuple(np.concatenate(p) for p in zip(rest, now))
            end = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
        elif rest is None:
            return
        else:
            now, end = rest, len(rest[0])
        rest = tuple(x[end:] for x in now)
        key, node, r = (x[:end] for x in now)
        if end:
            starts = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1))
            yield key, node, r, starts, np.diff(np.concatenate((starts, [end])))


def _pairs(key: np.ndarray, r: np.ndarray, sizes: np.ndarray, linked) -> tuple[np.ndarray, np.ndarray]:
    """Places of all linked pairs of buckets of at most eight members."""
    end, size, firsts, seconds = len(key), np.repeat(sizes, sizes), [], []
    for d in range(1, 8):
        i = np.flatnonzero((key[:-d] == key[d:]) & (size[:-d] <= 8)) if end > d else np.empty(0, int)
        i = i[linked(r[i], r[i + d])]
        firsts.append(i), seconds.append(i + d)
    return np.concatenate(firsts), np.concatenate(seconds)


def bucket_links(keyed: DataFrame, linked, words: int = 0) -> DataFrame:
    """(u, v) links within the buckets of (key, node, r); every bucket is of bounded size. ``r`` is a long, or binary of ``words`` words."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, node, r, starts, sizes in _buckets(batches, words):
            i, j = _pairs(key, r, sizes, linked)
            us, vs = [node[i]], [node[j]]
            for at, n in zip(starts[sizes > 8], sizes[sizes > 8]):
                u, v = _forest(node[at : at + n], r[at : at + n], linked)
                us.append(u), vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us), pa.int64()), pa.array(np.concatenate(vs), pa.int64())], ["u", "v"])

    return keyed.select("key", "node", "r").repartition("key").sortWithinPartitions("key").mapInArrow(links, "u long, v long")


def bucket_groups(keyed: DataFrame, linked, words: int = 0) -> DataFrame:
    """(g, node): the members of each bucket's parts of two or more. ``g`` follows from the members, so parts met in several buckets are the same."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, node, r, starts, sizes in _buckets(batches, words):
            own = mixed(node.view(np.uint64))
            i, j = _pairs(key, r, sizes, linked)
            g = mixed(own[i] + own[j])
            gs, nodes = [g, g], [node[i], node[j]]
            for at, n in zip(starts[sizes > 8], sizes[sizes > 8]):
                label, inside = _labels(r[at : at + n], linked), slice(at, at + n)
                total = np.zeros(n, np.uint64)
                np.add.at(total, label, own[inside])
                several = np.bincount(label, minlength=n)[label] > 1
                gs.append(mixed(total)[label][several]), nodes.append(node[inside][several])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(gs).view(np.int64)), pa.array(np.concatenate(nodes), pa.int64())], ["g", "node"])

    return keyed.select("key", "node", "r").repartition("key").sortWithinPartitions("key").mapInArrow(groups, "g long, node long").distinct()


def _with_end(batches):
    yield from batches
    yield None


def fingerprint_links(classes: DataFrame, bits: int = BITS, most: int = MOST_IN_BUCKET) -> DataFrame:
    """Links (u, v) between classes (node, fp) whose fingerprints differ in ``bits`` (three or fewer) bits at most.

    The links given join everything that is linked; they are not all the pairs.
    """
    if not 0 <= bits <= 3:
        raise ValueError("the ring of four segments serves distances from 0 to 3")
    linked = _ring(bits)
    small, large = _sized(_keys(classes), most)
    fitting, dense = _sized(_narrower(large), most)
    dense = stored(dense)
    links = bucket_links(small, linked)
    if dense.isEmpty():
        return links.unionByName(bucket_links(fitting, linked))
    found = components(links.unionByName(bucket_links(fitting, linked)).unionByName(bucket_links(_dealt(dense, most), linked)))
    return _edges(found).unionByName(bucket_links(_outside(dense, found, most), linked))


def _edges(found: DataFrame) -> DataFrame:
    return found.select(F.col("node").alias("u"), F.col("component").alias("v"))


def _blocks(count: F.Column, most: int) -> F.Column:
    """How many blocks of half of ``most`` members hold ``count`` of them."""
    return F.ceil(count * 2 / most).cast("int")


def _block(blocks: str, seed: int = 0) -> F.Column:
    return F.pmod(F.xxhash64("node", F.lit(seed)), F.col(blocks)).cast("int")


def _dealt(dense: DataFrame, most: int) -> DataFrame:
    """The rows of large buckets (key, node, r, n), dealt to blocks. Each block gets all hubs of its bucket, too, ``HUBS`` at most."""
    rows = dense.select("key", "node", "r", _blocks(F.col("n"), most).alias("a")).withColumn("own", _block("a"))
    hubs = rows.groupBy("key", "a", F.pmod(F.xxhash64("node", F.lit(2)), F.lit(HUBS)).alias("slot")).agg(F.min(F.struct("node", "r", "own")).alias("hub"))
    sent = hubs.select("key", "hub.*", F.explode(F.sequence(F.lit(0), F.col("a") - 1)).alias("at")).filter("at <> own")
    dealt = rows.select("key", "node", "r", F.col("own").alias("at")).unionByName(sent.select("key", "node", "r", "at"))
    return dealt.select(F.xxhash64("key", "at").alias("key"), "node", "r")


def _outside(dense: DataFrame, found: DataFrame, most: int) -> DataFrame:
    """Members of large buckets outside their bucket's largest component, dealt to blocks that meet all blocks of the bucket."""
    parts = dense.join(found, "node", "left").select("key", "node", "r", "n", F.coalesce("component", "node").alias("part"))
    counts = parts.groupBy("key", "part").agg(F.count("*").alias("c"))
    main = counts.groupBy("key").agg(F.max(F.struct("c", "part")).alias("m")).select("key", "m.c", F.col("m.part").alias("main"))
    rows = parts.join(main, "key").filter("n > c")
    rows = rows.select("key", "node", "r", (F.col("part") != F.col("main")).alias("out"), _blocks(F.col("n"), most).alias("a"), _blocks(F.col("n") - F.col("c"), most).alias("b"))
    rows = rows.withColumn("i", _block("a")).withColumn("j", _block("b", 1))
    out = rows.filter("out").select("key", "node", "r", F.explode(F.sequence(F.lit(0), F.col("a") - 1)).alias("i"), "j")
    # A member outside is in its own block of those outside already.
    every = rows.select("key", "node", "r", "out", "i", F.col("j").alias("own"), F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("j")).filter("not out or j <> own")
    both = out.unionByName(every.select("key", "node", "r", "i", "j"))
    return both.select(F.xxhash64("key", "i", "j").alias("key"), "node", "r")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable).

    Null and empty texts have fingerprint zero and are linked like any other. Rows
    that repeat a doc_id each get a row; rows with a null doc_id are no links of
    others and get the component of their fingerprint. An empty table gives an
    empty result. Other columns of ``docs`` are not looked at.
    """
    prints = stored(fingerprints(docs, shingle))
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("node")).filter("node is not null"))
    found = components(fingerprint_links(classes, bits))
    joined = classes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(joined, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id"))


WORDS = 4
MEETINGS = 8


def shingle_set(raw: bytes, shingle: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(run, SEED) for run in runs), np.uint64, max(1, len(words) - shingle + 1)))


def set_id(h: np.ndarray) -> int:
    """64 bits that stand for a whole shingle set."""
    return int.from_bytes(hashlib.blake2b(h.tobytes(), digest_size=8).digest(), "little", signed=True)


def wide_print(h: np.ndarray) -> tuple[bytes, list[int]]:
    """A SimHash of 256 bits of a shingle set and its least hash under each of eight orders."""
    n = len(h)
    if not n:
        return bytes(8 * WORDS), [0] * MEETINGS
    ones, least = np.zeros((WORDS, 64), np.int64), np.full(MEETINGS, (1 << 64) - 1, np.uint64)
    for at in range(0, n, 1 << 15):
        part = h[at : at + (1 << 15)]
        for k in range(MEETINGS):
            turned = mixed(part + np.uint64((k * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)))
            least[k] = min(least[k], turned.min())
            if k < WORDS:
                ones[k] += np.unpackbits(turned.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > n, bitorder="little").tobytes(), (mixed(least + np.arange(MEETINGS, dtype=np.uint64)) >> np.uint64(1)).tolist()


def exact_links(nodes: list[int], sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links that join all of ``nodes`` whose sets have the similarity or more: members not reached yet are held against each one reached."""
    sizes = np.array([len(h) for h in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    begins = np.cumsum(sizes) - sizes
    held, open_, found = np.zeros(int(ids.max()) + 1, bool), np.ones(len(nodes), bool), []
    while open_.any():
        reached = [int(np.flatnonzero(open_)[0])]
        open_[reached] = False
        while reached and open_.any():
            i = reached.pop()
            own = ids[begins[i] : begins[i] + sizes[i]]
            held[own] = True
            common = np.add.reduceat(held[ids], begins, dtype=np.int64)
            held[own] = False
            near = np.flatnonzero(open_ & (common / (sizes + sizes[i] - common) >= similarity)).tolist()
            open_[near] = False
            reached += near
            found += [(nodes[i], nodes[j]) for j in near]
    return found


def confirmed_links(groups: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(u, v) links within groups (g, node), by the sets (node, hs) of their members. A group is of bounded size."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, held = None, [], []
        for batch in _with_end(batches):
            found = []
            rows = [(None, None, None)] if batch is None else zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))
            for g, node, hs in rows:
                if g != group:
                    if len(nodes) > 1:
                        found += exact_links(nodes, held, similarity)
                    group, nodes, held = g, [], []
                if g is not None:
                    nodes.append(node), held.append(np.frombuffer(hs.as_py(), np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["u", "v"])

    return groups.join(sets, "node").select("g", "node", "hs").repartition("g").sortWithinPartitions("g").mapInArrow(links, "u long, v long")


def _sets_of(docs: DataFrame, marks: DataFrame, shingle: int) -> DataFrame:
    """(node, hs): the shingle sets of texts whose hash is in ``marks``. A Bloom filter of bounded size tells them, so a few others come along."""
    seen = bloom.repeats(marks.unionByName(marks), "mark", bloom.size_for(2 * marks.count()))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.filter(pa.array(seen.value.maybe(batch.column(0).to_numpy().view(np.uint64)), pa.bool_()))
            sets = [shingle_set(raw, shingle) for raw in raw_texts(wanted.column(1))]
            yield pa.RecordBatch.from_arrays([pa.array([set_id(h) for h in sets], pa.int64()), pa.array([h.tobytes() for h in sets], pa.binary())], ["node", "hs"])

    return docs.select(F.xxhash64("text").alias("mark"), "text").mapInArrow(made, "node long, hs binary").dropDuplicates(["node"])


def _confirmed(groups: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(u, v) links within ``groups`` by the whole shingle sets, made anew from the texts of ``docs``."""
    marks = stored(groups.select("node").distinct().join(classes, "node").select("mark"))
    return confirmed_links(groups, _sets_of(docs, marks, shingle), similarity)


def similar_groups(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, most: int = MOST_IN_BUCKET) -> DataFrame:
    """doc_id and component_id (the smallest doc_id reachable) of every row, linking texts whose shingle sets have ``similarity`` (Jaccard) or more.

    Candidates share a key and differ in as many bits of 256 as are expected at that
    similarity, and seven standard deviations more; a link is what the whole sets
    confirm. Buckets larger than ``most`` are compared by hubs first; then members outside
    a bucket's largest component meet all others.
    Null and empty texts are alike. Rows that repeat a doc_id each get a row, by their
    own text; an empty table gives none.
    """
    return _similar(docs, shingle, similarity, most).select("doc_id", "component_id")


def _by_size(keyed: DataFrame, similarity: float) -> DataFrame:
    """The rows of large buckets under the key and a class of set sizes. Sets that similar have sizes in one class or in two that follow on each other, so each row is in its own and the next."""
    # Classes are a touch wider than the similarity asks, so that rounding can't part two sizes at the limit.
    own = F.floor(F.log(F.greatest("size", F.lit(1))) / float(-np.log(similarity) * (1 + 1e-9))).cast("int")
    return keyed.select("node", "r", "key", F.explode(F.array(own, own + 1)).alias("class")).select("node", "r", F.xxhash64("key", "class").alias("key"))


def _similar(docs: DataFrame, shingle: int, similarity: float, most: int) -> DataFrame:
    """doc_id, mark (a hash of the text), node (its shingle set), component_id and keeper, the node that stays."""
    bits, angle = 64 * WORDS, np.arccos(2 * similarity / (1 + similarity)) / np.pi
    linked = _wide(int(bits * angle + 7 * np.sqrt(bits * angle * (1 - angle))))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, made, sizes = [], [], []
            for raw in raw_texts(batch.column(1)):
                h = shingle_set(raw, shingle)
                ids.append(set_id(h)), made.append(wide_print(h)), sizes.append(len(h))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2), pa.array(ids, pa.int64()), pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.list_(pa.int64())), pa.array(sizes, pa.int64())], ["doc_id", "mark", "node", "fp", "keys", "size"])

    prints = stored(docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(hashed, "doc_id long, mark long, node long, fp binary, keys array<long>, size long"))
    classes = stored(prints.filter("doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("mark").alias("mark"), F.first("fp").alias("r"), F.first("keys").alias("keys"), F.first("size").alias("size")))
    keyed = classes.select("node", "r", "size", F.explode(F.array_distinct("keys")).alias("key"))
    small, large = _sized(keyed, most)
    fitting, dense = _sized(_by_size(large, similarity), most)
    dense = stored(dense)
    bounded = small.select("key", "node", "r").unionByName(fitting.select("key", "node", "r"))
    found = components(_confirmed(stored(bucket_groups(bounded.unionByName(_dealt(dense, most)), linked, WORDS)), classes, docs, shingle, similarity))
    if not dense.isEmpty():
        parts = stored(bucket_groups(_outside(dense, found, most), linked, WORDS))
        several = parts.join(found, "node", "left").groupBy("g").agg(F.min(F.coalesce("component", "node")).alias("low"), F.max(F.coalesce("component", "node")).alias("high")).filter("low <> high")
        parts = stored(parts.join(several, "g", "left_semi"))
        found = components(_edges(found).unionByName(_confirmed(parts, classes, docs, shingle, similarity)))
    members = found.join(classes, "node").select("node", "component", "doc_id")
    least = members.groupBy("component").agg(F.min(F.struct("doc_id", "node")).alias("least"))
    joined = members.join(least, "component").select("node", F.col("least.doc_id").alias("least_id"), F.col("least.node").alias("least_node"))
    joined = classes.select("node", F.col("doc_id").alias("own_id")).join(joined, "node", "left").select("node", F.coalesce("least_id", "own_id").alias("component_id"), F.coalesce("least_node", "node").alias("keeper"))
    return prints.join(joined, "node", "left").select("doc_id", "mark", "node", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("keeper", "node").alias("keeper"))


def without_near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, most: int = MOST_IN_BUCKET) -> DataFrame:
    """``docs`` with one document of each group of similar texts, that with the smallest id; all columns kept, whatever their names.

    Of rows that repeat a doc_id only those with a similar text go; rows with a null
    doc_id are no links of others and stay; null and empty texts are alike; an empty
    table gives none. Only texts that may go are shuffled.
    """
    lost = stored(_similar(docs, shingle, similarity, most).filter("doc_id <> component_id or (doc_id is not null and node <> keeper)").select("doc_id", "mark"))
    log2 = bitmaps.size_for(lost.count())
    bits = bitmaps.bitmap(lost, "mark", log2)
    flag, mark, lost_id, lost_mark = fresh(docs.columns, "flag", "mark", "lost_id", "lost_mark")
    names = [F.col(quoted(c)) for c in docs.columns]
    rows = bitmaps.tested(docs.withColumn(mark, F.xxhash64("text")), F.col(mark), bits, log2, flag)
    going = lost.select(F.col("doc_id").alias(lost_id), F.col("mark").alias(lost_mark))
    stays = rows.filter(flag).join(going, (F.col("doc_id") == F.col(lost_id)) & (F.col(mark) == F.col(lost_mark)), "left_anti")
    return rows.filter(~F.col(flag)).select(*names).union(stays.select(*names))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir, "doc_id", "text"))
