import hashlib

import numpy as np
import xxhash
from llm_cases import ODD

from gridmill.llm import bloom, exact_dedup, simhash
from gridmill.llm.components import components


def exact_by_hand(pairs):
    lower = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    norm = {d: (t or "").encode().translate(lower) for d, t in pairs}
    groups = {}
    for d, t in norm.items():
        groups.setdefault(t, []).append(d)
    return {d: (max(groups[t]), len(groups[t]), d == max(groups[t]), hashlib.sha256(t).hexdigest()) for d, t in norm.items()}


def test_exact_groups_match_brute_force(spark, sf):
    pairs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in exact_dedup.op3_exact_dedup(spark, sf).collect()}
    assert got == exact_by_hand(pairs)


def test_exact_groups_of_odd_texts(odd_docs, no_docs):
    got = {r.doc_id: tuple(r)[1:] for r in exact_dedup.exact_groups(odd_docs).collect()}
    assert got == exact_by_hand(list(enumerate(ODD)))
    assert exact_dedup.exact_groups(no_docs).count() == 0
    assert exact_dedup.without_copies(odd_docs).count() == len({v[0] for v in got.values()})


def test_a_full_filter_loses_nothing(spark, docs_of):
    docs = docs_of([f"text {i % 700}" for i in range(1000)])
    filled = exact_dedup.exact_groups(docs, most_log2_bits=bloom.BLOCK_LOG2)
    assert filled.filter("kept").count() == 700


def test_filter_passes_every_repeat(spark):
    rng = np.random.default_rng(1)
    once, twice = rng.integers(-(2**62), 2**62, 5000), rng.integers(-(2**62), 2**62, 500)
    df = spark.createDataFrame([(int(x),) for x in [*once, *twice, *twice]], "h long")
    seen = bloom.repeats(df, "h", bloom.size_for(6000)).value
    assert seen.maybe(twice.view(np.uint64)).all()
    assert seen.maybe(once.view(np.uint64)).mean() < 0.05


def print_by_hand(text, k=3):
    lower = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    words = [w for w in (text or "").encode().translate(lower).translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" ") if w]
    if not words:
        return 0
    runs = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64(r, seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components_by_hand(prints):
    ids = sorted(prints)
    comp = {i: i for i in ids}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 3:
                x, y = root(a), root(b)
                comp[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_simhash_matches_brute_force(spark, sf):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    prints = {d: print_by_hand(t) for d, t in texts.items()}
    want = components_by_hand(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op10_simhash(spark, sf).collect()}
    assert got == {d: (f"{prints[d]:016x}", want[d]) for d in texts}


def test_simhash_of_odd_texts(odd_docs, no_docs):
    prints = {i: print_by_hand(t) for i, t in enumerate(ODD)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_groups(odd_docs).collect()}
    assert got == {d: (f"{prints[d]:016x}", c) for d, c in components_by_hand(prints).items()}
    assert simhash.near_groups(no_docs).count() == 0


def test_no_link_is_lost_in_dense_buckets(spark):
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    prints = {}
    for _ in range(900):
        x = int(centres[rng.integers(len(centres))])
        for b in rng.integers(0, 64, rng.integers(0, 5)):
            x ^= 1 << int(b)
        prints.setdefault(x, len(prints))
    by_id = {i: x for x, i in prints.items()}
    rows = [(i, int(np.uint64(x).view(np.int64))) for i, x in by_id.items()]
    df = spark.createDataFrame(rows, "node long, fp long")
    want = {i: c for i, c in components_by_hand(by_id).items()}
    for most in (16, 1024):
        links = simhash.fingerprint_links(df, most=most)
        got = {i: i for i in by_id} | {r.node: r.component for r in components(links).collect()}
        assert got == want


def test_one_group_of_near_copies_is_no_more_work_than_its_size(spark):
    """Hubs join a bucket of near copies, so that few rows are left to be compared with all; a chain that no hub reaches is joined, too."""
    rng = np.random.default_rng(11)
    prints = {int(rng.integers(2**63))}
    centre = next(iter(prints))
    while len(prints) < 1500:
        prints.add(centre ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    chain = centre
    for b in range(0, 12, 3):
        chain ^= 0b111 << b
        prints.add(chain)
    by_id = dict(enumerate(sorted(prints)))
    rows = [(1, i, int(np.uint64(x).view(np.int64)), len(by_id)) for i, x in by_id.items()]
    dense = spark.createDataFrame(rows, "key long, node long, r long, n long")
    anywhere = lambda a, b: np.bitwise_count(a ^ b) <= 3
    dealt = simhash._dealt(dense, 256)
    assert dealt.count() <= len(rows) * (1 + 2 * simhash.HUBS / 256) + simhash.HUBS
    assert dealt.groupBy("key").count().agg({"count": "max"}).first()[0] <= 256 + simhash.HUBS
    found = components(simhash.bucket_links(dealt, anywhere))
    outside = simhash._outside(dense, found, 256)
    assert outside.count() <= 3 * len(rows)
    more = simhash.bucket_links(outside, anywhere) if outside.count() else outside.selectExpr("node u", "node v")
    joined = components(simhash._edges(found).unionByName(more))
    assert {r.component for r in joined.collect()} == {0} and joined.count() == len(rows)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 201), (5, 5)], "u long, v long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(101)}, 200: 200, 201: 200}
    assert components(edges.limit(0)).count() == 0
