import hashlib

import numpy as np
from llm_cases import ODD

from gridmill.llm import substrings


def by_hand(texts):
    """The contract, with a set of all strings of 100 bytes met so far in (doc_id, start) order."""
    met, out = set(), {}
    for d in sorted(texts):
        raw = (texts[d] or "").encode()
        gone = bytearray(len(raw))
        for a in range(len(raw) - 99):
            s = raw[a : a + 100]
            if s in met:
                gone[a : a + 100] = b"\1" * 100
            else:
                met.add(s)
        flags = np.frombuffer(bytes(gone), np.uint8).astype(np.int8)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[d] = (len(raw), int(flags.sum()), int((np.diff(np.concatenate(([0], flags))) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def results(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}


def test_whole_table_matches_brute_force(spark, sf):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    want = by_hand(texts)
    assert results(substrings.op1_suffix_dedup(spark, sf)) == want
    assert sum(w[1] for w in want.values()) > 10_000


def planted():
    rng = np.random.default_rng(9)
    fresh = lambda n: rng.bytes(n).hex()[:n]
    shared, long = fresh(180), fresh(3000)
    texts = [fresh(500) + shared + fresh(400), shared[:99], shared[:100], fresh(50) + shared[40:170] + fresh(10), long, long, fresh(30) + long[:1500] + "é" + long[1501:], "ab" * 400, "xab" + "ab" * 70, "", fresh(99)]
    texts += [fresh(60) + shared + fresh(int(rng.integers(0, 90))) for _ in range(40)]
    return texts


def test_planted_passages(docs_of, monkeypatch):
    texts = planted()
    want = by_hand(dict(enumerate(texts)))
    docs = docs_of(texts).repartition(4)
    assert results(substrings.without_repeats(docs)) == want
    rows = {r.doc_id: r for r in substrings.without_repeats(docs, with_text=True).collect()}
    assert len(rows[3].spans) == want[3][2] and hashlib.sha256(rows[3].kept).hexdigest() == want[3][3]
    # Frequent anchors and small portions change how rows travel, not the result.
    monkeypatch.setattr(substrings, "HOT", 3)
    assert results(substrings.without_repeats(docs)) == want
    monkeypatch.setattr(substrings, "SORTED", 50)
    monkeypatch.setattr(substrings, "HOT", 10)
    assert results(substrings.without_repeats(docs)) == want


def test_batches_against_stored_levels(spark, docs_of, monkeypatch):
    """One batch after the other against the levels gives what one run over all of them gives; levels of like size are merged."""
    texts = planted() + ["", None, "short"]
    want = by_hand(dict(enumerate(texts)))
    docs = docs_of(texts)
    for hot, cuts in ((substrings.HOT, [0, 20, 21, 35, len(texts)]), (3, [0, 6, len(texts)])):
        monkeypatch.setattr(substrings, "HOT", hot)
        levels, got = substrings.Levels(spark), {}
        for a, b in zip(cuts, cuts[1:]):
            got |= results(substrings.without_repeats(docs.filter(f"doc_id >= {a} and doc_id < {b}"), levels=levels))
            sizes = [n for _, n in levels.listed()]
            assert sum(sizes) == b and all(x > 2 * y for x, y in zip(sizes, sizes[1:]))
        assert got == want
        # A family found again by its path; nothing of it is new.
        again = substrings.Levels(spark, levels.path)
        assert all(r.n_removed == r.n_bytes for r in substrings.without_repeats(docs.filter("doc_id in (4, 5)"), levels=again).collect())


def test_suffixes_are_compared_by_bytes():
    rng = np.random.default_rng(11)
    for _ in range(30):
        parts, counts = [], []
        for _k in range(int(rng.integers(1, 9))):
            n = int(rng.integers(1, 40))
            parts.append(bytes(rng.integers(0, 2, n + 99, dtype=np.uint8)) if rng.random() < 0.6 or not parts else parts[-1])
            counts.append(len(parts[-1]) - 99)
        met, want = set(), []
        for part in parts:
            for a in range(len(part) - 99):
                want.append(part[a : a + 100] in met)
                met.add(part[a : a + 100])
        assert substrings.suffix_repeats(parts, np.array(counts)).tolist() == want


def test_long_texts_in_tiles(docs_of):
    rng = np.random.default_rng(4)
    a, b = rng.bytes(700_000).hex(), rng.bytes(200_000).hex()
    texts = [a, b + a[substrings.TILE - 300 : substrings.TILE + 9000] + b[:5000]]
    got = results(substrings.without_repeats(docs_of(texts)))
    assert got[0][1] == 0 and got[1][1:3] == (9300 + 5000, 1)


def test_odd_texts(spark, odd_docs, no_docs):
    assert results(substrings.without_repeats(odd_docs)) == by_hand(dict(enumerate(ODD)))
    assert substrings.without_repeats(no_docs).count() == 0
    twice = odd_docs.unionByName(odd_docs)
    assert substrings.without_repeats(twice).count() == 2 * len(ODD)


def test_rows_alike_count_as_one_text(spark, docs_of, monkeypatch):
    texts = planted()
    want = by_hand(dict(enumerate(texts)))
    docs = docs_of(texts)
    for hot in (substrings.HOT, 3):
        monkeypatch.setattr(substrings, "HOT", hot)
        for doubled in (docs.unionByName(docs), docs.unionByName(docs).repartition(4), docs.unionByName(docs).coalesce(1)):
            rows = substrings.without_repeats(doubled).collect()
            assert len(rows) == 2 * len(texts)
            assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == {(d, *w) for d, w in want.items()}
    long = texts[4]
    nulls = spark.createDataFrame([(None, long), (None, long), (7, long), (8, None), (8, None)], "doc_id long, text string")
    got = [(r.doc_id, r.n_removed, r.kept_sha256) for r in substrings.without_repeats(nulls).collect()]
    whole, none = hashlib.sha256(long.encode()).hexdigest(), hashlib.sha256(b"").hexdigest()
    assert sorted(got, key=str) == sorted([(None, 0, whole)] * 2 + [(7, 3000, none)] + [(8, 0, none)] * 2, key=str)


def test_hashes_met_before():
    met, rng = substrings.Met(), np.random.default_rng(2)
    seen = set()
    for _ in range(60):
        prints = rng.integers(0, 5000, 300, dtype=np.uint64)
        want = []
        for x in prints.tolist():
            want.append(x in seen)
            seen.add(x)
        assert met.again(prints).tolist() == want
        sizes = [len(x) for x in met.parts]
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:]))


def test_anchor_hashes_are_even():
    raw = np.random.default_rng(3).bytes(200_000).hex().encode()
    keys = next(substrings.tiles([0], [raw]))[2].key
    share = np.bincount((keys >> np.uint64(60)).astype(int), minlength=16) / len(keys)
    assert len(keys) > 3000 and share.max() < 0.12
