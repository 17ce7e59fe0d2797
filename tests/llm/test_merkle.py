import hashlib
import zlib

import pytest
from llm_cases import ODD
from pyspark.sql import functions as F

from gridmill.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """The root and each node's siblings as (left, right) by level."""
    paths, places = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, owners = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i : i + 2]
            for j in range(len(run)):
                for k in places[i + j]:
                    paths[k].append(("".join(run[:j]), "".join(run[j + 1 :])))
            above.append(sha(*run))
            owners.append([k for j in range(len(run)) for k in places[i + j]])
        nodes, places = above, owners
    return nodes[0], paths


def by_hand(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of (doc_id, source, lang, n_chars, text) rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    low = {}
    for lang in langs:
        own = sorted(groups[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        low[lang] = (own, *tree([leaf(r) for r in own]))
    root, high = tree([low[lang][1] for lang in langs]) if langs else (None, [])
    out = []
    for lang, way in zip(langs, high):
        own, subroot, paths = low[lang]
        for r, path in zip(own, paths):
            path = path + way
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            h = leaf((*r[:3], r[3] + 1, r[4])) if bad else leaf(r)
            for a, b in path:
                h = sha(a, h, b)
            out.append((r[0], leaf(r), subroot, root, sha(*[a + b for a, b in path]), h, h == root))
    return out


def values(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_whole_table_matches_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*FIELDS).collect()]
    got = values(merkle.op12_merkle(spark, sf))
    assert got == sorted(map(repr, by_hand(rows)))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(merkle, "BITS", 1)
    monkeypatch.setattr(merkle, "DIGITS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 4)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 33])
def test_blocks_of_blocks(spark, docs_of, small_blocks, n):
    langs = [["en", "de", "en", None, "fr", "en"][i % 6] if n < 20 else f"l{i % 9}" for i in range(n)]
    docs = docs_of([f"text {i}" for i in range(n)], langs=langs)
    rows = [tuple(r) for r in docs.select(*FIELDS).collect()]
    assert values(merkle.manifest(docs)) == sorted(map(repr, by_hand(rows)))


def test_odd_rows(spark, docs_of, odd_docs, no_docs):
    rows = [(i, "s", [None, "en", "", "é", "zz", "\U0001f600"][i % 6], None if i % 4 == 3 else (2**63 - 1 if i == 5 else i), t) for i, t in enumerate(ODD)]
    rows += [(None, None, "en", 4, "t"), (None, None, None, None, None), (3, "s", "en", 1, "other"), rows[4], rows[4]]
    docs = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumn("g", F.lit("clash")).withColumn("hash", F.lit("clash"))
    assert values(merkle.manifest(docs)) == sorted(map(repr, by_hand(rows)))
    assert merkle.manifest(odd_docs).count() == len(ODD)
    assert merkle.manifest(no_docs).count() == 0


def test_tampering_is_found(spark, docs_of):
    docs = docs_of([f"t{i}" for i in range(60)])
    rows = merkle.manifest(docs).collect()
    bad = {i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 0}
    assert bad and {r.doc_id for r in rows if not r.verified} == bad
