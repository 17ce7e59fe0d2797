"""The pipeline's stages, each against a brute-force version on its own input."""

import random

import corpus_pipeline
import numpy as np
from test_dedup import exact_by_hand
from test_packing import holds
from test_secrets import base_by_hand

from gridmill.llm import exact_dedup, simhash, toxicity
from gridmill.llm.common import held_out, labels

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shingles(text, k=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def alike(a, b):
    return len(a & b) / max(1, len(a | b))


def test_stages_one_after_the_other(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "secret_scans", "best_fit_packing"]
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        outs.append(docs)
    assert all(d.columns == COLUMNS for d in outs[:-1])
    raw = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    clean, exact, near, redacted = ({r.doc_id: r.text for r in d.collect()} for d in outs[:-1])
    graded = toxicity.scored(spark.read.parquet(f"{sf}/documents.parquet"), toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), labels(spark, sf), ~held_out(4, 2)))
    assert set(clean) == set(raw) - {r.doc_id for r in graded.collect() if r.predicted}
    assert set(exact) == {d for d, v in exact_by_hand(list(clean.items())).items() if v[2]}
    sets = {d: shingles(t) for d, t in exact.items()}
    for d in set(exact) - set(near):
        assert any(alike(sets[d], sets[e]) > 0.5 for e in near)
    ids = sorted(near)
    missed = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if alike(sets[a], sets[b]) >= 0.85]
    assert missed == []
    assert set(redacted) == set(near)
    for d, t in redacted.items():
        if base_by_hand(near[d])[:3] == (0, 0, 0):
            assert t == near[d] or "[secret]" in t
        else:
            assert "[secret]" in t and base_by_hand(t)[1:3] == (0, 0)
    assert holds(outs[-1].collect(), redacted) > 0


def test_similar_texts_meet_and_others_do_not(docs_of):
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts, family = [], []
    for f in range(40):
        base = fresh(rng.choice([60, 200, 900]))
        for k in range(4):
            words = list(base)
            for _ in range(len(words) // 80 if k else 0):
                words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
            family.append(f)
    texts += [" ".join(fresh(n)) for n in (1, 2, 5, 6, 30, 300)]
    family += range(100, 106)
    docs = docs_of(texts)
    for most in (2, 1024):
        rows = {r.doc_id: r.component_id for r in simhash.similar_groups(docs, most=most).collect()}
        sets = [shingles(t) for t in texts]
        for i in range(len(texts)):
            for j in range(i):
                if family[i] == family[j] and alike(sets[i], sets[j]) >= 0.8:
                    assert rows[i] == rows[j]
                if family[i] != family[j]:
                    assert rows[i] != rows[j]


def test_links_are_exact_at_the_limit(docs_of):
    """Pairs of sets of one size that share just 0.8 of their union, or one shingle less; chains of the latter do not join, either."""
    rng = random.Random(12)
    fresh = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    texts, want = [], []
    for at in range(60):
        # 180 shingles; 20 changed at the end leave 160 of 200 (0.8), 21 leave 159 of 201.
        base, below = fresh(184), at % 2
        texts += [" ".join(base), " ".join(base[: 164 - below] + fresh(20 + below))]
        want += [2 * at, 2 * at + below]
    sets = [shingles(t) for t in texts]
    for i in range(0, len(texts), 2):
        assert (alike(sets[i], sets[i + 1]) >= 0.8) == (want[i] == want[i + 1])
    chain = fresh(184 + 21 * 7)
    texts += [" ".join(chain[21 * k : 21 * k + 184]) for k in range(8)]
    want += range(120, 128)
    for most in (2, 1024):
        rows = {r.doc_id: r.component_id for r in simhash.similar_groups(docs_of(texts), most=most).collect()}
        assert [rows[i] for i in range(len(texts))] == want


def test_one_hot_key_is_enough_and_other_texts_of_an_id_stay(spark, monkeypatch):
    rng = random.Random(13)
    fresh = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    base = fresh(184)
    alone = " ".join(fresh(184))
    twin = " ".join(base[:180] + fresh(4))
    other = " ".join(base[:178] + fresh(6))
    rows = [(3, " ".join(base)), (5, alone), (5, twin), (3, other), (9, " ".join(fresh(90)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(tuple(r) for r in simhash.without_near_copies(docs).collect())
    # One of the two similar texts under id 3 stays.
    assert len(kept) == 3 and (5, alone) in kept and rows[4] in kept and sum(k[0] == 3 for k in kept) == 1
    # Texts that share the first of their keys only, in a bucket of more than ``most``.
    made = simhash.wide_print
    monkeypatch.setattr(simhash, "wide_print", lambda *a: (lambda fp, keys: (fp, [1, *(k + i for i, k in enumerate([hash(fp) >> 8] * 7))]))(*made(*a)))
    texts = [(i, " ".join(base[:170] + fresh(14))) for i in range(6)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r.component_id for r in simhash.similar_groups(docs, most=2).collect()} == {0}


def test_stages_stand_odd_texts(spark, sf, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, sf)
            if name == "best_fit_packing":
                assert made.select("doc_id").distinct().count() == docs.count()
            else:
                assert made.count() <= docs.count() and made.columns == docs.columns
                if made.columns != COLUMNS:
                    assert all(v == "clash" for r in made.drop(*COLUMNS).collect() for v in r)


def test_chains_lose_no_near_print():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 1 << 63, (400, 4), dtype=np.uint64)
    for most in (20, 78):
        for i in range(400):
            x = np.zeros(256, np.uint8)
            x[rng.choice(256, rng.integers(most // 2, most + 3), replace=False)] = 1
            other = prints[i] ^ np.packbits(x, bitorder="little").view(np.uint64)
            assert simhash._wide(most)(prints[i : i + 1], other[None])[0] == (x.sum() <= most)


def test_recall_against_all_pairs(spark):
    """All pairs of five-word shingle sets at 0.8 or more of a whole table, by an inverted index, also where every bucket counts as large."""
    docs = exact_dedup.without_copies(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    holders = {}
    for d, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(d)
    pairs = {(a, b) for ds in holders.values() for a in ds for b in ds if a < b}
    pairs = [(a, b) for a, b in pairs if alike(sets[a], sets[b]) >= 0.8]
    for most in (4, 1024):
        rows = {r.doc_id: r.component_id for r in simhash.similar_groups(docs, most=most).collect()}
        assert sum(rows[a] == rows[b] for a, b in pairs) >= 0.99 * len(pairs) and len(pairs) >= 5
