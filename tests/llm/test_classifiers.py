"""Held-out accuracy of the fitted operators, and their answers to odd texts."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from llm_cases import ODD
from pyspark.sql import functions as F

from gridmill.llm import language, quality, samples, toxicity

SF = "/root/testdata/sf0.01"


def ranked(score, y):
    """The chance that a row of class 1 scores above one of class 0."""
    a, b = score[y == 1], score[y == 0]
    return float((a[:, None] > b[None, :]).mean() + 0.5 * (a[:, None] == b[None, :]).mean())


def judged(spark, rows, column, sf=SF):
    marks = {r.doc_id: r[column] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = [r for r in rows if r.held_out and r.doc_id in marks]
    return np.array([r.score for r in kept]), np.array([marks[r.doc_id] for r in kept]), np.array([r.predicted for r in kept])


def test_held_out_is_by_crc32(spark):
    from gridmill.llm.common import held_out

    rows = spark.range(200).select(F.col("id").alias("doc_id"), held_out(3, 1, "id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"  # sf0.01 has 49 labels of bad texts, too few to train dictionaries on
    rows = quality.op5_quality(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    score, y, predicted = judged(spark, rows, "quality", sf)
    assert ranked(score, y) > 0.98 and (predicted == y).mean() > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"  # sf0.01 has 51 labels of toxic texts in four languages
    rows = toxicity.op2_toxicity(spark, sf).collect()
    score, y, predicted = judged(spark, rows, "toxic", sf)
    assert ranked(score, y) > 0.95
    assert (predicted[y == 0] == 0).mean() > 0.98 and predicted[y == 1].mean() > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_language_held_out(spark):
    rows = language.op9_language(spark, SF).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in kept]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_codewords_lie_apart():
    for n in (2, 3, 4, 6, 12):
        code = language.codewords(n)
        least = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        assert least >= (2 ** (n - 2) if n <= 6 else 8)


@pytest.fixture
def marks(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(len(ODD))], "doc_id long, quality int, toxic int")


def test_odd_texts(spark, odd_docs, no_docs, marks):
    every = F.lit(True)
    q = quality.scored(odd_docs, quality.fit(odd_docs, marks, every)).collect()
    t = toxicity.scored(odd_docs, toxicity.fit(odd_docs, marks, every)).collect()
    assert len(q) == len(t) == len(ODD) and all(0 <= r.score <= 1 for r in [*q, *t])
    lang = {r.doc_id: r for r in language.predicted(odd_docs, language.fit(odd_docs, every)).collect()}
    assert [lang[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and lang[3].lang_pred == "en"
    for made in (quality.scored(no_docs, quality.fit(no_docs, marks.limit(0), every)), toxicity.scored(no_docs, toxicity.fit(no_docs, marks.limit(0), every)), language.predicted(no_docs, language.fit(no_docs, every))):
        assert made.count() == 0


def test_clauses_not_words():
    lexicon = toxicity.Lexicon({"moron": 2.0}, {"blart": 1.0})
    plain = lexicon.clause("a moron walked".split())
    assert lexicon.clause("you moron".split()) > plain > lexicon.clause("not a moron".split()) > 0
    assert lexicon.clause("she said a moron".split()) < lexicon.clause("she is a moron".split())
    assert lexicon.clause(["blart"]) == 0 and lexicon.clause(["blarty"]) == toxicity.LONE
    assert lexicon.clause("the moron you".split()) > plain
    assert lexicon.clause("you will kill him".split()) > lexicon.clause("you will kill".split()) > lexicon.clause("you kill".split()) > lexicon.clause(["kill"]) > 0
    assert lexicon.clause("you will burn".split()) > lexicon.clause("it will burn".split()) > 0


def graded_by_hand(text, lexicon):
    """The features of a text: every clause walked by looking back and forth, without machines or an automaton."""
    t = toxicity
    low, weights = (text or "").lower(), []
    for clause in re.split(r"[.!?;:\n|]+", low):
        words = re.findall(r"[^\W\d_]+", clause)
        kind = [t.INSULT if lexicon.of(w) else t.CLASSES.get(w, t.OTHER) for w in words]
        near = lambda i, of, reach: [j for j in range(max(0, i - reach), i) if kind[j] == of]  # noqa: E731, B023
        total, state = 0.0, (0, 0)
        for i, (w, k) in enumerate(zip(words, kind)):
            stage = state[0] if i - state[1] <= t.REACH else 0
            amount = 0.0
            if k == t.INSULT:
                amount = lexicon.of(w) * (1.0 if near(i, t.TARGET, t.REACH) else t.LONE)
            elif k == t.TARGET:
                since = [j for j in near(i, t.INSULT, t.REACH) if t.TARGET not in kind[j:i]]
                amount = (t.AFTER if since else 0.0) + (t.OBJECT if stage == 4 else 0.0)
                state = (1, i)
            elif k == t.MODAL:
                state = (3 if stage in (1, 3) else 2, i)
            elif k == t.THREAT:
                amount = t.VERB[stage if stage < 4 else 0]
                state = (4, i)
            amount *= t.DENIED if near(i, t.NEGATION, t.NEGATED) else 1
            amount *= t.REPORTED if t.REPORT in kind[:i] else 1
            amount *= t.AIMED if t.TARGET in kind[:i] else 1
            total += amount
        # Only clauses with an insult or a threat are looked at; a stem counts as one.
        marks = {*lexicon.words, *lexicon.stems, *t.THREATS}
        if total and any(w.startswith(m) for w in words for m in marks):
            weights.append(total)
    return t.features(weights, len(low))


def test_toxicity_matches_brute_force(spark, docs_of):
    lexicon = toxicity.Lexicon({w: 1.5 for w in toxicity.INSULTS} | {"moron": 2.0}, {"blart": 1.0})
    grader = toxicity.Grader(lexicon, [-2.0, 1.0, 0.7, 0.3])
    rng = random.Random(4)
    pool = [*toxicity.INSULTS[:6], *toxicity.THREATS[:5], *toxicity.TARGETS[:6], *toxicity.NEGATIONS[:3], *toxicity.REPORTS[:3], *toxicity.MODALS[:4], "blart", "blarty", "plain", "words", ".", "\n", "?", ","]
    texts = [" ".join(rng.choices(pool, k=rng.choice([3, 12, 60]))) for _ in range(400)] + ODD
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r.doc_id: r for r in toxicity.scored(docs_of(texts), grader).collect()}
    for i, text in enumerate(texts):
        z = sum(c * f for c, f in zip(grader.curve, (1.0, *graded_by_hand(text, lexicon))))
        assert abs(got[i].score - 1 / (1 + math.exp(-z))) < 1e-9, text
        assert got[i].predicted == int(got[i].score >= 0.3)


def test_quality_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, marks, F.lit(True))
    bad, good = model.compressors()
    got = {r.doc_id: r for r in quality.scored(docs, model).collect()}
    for r in docs.collect():
        raw = (r.text or "").encode()
        parts = [raw[i : i + 512] for i in range(0, len(raw), 512)]
        saved = sum(len(bad.compress(p)) for p in parts) - sum(len(good.compress(p)) for p in parts)
        z = model.curve[0] + model.curve[1] * 100 * saved / max(1, len(raw))
        assert abs(got[r.doc_id].score - 1 / (1 + math.exp(-min(30, max(-30, z))))) < 1e-9


def test_long_texts_are_learned_from(docs_of, spark):
    """Bad texts that are all longer than any block: the dictionary still holds them."""
    rng = random.Random(1)
    good = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta", "omega"], k=60)) for _ in range(90)]
    bad = ["".join(rng.choices("qxzjk", k=60_000)) for _ in range(6)]
    docs = docs_of(good + bad)
    marks = spark.createDataFrame([(i, int(i < 90)) for i in range(96)], "doc_id long, quality int")
    rows = quality.scored(docs, quality.fit(docs, marks, F.lit(True))).collect()
    assert all(r.predicted == int(r.doc_id < 90) for r in rows)


def test_language_matches_brute_force_and_stands_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").filter("doc_id < 400")
    code = language.fit(docs, F.lit(True))
    want = {}
    for r in docs.collect():
        x = b" " + (r.text or "").encode() + b" "
        sums = [0] * code.words.shape[1]
        for i in range(len(x) - 2):
            bucket = ((x[i] | x[i + 1] << 8 | x[i + 2] << 16) * 0x9E3779B1 % (1 << 32)) >> (32 - language.BUCKETS_LOG2)
            sums = [s + int(w) for s, w in zip(sums, code.weights[bucket])]
        margins = [s / (max(1, len(x) - 2) * language.UNIT) for s in sums]
        sharp = min(math.sqrt(len(x) - 2), 40.0)
        loss = [sum(float(b) * math.log1p(math.exp(-m * int(w) * sharp)) for b, m, w in zip(code.bit_weight, margins, word)) for word in code.words]
        want[r.doc_id] = (code.langs[loss.index(min(loss))], 1 / sum(math.exp(min(loss) - v) for v in loss)) if re.search(r"[^\W\d_]", r.text or "") else ("und", 0.0)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predicted(docs, code).collect()}
    assert all(got[d][0] == w[0] and abs(got[d][1] - w[1]) < 1e-6 for d, w in want.items())
    for other in (docs.orderBy(F.desc("doc_id")), docs.repartition(7), docs.filter("doc_id % 3 = 0")):
        assert all(got[r.doc_id] == (r.lang_pred, r.score) for r in language.predicted(other, code).collect())


def test_logistic_fit_recovers_a_line():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 1))
    y = (rng.random(4000) < samples.sigmoid(0.5 + 2 * x[:, 0])).astype(float)
    assert np.allclose(samples.logistic(x, y), [0.5, 2], atol=0.2)
