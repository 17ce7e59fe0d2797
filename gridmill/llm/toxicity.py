"""Toxicity by a weighted finite-state grammar over clauses.

Five transducers read the tokens of a clause side by side:

* insult: an insult counts half alone, in full with a target shortly before it, and
  more with a target shortly after it;
* threat: a threat verb counts by what led to it (a target, a modal verb, both) and
  more with a target as its object;
* target: once someone is spoken of, all matches count more;
* negation: matches shortly after a negation count a quarter;
* reported speech: matches after a verb of saying count less.

The first two put out amounts, the others factors. Their composition, a transducer over
the product of the states, is built once, and each clause with an insult or a threat is
run through it. So a clause is scored by how its matches combine, not by its words.

Insult words and stems (a stem counts only with an ending) and their weights are
learned from a bounded sample of labelled texts; fixed lists give the closed word
classes and some common insults. A logistic curve over the clause scores, fitted on
the sample, gives the score of a text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.llm.common import documents, held_out, labels, numbered, raw_texts, stored
from gridmill.llm.samples import labelled_sample, logistic, sigmoid

PER_CLASS = 3000
THRESHOLD = 0.3
STEM = range(3, 9)
#: A word or stem is learned if its likelihood ratio statistic is at least this.
SIGNIFICANT = 20.0

# Fixed word lists, by class.
INSULTS = "idiot idiots moron morons stupid scum trash loser losers pathetic worthless disgusting clown fool dumb imbecile dummkopf trottel abschaum imbécile ordure estúpido imbécil basura".split()
THREATS = "kill killed hurt destroy burn beat shoot stab die töten vernichten umbringen tuer détruire frapper matar destruir golpear".split()
TARGETS = "you your yours yourself he she they him her them du dich dir dein ihr euch tu toi te vous tú ti usted ustedes él ella".split()
NEGATIONS = "not no never nobody nothing isn don doesn won nicht kein keine nie niemals pas jamais aucun nunca jamás ningún".split()
MODALS = "will would shall should must can could may might gonna going want werde wirst wird werden sollst soll muss vais vas va devrais dois voy vas debes".split()
REPORTS = "said says say told wrote writes claimed quoted sagte schrieb behauptete dit écrit affirme dijo escribió afirma".split()

WORD = re.compile(r"[^\W\d_]+")
STOP = re.compile(r"[.!?;:\n|]+")
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, MODAL = CLASS = range(7)
#: How many tokens apart a target and an insult, or the parts of a threat, may be; how far a negation reaches.
REACH, NEGATED = 3, 3
#: Amounts: an insult alone (of its weight), a target after an insult, a threat verb (alone, after a target, after a modal, after both), its object.
LONE, AFTER, VERB, OBJECT = 0.5, 0.5, (0.1, 0.3, 0.4, 0.7), 0.6
#: Factors of a negation, of reported speech, and of a clause with a target.
DENIED, REPORTED, AIMED = 0.25, 0.6, 1.4


class Transducer:
    """States from 0; ``arcs[state][token class]`` is (next state, share of the token's own weight put out, amount put out, factor on what is put out)."""

    def __init__(self, arcs: list[list[tuple[int, float, float, float]]]):
        self.arcs = arcs

    def beside(self, other: Transducer) -> Transducer:
        """The composition: both read the same tokens; what they put out adds up, and their factors multiply."""
        n = len(other.arcs)
        return Transducer([[(x * n + y, w + v, p + q, f * g) for (x, w, p, f), (y, v, q, g) in zip(a, b)] for a in self.arcs for b in other.arcs])


def _insults() -> Transducer:
    """State (t, i): for how many tokens a target, and an insult without a target since, are near."""
    arcs = []
    for t in range(REACH + 1):
        for i in range(REACH + 1):
            row = [(max(0, t - 1) * (REACH + 1) + max(0, i - 1), 0.0, 0.0, 1.0) for _ in CLASS]
            row[INSULT] = (max(0, t - 1) * (REACH + 1) + REACH, 1.0 if t else LONE, 0.0, 1.0)
            row[TARGET] = (REACH * (REACH + 1), 0.0, AFTER if i else 0.0, 1.0)
            arcs.append(row)
    return Transducer(arcs)


def _threats() -> Transducer:
    """State 0, or a stage (1 target, 2 modal, 3 target and modal, 4 verb) and for how many tokens it lasts."""
    at = lambda stage, left=REACH: 1 + (stage - 1) * REACH + left - 1 if stage and left else 0
    arcs = []
    for stage, left in [(0, 0), *((s, k) for s in range(1, 5) for k in range(1, REACH + 1))]:
        row = [(at(stage, left - 1) if stage else 0, 0.0, 0.0, 1.0) for _ in CLASS]
        row[TARGET] = (at(1), 0.0, OBJECT if stage == 4 else 0.0, 1.0)
        row[MODAL] = (at(3 if stage in (1, 3) else 2), 0.0, 0.0, 1.0)
        row[THREAT] = (at(4), 0.0, VERB[stage if stage < 4 else 0], 1.0)
        arcs.append(row)
    return Transducer(arcs)


def _negation() -> Transducer:
    return Transducer([[(NEGATED if c == NEGATION else max(0, s - 1), 0.0, 0.0, DENIED if s else 1.0) for c in CLASS] for s in range(NEGATED + 1)])


def _flag(of: int, factor: float) -> Transducer:
    """Once a token of the class has been read, matches are scaled by ``factor``."""
    return Transducer([[(1 if c == of else s, 0.0, 0.0, factor if s else 1.0) for c in CLASS] for s in range(2)])


GRAMMAR = _insults().beside(_threats()).beside(_flag(TARGET, AIMED)).beside(_negation()).beside(_flag(REPORT, REPORTED))
CLASSES = {w: k for k, words in ((MODAL, MODALS), (THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in words}
SEED_WEIGHT = 1.5


class Lexicon:
    """Weights of insult words and of insult stems, in lower case."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for s in {*self.words, *self.stems, *THREATS}:
            found.add_word(s, len(s))
        found.make_automaton()
        return found

    def of(self, word: str) -> float:
        """The weight of a whole word as an insult; 0 if it is none."""
        if (w := self.words.get(word)) is not None:
            return w
        for k in STEM:
            if k < len(word) and (w := self.stems.get(word[:k])) is not None:
                return w
        return 0.0

    def clause(self, words: list[str]) -> float:
        """The weight of one clause: its tokens run through the grammar."""
        state, total, arcs = 0, 0.0, GRAMMAR.arcs
        for word in words:
            insult = self.of(word)
            state, share, amount, factor = arcs[state][INSULT if insult else CLASSES.get(word, OTHER)]
            total += (share * insult + amount) * factor
        return total

    def clauses(self, text: str, automaton) -> list[float]:
        """The weights of the clauses of a lower-cased text that hold a match."""
        starts = set()
        for end, size in automaton.iter(text):
            at = end - size + 1
            if at == 0 or not text[at - 1].isalpha():
                starts.add(at)
        if not starts:
            return []
        found, cuts = [], [0, *(m.end() for m in STOP.finditer(text)), len(text) + 1]
        begin = np.array(cuts)
        for i in sorted(set((np.searchsorted(begin, sorted(starts), side="right") - 1).tolist())):
            weight = self.clause(WORD.findall(text[cuts[i] : cuts[i + 1]]))
            if weight:
                found.append(weight)
        return found


def features(weights: list[float], n_chars: int) -> tuple[float, float, float]:
    """Of a text: total weight, total weight against its length, and the strongest clause."""
    total = sum(weights)
    return math.log1p(total), total / math.log2(64 + n_chars), max(weights, default=0.0)


def _of_text(text: str | None, lexicon: Lexicon, automaton) -> tuple[float, float, float, int]:
    """The features of a text and how many clauses matched."""
    low = (text or "").lower()
    weights = lexicon.clauses(low, automaton)
    return (*features(weights, len(low)), len(weights))


class Grader:
    """What was learned: the words and the curve over the features, intercept first."""

    def __init__(self, lexicon: Lexicon, curve: list[float]):
        self.lexicon, self.curve = lexicon, curve


def learned_lexicon(sample: DataFrame) -> Lexicon:
    """Words, and stems with an ending, that many toxic texts of the sample hold and few others do."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = {w for w in WORD.findall((text or "").lower()) if len(w) >= 3}
                seen[y].update(words | {w[:k] + "*" for w in words for k in STEM if k < len(w)})
        for y in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array(list(seen[y].keys()), pa.string()), pa.array([y] * len(seen[y]), pa.int32()), pa.array(list(seen[y].values()), pa.int64())], ["term", "y", "n"])

    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    seeds = {w: SEED_WEIGHT for w in INSULTS}
    if not toxic or not clean:
        return Lexicon(seeds, {})
    rate = toxic / (toxic + clean)
    terms = sample.select("text", "y").mapInArrow(counted, "term string, y int, n long").groupBy("term").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("p"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("q"))
    p, q = F.col("p"), F.col("q")
    ratio = 2 * (p * F.log(p / ((p + q) * rate)) + q * F.log(F.greatest(q, F.lit(0.5)) / ((p + q) * (1 - rate))))
    odds = F.log((p + 0.5) / (toxic + 1)) - F.log((q + 0.5) / (clean + 1))
    found = terms.filter((p >= 3) & (odds >= 1.0)).select("term", ratio.alias("ratio"), odds.alias("odds")).filter(F.col("ratio") >= SIGNIFICANT)
    # Bounded: each of these terms needs several texts of the bounded sample. Whole words go before stems of the same strength, longer before shorter.
    kept = sorted(found.collect(), key=lambda r: (-round(r.ratio, 6), r.term.endswith("*"), -len(r.term), r.term))
    words, stems, chosen = seeds, {}, []
    for r in kept:
        base = r.term.rstrip("*")
        if not any(base.startswith(c) or c.startswith(base) for c in chosen):
            chosen.append(base)
            (stems if r.term.endswith("*") else words)[base] = min(4.0, float(r.odds))
    return Lexicon(words, stems)


def apart(sample: DataFrame) -> DataFrame:
    """One of each family of copies in the sample, so that a text copied many times is one piece of evidence: texts with the same least hash of three words running."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            families = []
            for raw in raw_texts(batch.column(1)):
                words = raw.lower().split()
                families.append(min((xxhash.xxh64_intdigest(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0) >> 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(families, pa.int64())], ["doc_id", "text", "y", "family"])

    return sample.select("doc_id", "text", "y").mapInArrow(least, "doc_id long, text string, y int, family long").groupBy("family").agg(F.min(F.struct("doc_id", "text", "y")).alias("one")).select("one.*")


def fit(docs: DataFrame, marks: DataFrame, usable: F.Column, per_class: int = PER_CLASS) -> Grader:
    """Learns from about ``per_class`` labelled texts of each class. Without labels of both classes the curve is fixed."""
    sample, counts = labelled_sample(docs, marks, "toxic", usable, per_class)
    sample = stored(apart(sample))
    lexicon = learned_lexicon(sample)
    fixed = Grader(lexicon, [-3.0, 1.5, 0.5, 0.2])
    if len(counts) < 2:
        return fixed
    rows = _measured(sample.select("doc_id", "text", "y"), lexicon).collect()
    y = np.array([r.y for r in rows], float)
    if len(set(y)) < 2:
        return fixed
    total = sum(counts.values())
    weight = np.where(y == 1, counts[1] / total / y.sum(), counts[0] / total / (len(y) - y.sum())) * len(y)
    return Grader(lexicon, logistic(np.array([[r.a, r.b, r.c] for r in rows]), y, weight, ridge=0.1).tolist())


def _measured(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The features a, b, c of every row, beside doc_id and y (if ``docs`` has it)."""
    extra = "y" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            rows = [_of_text(text, lexicon, automaton) for text in batch.column(1).to_pylist()]
            a, b, c, n = zip(*rows) if rows else ((), (), (), ())
            made = [batch.column(0).cast(pa.int64()), *([batch.column(2).cast(pa.int32())] if extra else []), pa.array(a, pa.float64()), pa.array(b, pa.float64()), pa.array(c, pa.float64()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(made, ["doc_id", *(["y"] if extra else []), "a", "b", "c", "n_clauses"])

    return docs.select("doc_id", "text", *(["y"] if extra else [])).mapInArrow(run, "doc_id long, " + "y int, " * extra + "a double, b double, c double, n_clauses long")


def scored(docs: DataFrame, grader: Grader) -> DataFrame:
    """doc_id, score, predicted, n_clauses for every row of ``docs``.

    A null or empty text has no clause and gets the curve's value at nothing. Repeated
    rows and null ids each get a row; an empty table gives none; other columns are not
    looked at.
    """
    c0, c1, c2, c3 = grader.curve
    z = F.lit(c0) + F.col("a") * c1 + F.col("b") * c2 + F.col("c") * c3
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    return _measured(docs.select("doc_id", "text"), grader.lexicon).select("doc_id", score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"), "n_clauses")


def without_toxic(docs: DataFrame, marks: DataFrame, usable: F.Column) -> DataFrame:
    """``docs`` without the rows that are predicted toxic; all columns kept, whatever their names, nothing shuffled. Null and empty texts stay; repeated rows go or stay alike; an empty table gives none."""
    grader = fit(docs, marks, usable)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = grader.lexicon.automaton()
        for batch in batches:
            rows = [_of_text(text, grader.lexicon, automaton) for text in batch.column(place).to_pylist()]
            z = np.array([[1.0, *r[:3]] for r in rows]).reshape(-1, 4) @ np.array(grader.curve)
            yield batch.filter(pa.array(sigmoid(z) < THRESHOLD))

    plain = numbered(docs)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    grader = fit(docs, labels(spark, sf_dir), ~held_out(4, 2))
    return scored(docs, grader).select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted", "n_clauses")
