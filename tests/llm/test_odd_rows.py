"""Rows without an id and rows that repeat, for the operators that work on each row: each row is answered, and by its own text."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gridmill.llm import exact_dedup, language, pieces, quality, rules, secrets, simhash, toxicity

TEXTS = ["good words of a plain text " * 6, "other words, token=abcdefghijklmnop and more of them " * 5, None, "", "bad awful words of a poor text " * 7]
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def rows(spark):
    """Every text three times: twice as one row that repeats, and once without an id."""
    plain = [(i, t, "en" if i % 2 else "de", "host", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(plain * 2 + [(None, *r[1:]) for r in plain], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).cache()


@pytest.fixture(scope="module")
def marks(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(len(TEXTS))], "doc_id long, quality int, toxic int")


def by_id(df):
    """The answers without the id, by id; those of rows without one under None."""
    found = {}
    for r in df.collect():
        values = r.asDict()
        found.setdefault(values.pop("doc_id"), []).append(tuple(sorted(values.items(), key=lambda kv: kv[0])))
    return found


@pytest.mark.parametrize("name", ["rules", "pieces", "secrets", "quality", "toxicity", "language"])
def test_rows_are_answered_by_their_text(rows, marks, name):
    spark, every = rows.sparkSession, F.lit(True)
    if name == "rules":
        made = rules.ruled(rows)
    elif name == "pieces":
        made = pieces.encoded(rows, PATH)
    elif name == "secrets":
        made = secrets.digests(secrets.Ledger(spark).scan(rows))
    elif name == "quality":
        made = quality.scored(rows, quality.fit(rows, marks, every)).drop("held_out")
    elif name == "toxicity":
        made = toxicity.scored(rows, toxicity.fit(rows, marks, every)).drop("held_out")
    else:
        made = language.predicted(rows, language.fit(rows, every)).drop("held_out")
    found = by_id(made)
    assert {i: len(v) for i, v in found.items()} == {**{i: 2 for i in range(len(TEXTS))}, None: len(TEXTS)}
    assert all(v[0] == v[1] for i, v in found.items() if i is not None)
    assert sorted(map(repr, found[None])) == sorted(repr(found[i][0]) for i in range(len(TEXTS)))


def test_exact_groups_keep_every_row_with_the_keeping_id(rows):
    found = {}
    for r in exact_dedup.exact_groups(rows).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert {i: len(v) for i, v in found.items()} == {**{i: 2 for i in range(len(TEXTS))}, None: len(TEXTS)}
    assert all(r.keep_id == (3 if i in (2, 3) else i) and r.kept == (i != 2) and r.group_size == (6 if i in (2, 3) else 3) for i, v in found.items() if i is not None for r in v)
    assert not any(r.kept for r in found[None])


def test_near_groups_name_the_smallest_id(rows):
    found = {}
    for r in simhash.near_groups(rows).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert {i: len(v) for i, v in found.items()} == {**{i: 2 for i in range(len(TEXTS))}, None: len(TEXTS)}
    assert all(r.component_id == min(2, i) if i in (2, 3) else r.component_id <= i for i, v in found.items() if i is not None for r in v)
    fingerprints = {i: {r.fingerprint for r in v} for i, v in found.items()}
    assert fingerprints[2] == fingerprints[3] == {"0" * 16} and all(len(f) == 1 for i, f in fingerprints.items() if i is not None)
    assert fingerprints[None] == set().union(*[f for i, f in fingerprints.items() if i is not None])
