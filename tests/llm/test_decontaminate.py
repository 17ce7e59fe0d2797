import hashlib
import re

import pytest
from llm_cases import ODD
from pyspark.sql import functions as F

from gridmill.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM = " ".join(f"item{i}" for i in range(15))


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def by_hand(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in windows:
                    hit.update(range(i, i + m))
                    found |= windows[tuple(w[i : i + m])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def values(rows):
    return [(r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows]


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").withColumn("h", F.lit("clash")).withColumn("w", F.lit(1))


def test_whole_table_matches_brute_force(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    rows = sorted(decontaminate.op13_decontamination(spark, sf).collect())
    assert [r.doc_id for r in rows] == [d.doc_id for d in docs]
    assert values(rows) == by_hand([d.text for d in docs], items)
    assert any(r.contaminated for r in rows) and not all(r.contaminated for r in rows)


PLANTED = [
    ITEM,
    f"Before {ITEM.upper()}, after",
    " ".join(ITEM.split()[:9]),
    " ".join(ITEM.split()[5:]) + " x " + " ".join(ITEM.split()[:10]),
    "one Two-three. one two three four one",
    "Ünder ünder ÜNDER straße Ⅷ ⅷ ünder",
    "item3 " * 40,
    ITEM + " " + ITEM,
    "four" + " filler" * 3000 + " four",
]
ITEMS = [(1, ITEM), (10, "two three"), (9, "ünder straße"), (2, "four"), (3, None), (4, ""), (5, " .,! "), (6, "ITEM3 item3 item3"), (7, ITEM), (7, "Ⅷ"), (None, "filler filler filler filler four"), (8, "word word word word word word word word word word word word")]


@pytest.mark.parametrize("most_log2", [decontaminate.MOST_LOG2, 0])
def test_planted_and_odd_texts(spark, docs_of, most_log2):
    texts = [*PLANTED, *ODD]
    docs = docs_of(texts).withColumn("w", F.lit("clash")).withColumn("h", F.lit("clash")).withColumn("row", F.lit("clash"))
    rows = sorted(decontaminate.contaminated(docs, items_of(spark, ITEMS), most_log2).collect())
    assert values(rows) == by_hand(texts, ITEMS)


def test_null_ids_repeated_rows_and_empty_tables(spark, docs_of, no_docs):
    docs = docs_of([ITEM, "clean text"])
    odd = docs.union(docs).union(docs.withColumn("doc_id", F.lit(None).cast("long")))
    rows = decontaminate.contaminated(odd, items_of(spark, ITEMS)).collect()
    want = by_hand([ITEM, "clean text"], ITEMS)
    assert sorted(map(repr, values(rows))) == sorted(map(repr, want * 3))
    assert {r.contaminated for r in rows if r.doc_id is None} == {True, False}
    assert decontaminate.contaminated(no_docs, items_of(spark, ITEMS)).count() == 0
    none = decontaminate.contaminated(docs, items_of(spark, [])).collect()
    assert values(none) == by_hand([ITEM, "clean text"], [])


def test_rarest_shingle_is_the_prefix(spark):
    windows = decontaminate.Windows(items_of(spark, [(1, "a b c d e")]))
    hashes = {r.p: r.h for r in windows.shingles.collect()}
    counts = spark.createDataFrame([(3, hashes[0], 5), (3, hashes[1], 2), (3, hashes[2], 9)], "k int, h long, n long")
    assert [(r.h, r.p) for r in decontaminate.rarest(windows, counts).collect()] == [(hashes[1], 1)]
    assert decontaminate.rarest(windows, counts.filter("n > 2")).count() == 0
