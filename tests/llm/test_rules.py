import re
from collections import Counter

from llm_cases import ODD

from gridmill.llm import rules

WORD = re.compile("[^\x20\x09-\x0d]+")
TEXTS = ["a b c d e f g h a b c d e f g h", "# $ % & | < > * x", "one line\none line\n\n \n\none line", "w " * 19, "w%d " * 5 % (1, 2, 3, 4, 5) * 6, " ".join(f"u{i}" for i in range(60)), " ".join(f"u{i}" for i in range(40)) + " " + " ".join(f"u{i}" for i in range(40)) + " z" * 3]


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(grams)
    covered = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def measures(rows):
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows}


def test_whole_table_matches_brute_force(spark, sf):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = rules.op8_rules(spark, sf).collect()
    assert measures(rows) == {d: by_hand(t) for d, t in texts.items()}
    assert all(r.kept == (not r.base_failed) for r in rows)  # no host of these is bad


def test_odd_texts(docs_of, odd_docs, no_docs):
    assert measures(rules.ruled(odd_docs).collect()) == {i: by_hand(t) for i, t in enumerate(ODD)}
    assert measures(rules.ruled(docs_of(TEXTS)).collect()) == {i: by_hand(t) for i, t in enumerate(TEXTS)}
    assert rules.ruled(no_docs).count() == 0


def test_bad_hosts_lose_their_documents_and_small_ones_are_shrunk(docs_of):
    good = " ".join(f"word{i}" for i in range(40))
    texts, hosts = [], []
    for host, n, bad in (("bad", 60, 55), ("tiny", 1, 1), *((f"ok{i}", 60, 3) for i in range(8))):
        texts += [good + f" {host} {k}" if k >= bad else "short" for k in range(n)]
        hosts += [host] * n
    texts.append(good)
    hosts.append(None)
    rows = rules.ruled(docs_of(texts, sources=hosts)).collect()
    by_host = {}
    for r in rows:
        by_host.setdefault(hosts[r.doc_id], []).append(r)
    assert not any(r.kept for r in by_host["bad"])
    assert by_host["tiny"][0].host_rate < 1.0
    assert all(r.kept == (not r.base_failed) for h, rs in by_host.items() if h not in ("bad", "tiny") for r in rs)
