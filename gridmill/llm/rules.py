"""Quality rules per document and verdicts per host, in DataFrame functions only.

Every document is held against fixed rules over words, symbols and lines. Failures
are summed by host (the ``source`` of a document); a host's failure rate is shrunk
towards the rates of all hosts by a beta prior fitted to them by moments (the binomial
noise of hosts of their sizes taken off), so that a host with few documents is not
judged on them alone. The verdicts are joined back:
documents of a host whose shrunken rate is too high are not kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.llm.common import documents, stored

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 8
FEWEST_WORDS = 20
MOST_REPEATED = 30
#: A document also fails for its host's rate if symbols are more than this share of its word characters, or repeated lines of its lines.
MOST_SYMBOLS, MOST_LINES = 0.1, 0.3
#: Hosts whose shrunken failure rate is above this lose all their documents.
WORST_RATE = 0.5


def _let(value: F.Column, then) -> F.Column:
    """``then`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _covered(starts: F.Column) -> F.Column:
    """How many words the windows at the given ascending starts cover together."""
    steps = F.transform(starts, lambda s, i: F.coalesce(F.least(F.lit(WINDOW), F.get(starts, i + 1) - s), F.lit(WINDOW)))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def _repeated(windows: F.Column) -> F.Column:
    """Words in windows whose hash comes twice or more: equal hashes are neighbours once sorted."""

    def of_sorted(pairs: F.Column) -> F.Column:
        same = lambda i, j: F.get(pairs, i)["h"] == F.get(pairs, j)["h"]
        twice = F.filter(pairs, lambda p, i: F.coalesce(same(i, i + 1), F.lit(False)) | F.when(i > 0, same(i, i - 1)).otherwise(False))
        return _let(F.array_sort(F.transform(twice, lambda p: p["i"])), _covered)

    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_let(F.array_sort(pairs), of_sorted))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, SPACES, -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.trim(line, F.lit(" \t\n\x0b\f\r")) != "")

    def of_words(w: F.Column) -> F.Column:
        hashes = F.transform(w, lambda x: F.xxhash64(x))
        windows = _let(hashes, lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, F.lit(WINDOW)))))
        repeats = F.when(F.size(w) < WINDOW, F.lit(0)).otherwise(_let(windows, _repeated))
        return F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), repeats.alias("n_repeat_words"))

    of_lines = _let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    made = docs.select("doc_id", F.col("source").alias("host"), _let(words, of_words).alias("w"), of_lines.alias("l"), F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("n_symbols"))
    return made.select("doc_id", "host", *[F.col(c).cast("long").alias(c.split(".")[1] if "." in c else c) for c in ("w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "l.n_lines", "w.n_repeat_words")])


def host_verdicts(judged: DataFrame) -> DataFrame:
    """host, n_docs, n_failed, rate (shrunken) and rejected, from (host, rule_failed). Rows without a host are left out."""
    hosts = stored(judged.filter("host is not null").groupBy("host").agg(F.count("*").alias("n_docs"), F.count_if("rule_failed").alias("n_failed")))
    share = F.col("n_failed") / F.col("n_docs")
    row = hosts.agg(F.avg(share).alias("m"), F.var_samp(share).alias("v"), F.avg(1 / F.col("n_docs")).alias("noise")).first()
    m = row.m or 0.0
    # The spread of the rates less what hosts of their sizes would show by chance alone.
    v = (row.v or 0.0) - m * (1 - m) * (row.noise or 0.0)
    # Prior documents: m(1-m)/v - 1 by moments; with no such spread the prior outweighs any one host.
    strength = max(1.0, m * (1 - m) / v - 1) if v > 0 else 1000.0
    rate = (F.col("n_failed") + m * strength) / (F.col("n_docs") + strength)
    return hosts.select("host", "n_docs", "n_failed", rate.alias("rate"), (rate > WORST_RATE).alias("rejected"))


def ruled(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measures, base_failed, rule_failed, host_rate, kept.

    Null texts have no words and fail. A document without a source is judged by the
    base rules alone. Repeated rows each count; an empty table gives none.
    """
    base = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    more = (F.col("n_symbols") > MOST_SYMBOLS * F.col("word_chars")) | (F.col("n_dup_lines") > MOST_LINES * F.col("n_lines"))
    judged = stored(measured(docs).withColumn("base_failed", base).withColumn("rule_failed", base | more))
    verdicts = host_verdicts(judged).select("host", F.col("rate").alias("host_rate"), "rejected")
    joined = judged.join(verdicts, "host", "left")
    kept = ~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "rule_failed", F.round("host_rate", 9).alias("host_rate"))


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ruled(documents(spark, sf_dir, "doc_id", "text", "source"))


OP8_SQL = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
i AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 6, 1))) AS i FROM w),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 7], ' ')) AS n FROM i),
r AS (SELECT doc_id, sum(step) AS n_repeat_words FROM (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS step FROM g WHERE n > 1) GROUP BY doc_id),
m AS (SELECT doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
 len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
f AS (SELECT *, base_failed OR n_symbols > 0.1 * word_chars OR n_dup_lines > 0.3 * n_lines AS rule_failed FROM b),
h AS (SELECT source, count(*) AS n, count(*) FILTER (rule_failed) AS k FROM f WHERE source IS NOT NULL GROUP BY source),
q AS (SELECT avg(k / n) AS m, var_samp(k / n) AS total, avg(1 / n) AS noise FROM h),
p AS (SELECT m, coalesce(total, 0) - m * (1 - m) * noise AS v FROM q),
s AS (SELECT m, CASE WHEN v > 0 THEN greatest(1.0, m * (1 - m) / v - 1) ELSE 1000.0 END AS strength FROM p),
v AS (SELECT source, (k + m * strength) / (n + strength) AS rate FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(rate > 0.5, false) AS kept, rule_failed, round(rate, 9) AS host_rate
FROM f LEFT JOIN v USING (source)
"""
