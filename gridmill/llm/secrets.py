"""Secret scans over an incremental ledger of content-addressed texts, in DataFrame functions only.

A text (any version of a document) is a blob, addressed by its SHA-256. The ledger, a
Parquet table, has a row for every blob and rule version scanned so far. A scan takes
the blobs of its documents, scans one copy of each that the ledger does not have under
the current version of the rules, appends the findings to the ledger and joins them
back to every document that holds the blob.

Texts stay where they lie. A pass over the addresses marks in a bitmap of bounded size
those that occur twice or are in the ledger; a text with an unmarked address is new and
alone, and is scanned in place. Only texts with a marked address are shuffled, to find
the unseen ones and one copy of each.

Positions count code points from 0 and ends are exclusive. They come from splitting a
text at a rule's matches: the lengths of the parts between and of the matches add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.llm import bitmaps
from gridmill.llm.common import documents, fresh, quoted, shared_dir, stored

#: Fixed patterns. Kind, pattern, the group whose length counts, its least length, and a text that any match holds (for a cheap look beforehand; none for ``assign`` and ``hex``).
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, None),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, "AKIA"),
    ("hex", r"[0-9a-f]{16,}", 0, 16, None),
)
#: Kinds added to the base: private key blocks, tokens with a well-known head, and signed web tokens.
MORE = (
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----", 0, 1, "-----BEGIN "),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, "gh"),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 20, "eyJ"),
)
RULES = BASE + MORE
VERSION = "2024-1"

SPANS = "array<struct<start: int, rank: int, end: int, kind: string>>"
LEDGER = f"blob string, version string, spans {SPANS}"


def _let(value: F.Column, then) -> F.Column:
    """``then`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _spans(text: F.Column, rank: int, kind: str, pattern: str, group: int, least: int, needs: str | None) -> F.Column:
    """The spans of one rule: matches from the left that do not overlap, those too short dropped."""
    rule = F.lit(pattern)

    def placed(matches: F.Column) -> F.Column:
        sizes = F.transform(F.regexp_extract_all(text, rule, F.lit(group)), F.length) if group else F.transform(matches, F.length)

        def walked(parts: F.Column) -> F.Column:
            # The gap before each match and the match itself, walked from the left with the position so far.
            start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found"))

            def step(state: F.Column, part: F.Column) -> F.Column:
                begin = state["at"] + part["gap"]
                end = begin + part["len"]
                span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))
                return F.struct(end.alias("at"), F.when(part["counts"] >= least, F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found"))

            return F.aggregate(parts, start, step, lambda state: state["found"])

        gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), F.lit(1), F.size(matches))
        return _let(F.arrays_zip(gaps.alias("gap"), F.transform(matches, F.length).alias("len"), sizes.alias("counts")), walked)

    found = _let(F.regexp_extract_all(text, rule, F.lit(0)), lambda m: F.when(F.size(m) == 0, F.array().cast(SPANS)).otherwise(placed(m)))
    return F.when(F.contains(text, F.lit(needs)), found).otherwise(F.array().cast(SPANS)) if needs else found


def findings(text: F.Column) -> F.Column:
    """All spans of a text, by start and then in the order of the rules."""
    return F.array_sort(F.concat(*[_spans(text, i, *rule) for i, rule in enumerate(RULES)]))


class Ledger:
    """Scanned blobs in a Parquet folder that grows by appends; a new folder is an empty ledger."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or f"{shared_dir(spark)}-ledger"
        self._append(spark.createDataFrame([], LEDGER))

    def _append(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)

    def rows(self, version: str) -> DataFrame:
        """blob, spans of all blobs scanned under the version; a blob that two runs scanned at the same time counts once."""
        return self.spark.read.schema(LEDGER).parquet(self.path).filter(F.col("version") == version).groupBy("blob").agg(F.first("spans").alias("spans"))

    def update(self, docs: DataFrame, version: str = VERSION) -> DataFrame:
        """Scans the blobs of ``docs`` that are new to the ledger. Gives doc_id, blob of every row, stored."""
        blobs = docs.select("doc_id", _text().alias("text"), _address().alias("blob"))
        paths = stored(blobs.select("doc_id", "blob"))
        known = self.spark.read.schema(LEDGER).parquet(self.path).filter(F.col("version") == version).select("blob")
        log2 = bitmaps.size_for(paths.count() + known.count())
        seen = bitmaps.bitmap(paths.select("blob").unionByName(known).select(F.xxhash64("blob").alias("h")), "h", log2, least=2)
        # What the ledger has, had one mark from there and has one from here.
        tested = bitmaps.tested(blobs.select("text", "blob"), F.xxhash64("blob"), seen, log2, "again")
        again = tested.filter("again").select("text", "blob")
        # Equal blobs have equal texts, so that of any row will do.
        new = tested.filter(~F.col("again")).select("text", "blob").unionByName(again.join(known.distinct(), "blob", "left_anti").dropDuplicates(["blob"]).select("text", "blob"))
        self._append(new.select("blob", F.lit(version).alias("version"), findings(F.col("text")).alias("spans")))
        return paths

    def found(self, version: str = VERSION) -> DataFrame:
        """blob, spans of the blobs that have spans. Stored, so that a join with it is one that adaptive execution can split where many documents hold one blob."""
        return stored(self.rows(version).filter(F.size("spans") > 0))

    def scan(self, docs: DataFrame, version: str = VERSION) -> DataFrame:
        """doc_id, blob, spans for every row of ``docs``; only blobs new to the ledger are scanned.

        Null texts are the blob of the empty text. Rows that share a doc_id, or have
        none, are joined by blob, so each gets its own text's findings; repeated rows
        each get a row; an empty table gives none. Other columns are not looked at.
        """
        paths = self.update(docs, version)
        return paths.join(self.found(version), "blob", "left").select("doc_id", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def _text() -> F.Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _address() -> F.Column:
    return F.sha2(_text().cast("binary"), 256)


def joined(spans: F.Column) -> F.Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """The counts and digests of (doc_id, spans)."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(rule[0]) for rule in BASE], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redacted(text: F.Column, spans: F.Column, mark: str = "[secret]") -> F.Column:
    """The text with every stretch that spans cover replaced by the mark; spans that overlap or touch become one stretch."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: F.Column, span: F.Column) -> F.Column:
        fresh = (span["start"] > state["at"]) | (state["out"] == "")
        gap = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"]).alias("out"))

    whole = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.greatest(F.length(text) - s["at"], F.lit(0)))))
    return F.when(F.size(spans) == 0, text).otherwise(whole)


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets redacted and n_chars (where there is one) set to the new length; no row is lost.

    A null or empty text stays as it is, and so does n_chars of a text without a
    secret; repeated rows are redacted each; an empty table gives none. Columns of any
    name are kept. Only texts that may hold a secret are shuffled.
    """
    ledger = Ledger(docs.sparkSession)
    ledger.update(docs)
    found = ledger.found()
    log2 = bitmaps.size_for(found.count())
    bits = bitmaps.bitmap(found.select(F.xxhash64("blob").alias("h")), "h", log2)
    address, flag, blob, spans, clean = fresh(docs.columns, "address", "flag", "blob", "spans", "clean")
    rows = bitmaps.tested(docs.withColumn(address, _address()), F.xxhash64(address), bits, log2, flag)
    names = [F.col(quoted(c)) for c in docs.columns]
    hit = rows.filter(flag).join(found.select(F.col("blob").alias(blob), F.col("spans").alias(spans)), F.col(address) == F.col(blob), "left")
    hit = hit.withColumn(clean, F.when(F.col(spans).isNull(), F.col("text")).otherwise(redacted(F.col("text"), F.col(spans))))
    made = {"text": F.col(clean).alias("text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length(clean)).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return rows.filter(~F.col(flag)).select(*names).union(hit.select(*[made.get(c, F.col(quoted(c))) for c in docs.columns]))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(Ledger(spark).scan(documents(spark, sf_dir, "doc_id", "text")))


def _rule_sql(rank: int, kind: str, pattern: str, group: int, least: int, needs: str | None) -> str:
    """The spans of one rule in SQL: the lengths of what stands between the matches and of the matches, summed up."""
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, {rank} AS rank, '{kind}' AS kind, k, length(whole[k]) AS len, length(gap[k]) AS gap, length(part[k]) >= {least} AS good FROM
 (SELECT doc_id, whole, part, gap, unnest(range(1, len(whole) + 1)) AS k FROM (SELECT doc_id, regexp_extract_all(text, '{quoted}') AS whole, regexp_extract_all(text, '{quoted}', {group}) AS part, regexp_split_to_array(text, '{quoted}') AS gap FROM t))"""


OP4_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(_rule_sql(i, *rule) for i, rule in enumerate(RULES))}),
s AS (SELECT doc_id, rank, kind, good, len, CAST(sum(gap + len) OVER (PARTITION BY doc_id, rank ORDER BY k) AS BIGINT) AS stop FROM m),
g AS (SELECT doc_id, rank, kind, kind || ':' || (stop - len) || ':' || stop AS span, stop - len AS start, stop FROM s WHERE good),
a AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ("assign", "access", "hex"))},
 coalesce(string_agg(span, ',' ORDER BY start, rank, stop) FILTER (rank < 3), '') AS base, string_agg(span, ',' ORDER BY start, rank, stop) AS spans FROM g GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN a USING (doc_id)
"""
