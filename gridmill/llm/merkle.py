"""Merkle manifest of a dataset by nested roll-ups of ranked rows, in DataFrame functions only.

Rows become leaves, ranked within their group. A rank is a block number and three digits
of four bits; digit by digit the last column is grouped away, and what was grouped nests
as a struct of children with the hashes of the four tree levels between. A block holds
``BLOCK`` leaves at most, so no row grows beyond that, whatever the group's size. Block
roots are leaves of the next round, until a round has one block a group; the groups'
roots are ranked and rolled up in the same way.

A block's way up to the root is worked out on one row a block and put beside the nested
block once. From there on nothing is joined: transforms take the siblings out of the
nested levels and explodes give every leaf its proof.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmill.llm.common import documents, stored

#: Bits of a digit, digits of a block's ranks, leaves of a block.
BITS, DIGITS = 4, 3
BLOCK = 1 << (BITS * DIGITS)
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

STEP = "struct<before: string, after: string>"
PATH = f"array<{STEP}>"


def digest(*parts: F.Column) -> F.Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: F.Column) -> F.Column:
    """A value as ``-`` if null, else its UTF-8 length, a colon, and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(**changed: F.Column) -> F.Column:
    """The digest of a row's fields; ``changed`` stands in for some of them."""
    return digest(*[field(changed.get(c, F.col(c))) for c in FIELDS])


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` (stored by this) with ``rank`` from 0 in their group and the group's size ``n``.

    Rows are sorted by range, so that tasks hold slices and no task a group; the slices'
    counts, one row for each slice and group, are summed up.
    """
    placed = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("place", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("slice", F.shiftright("place", 33)))
    counts = placed.groupBy("slice", group).agg(F.count("*").alias("c"), F.min("place").alias("first"))
    before = Window.partitionBy(group).orderBy("slice")
    offsets = counts.select("slice", group, "first", (F.sum("c").over(before) - F.col("c")).alias("offset"), F.sum("c").over(Window.partitionBy(group)).alias("n"))
    return placed.join(offsets, ["slice", group]).select(*rows.columns, (F.col("place") - F.col("first") + F.col("offset")).alias("rank"), "n")


def _halved(nodes: F.Column, goes_on: F.Column) -> F.Column:
    """The digests of every two consecutive nodes, the last maybe alone; the nodes themselves where the tree has ended."""
    pairs = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(nodes) - 1, 1)), lambda i: digest(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))))
    return F.when(goes_on, pairs).otherwise(nodes)


def _nested(leaves: DataFrame, payload: list[str]) -> DataFrame:
    """One row a block: g, block, n, root, d0 .. and levels, the children nested. From (g, rank, n, hash) and the payload's columns."""
    digit = lambda k: F.shiftright("rank", BITS * k).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int").alias(f"digit{k}")
    block = F.shiftright("rank", BITS * DIGITS).alias("block")
    # Partitioned by block once; the roll-ups need no further exchange.
    rows = leaves.select("g", block, "n", *[digit(k) for k in range(DIGITS)], "hash", *payload).repartition("g", "block")
    depth = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
    child = ["hash", *payload]
    for k in range(DIGITS):
        rest = ["g", "block", "n", *[f"digit{j}" for j in range(k + 1, DIGITS)]]
        rows = rows.groupBy(*rest).agg(F.array_sort(F.collect_list(F.struct(f"digit{k}", *child))).alias("kids"))
        rows = rows.withColumn("level0", F.transform("kids", lambda c: c["hash"]))
        for t in range(BITS):
            rows = rows.withColumn(f"level{t + 1}", _halved(F.col(f"level{t}"), depth > BITS * k + t))
        rows = rows.withColumn("hash", F.get(f"level{BITS}", 0)).drop(f"level{BITS}")
        child = ["hash", "kids", *[f"level{t}" for t in range(BITS)]]
    return rows.withColumnRenamed("hash", "root")


def _steps(at: F.Column, depth: F.Column, k: int) -> F.Column:
    """The steps up from child number ``at`` through the levels of digit k, from the columns level0, level1, ..."""

    def step(t: int) -> F.Column:
        own = F.shiftright(at, t)
        left = F.when(own.bitwiseAND(F.lit(1)) == 1, F.get(f"level{t}", own - 1)).otherwise("")
        right = F.when(own.bitwiseAND(F.lit(1)) == 0, F.coalesce(F.get(f"level{t}", own + 1), F.lit(""))).otherwise("")
        return F.when(depth > BITS * k + t, F.struct(left.alias("before"), right.alias("after")))

    return F.filter(F.array(*[step(t) for t in range(BITS)]), lambda s: s.isNotNull())


def _unfolded(blocks: DataFrame, payload: list[str], carried: list[str]) -> DataFrame:
    """g, rank, hash, path, the payload and the blocks' carried columns of every leaf: the nested digits exploded, each with its steps before those above."""
    depth = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
    rows = blocks.withColumn("rank", F.col("block"))
    for k in reversed(range(DIGITS)):
        keep = ["g", "n", *carried]
        # One explode of what a child needs; the levels and the siblings' own children stay behind.
        rows = rows.select(*keep, "rank", "path", *[f"level{t}" for t in range(BITS)], F.posexplode("kids").alias("at", "kid"))
        rows = rows.select(*keep, (F.col("rank") * (1 << BITS) + F.col("at")).alias("rank"), F.concat(_steps(F.col("at"), depth, k), F.col("path")).alias("path"), "kid.*")
    return rows.select("g", "rank", "hash", "path", *payload, *carried)


def proofs(leaves: DataFrame, payload: list[str], above: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """g, rank, hash, path, top and the payload of every leaf; ``path`` leads from the leaf to its group's root ``top``.

    ``leaves`` has g (a string), rank, n, hash and the payload. ``above`` is a function
    of the groups' roots (g, n, hash) that gives (g, path, more columns): the way on from
    there; its columns are carried to every leaf.
    """
    blocks = stored(_nested(leaves, payload))
    heads = blocks.select("g", F.col("block").alias("rank"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("root").alias("hash"))
    carried = ["top"]
    if heads.filter("n > 1").isEmpty():
        up = heads.select("g", "rank", F.array().cast(PATH).alias("path"), F.col("hash").alias("top"))
    else:
        up = proofs(heads, []).select("g", "rank", "path", "top")
    if above is not None:
        roots = stored(up.filter("rank = 0").select("g", F.col("top").alias("hash")))
        way = above(roots).withColumnRenamed("path", "way")
        carried += [c for c in way.columns if c not in ("g", "way")]
        up = up.join(way, "g").withColumn("path", F.concat("path", "way")).drop("way")
    return _unfolded(blocks.drop("root").join(up.withColumnRenamed("rank", "block"), ["g", "block"]), payload, carried)


def folded(start: F.Column, path: F.Column) -> F.Column:
    """What the steps of a path make of a digest."""
    return F.aggregate(path, start, lambda acc, s: digest(s["before"], acc, s["after"]))


def _group() -> F.Column:
    """lang as a key that sorts null first and is never null."""
    return F.coalesce(F.concat(F.lit("+"), F.col("lang")), F.lit(""))


def tampered_with() -> F.Column:
    """Whether 7 divides the CRC-32 of the decimal doc_id; a null id is left alone."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves of a language ascend by doc_id, a null id first; rows that repeat an id go by
    their leaves, and equal rows are leaves each, whose proofs differ as their places do.
    Null and empty texts are fields like others; a text of any length is hashed in one
    go. An empty table gives no row and a single row is its own root. Extra columns are
    not looked at.
    """
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    rows = docs.select(*FIELDS).select("doc_id", _group().alias("g"), leaf().alias("hash"), F.when(tampered_with(), leaf(n_chars=more)).alias("forged"))
    leaves = ranked(rows, "g", ["doc_id", "hash"])

    def above(roots: DataFrame) -> DataFrame:
        tops = ranked(roots.select(F.lit("").alias("g"), F.col("g").alias("lang"), "hash"), "g", ["lang"])
        return proofs(tops, ["lang"]).select(F.col("lang").alias("g"), "path", F.col("top").alias("root"))

    found = proofs(leaves, ["doc_id", "forged"], above)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    out = found.select("doc_id", F.col("hash").alias("leaf"), F.col("top").alias("subroot"), "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), folded(F.coalesce("forged", "hash"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir, *FIELDS))


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR) END"
_ROW = " || ".join(_FIELD.format(c) for c in FIELDS)
_FORGED = " || ".join(_FIELD.format("(n_chars + 1)" if c == "n_chars" else c) for c in FIELDS)

OP12_SQL = f"""
WITH RECURSIVE c AS (SELECT *, list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
  lambda i: [ascii(CAST(doc_id AS VARCHAR)[i])::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, 3988292384::UBIGINT * (xor(a, x) & 1))) AS crc FROM documents),
leaves AS (SELECT doc_id, lang, sha256({_ROW}) AS leaf, CASE WHEN xor(crc, 4294967295::UBIGINT) % 7 = 0 THEN sha256({_FORGED}) ELSE sha256({_ROW}) END AS start,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n FROM c),
tree AS (SELECT lang, 0 AS l, r AS i, n, leaf AS h FROM leaves
  UNION ALL SELECT lang, l + 1, i, n, sha256(string_agg(h, '' ORDER BY j)) FROM (SELECT lang, l, i // 2 AS i, i AS j, (n + 1) // 2 AS n, h FROM tree WHERE n > 1) GROUP BY lang, l, i, n),
tops AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM tree WHERE n = 1),
high AS (SELECT 0 AS l, r AS i, n, subroot AS h FROM tops
  UNION ALL SELECT l + 1, i, n, sha256(string_agg(h, '' ORDER BY j)) FROM (SELECT l, i // 2 AS i, i AS j, (n + 1) // 2 AS n, h FROM high WHERE n > 1) GROUP BY l, i, n),
low_steps AS (SELECT x.doc_id, x.lang, t.l, CASE WHEN (x.r >> t.l) & 1 = 1 THEN 'L' ELSE 'R' END AS side, coalesce(s.h, '') AS sib
  FROM leaves x JOIN (SELECT DISTINCT lang, l FROM tree WHERE n > 1) t ON t.lang IS NOT DISTINCT FROM x.lang LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM x.lang AND s.l = t.l AND s.i = xor(x.r >> t.l, 1)),
low AS (SELECT doc_id, list(side || sib ORDER BY l) AS path FROM low_steps GROUP BY doc_id),
high_steps AS (SELECT x.lang, t.l, CASE WHEN (x.r >> t.l) & 1 = 1 THEN 'L' ELSE 'R' END AS side, coalesce(s.h, '') AS sib
  FROM tops x, (SELECT DISTINCT l FROM high WHERE n > 1) t LEFT JOIN high s ON s.l = t.l AND s.i = xor(x.r >> t.l, 1)),
hi AS (SELECT lang, list(side || sib ORDER BY l) AS path FROM high_steps GROUP BY lang),
paths AS (SELECT x.doc_id, x.leaf, x.start, tops.subroot, (SELECT h FROM high WHERE n = 1) AS root, list_concat(coalesce(low.path, []), coalesce(hi.path, [])) AS path
  FROM leaves x JOIN tops ON tops.lang IS NOT DISTINCT FROM x.lang LEFT JOIN low ON low.doc_id = x.doc_id LEFT JOIN hi ON hi.lang IS NOT DISTINCT FROM x.lang),
f AS (SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda p: p[2:]), '')) AS proof_sha256,
  list_reduce(list_prepend(start, path), lambda a, p: sha256(CASE WHEN p[1] = 'L' THEN p[2:] || a ELSE a || p[2:] END)) AS folded_root FROM paths)
SELECT *, folded_root = root AS verified FROM f
"""
