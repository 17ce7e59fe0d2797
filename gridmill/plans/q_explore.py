"""Queries of the exploration and vector operators (A, E)."""

from pyspark.sql import functions as F

from gridmill.functions import scalars as S
from gridmill.operators import dedupe as D
from gridmill.operators import explore as A
from gridmill.operators import vectors as E
from gridmill.plans import views as V
from gridmill.plans.registry import query, shared
from gridmill.sources.cells import CellIndex, recall


def _r(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


@query("value_counts_topn", "SELECT source AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share FROM documents GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
def _(spark, sf):
    return _r(A.value_counts(V.table(spark, sf, "documents"), "source", 10), "share", places=6)


@query("null_fraction", "SELECT 'lang' AS column_name, avg(CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END)::DOUBLE AS null_fraction FROM documents UNION ALL SELECT 'doc_id', 0.0::DOUBLE")
def _(spark, sf):
    return A.null_fraction(V.table(spark, sf, "documents").select("doc_id", F.nullif("lang", F.lit("en")).alias("lang")))


@query("dup_rate", "SELECT CAST(count(*) AS BIGINT) AS n, count(DISTINCT text) AS n_distinct, round(1 - count(DISTINCT text) / count(*), 6) AS dup_rate FROM documents")
def _(spark, sf):
    return _r(A.duplicate_rate(V.table(spark, sf, "documents"), "text"), "dup_rate", places=6)


@query("dup_members", "SELECT doc_id, group_size FROM (SELECT doc_id, count(*) OVER (PARTITION BY text) AS group_size FROM documents) WHERE group_size > 1")
def _(spark, sf):
    return A.duplicate_members(V.table(spark, sf, "documents").select("doc_id", "text"), "text").select("doc_id", "group_size")


@query("describe_by_group", """SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
 round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max FROM events GROUP BY 1""")
def _(spark, sf):
    return _r(A.describe(V.table(spark, sf, "events"), "value", "event_type"), "mean", "std", "p25", "p50", "p75")


@query("word_counts", r"SELECT unnest(regexp_extract_all(lower(p_type), '\b[a-z]+\b')) AS word, count(*) AS n FROM part GROUP BY 1")
def _(spark, sf):
    return A.word_counts(V.table(spark, sf, "part"), "p_type")


@query("daily_counts", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    return V.events(spark, sf).groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))


@query("date_region_matrix", f"WITH {V.DOCS} SELECT CAST(published_at AS DATE) AS day, " + ", ".join(f"count(*) FILTER (region = '{x}') AS {x}" for x in ("en", "de", "fr", "es")) + " FROM docs GROUP BY 1")
def _(spark, sf):
    return A.counts_matrix(V.docs(spark, sf), F.to_date("published_at"), "day", "region", ["en", "de", "fr", "es"])


@query("json_field_counts", "SELECT props->>'$.k' AS field_value, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    return A.json_field_counts(V.table(spark, sf, "events"), "props", "k")


TERMS = ["license", "the ", "idiot"]


@query("keyword_hits", " UNION ALL ".join(f"SELECT '{t}' AS term, count(*) FILTER (contains(lower(text), '{t}')) AS n FROM documents" for t in TERMS))
def _(spark, sf):
    return A.keyword_hits(V.table(spark, sf, "documents"), "text", TERMS)


@query("monthly_flag_rate", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, round(avg(CASE WHEN regexp_matches(o_orderpriority, '(?i)urgent|high') THEN 1.0 ELSE 0.0 END), 6) AS rate FROM orders GROUP BY 1")
def _(spark, sf):
    flag = F.col("o_orderpriority").rlike("(?i)urgent|high").cast("double")
    return V.table(spark, sf, "orders").groupBy(F.date_trunc("month", "o_orderdate").cast("date").alias("month")).agg(F.round(F.avg(flag), 6).alias("rate"))


@query("explode_counts", "SELECT unnest(string_split(p_type, ' ')) AS item, count(*) AS n FROM part GROUP BY 1")
def _(spark, sf):
    return A.explode_counts(V.table(spark, sf, "part"), S.split_values(F.col("p_type"), " "))


@query("bridge_distinct", "SELECT DISTINCT p_brand, unnest(string_split(p_type, ' ')) AS word FROM part")
def _(spark, sf):
    return A.bridge(V.table(spark, sf, "part"), "p_brand", S.split_values(F.col("p_type"), " "), "word")


@query("semi_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def _(spark, sf):
    ids = V.table(spark, sf, "orders").filter("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return V.table(spark, sf, "customer").join(ids, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("regex_filter", r"SELECT p_partkey, p_type FROM part WHERE regexp_matches(lower(p_type), '\b(promo|small)\b')")
def _(spark, sf):
    return V.table(spark, sf, "part").filter(A.matches_any(F.col("p_type"), ["promo", "Small"])).select("p_partkey", "p_type")


@query("url_keywords", "SELECT page_id, contains(lower(url), '/fr/') OR contains(lower(url), 'page=2') AS hit FROM pages")
def _(spark, sf):
    return V.table(spark, sf, "pages").select("page_id", A.any_term(F.col("url"), ["/fr/", "page=2"]).alias("hit"))


@query("relevance_score", "SELECT p_partkey, CAST(p_size > 20 AS INTEGER) + CAST(contains(p_type, 'PROMO') AS INTEGER) + CAST(p_retailprice > 1000 AS INTEGER) AS score FROM part WHERE p_brand <> 'Brand#11'")
def _(spark, sf):
    flags = [F.col("p_size") > 20, F.col("p_type").contains("PROMO"), F.col("p_retailprice") > 1000]
    return V.table(spark, sf, "part").filter("p_brand <> 'Brand#11'").select("p_partkey", A.relevance_score(*flags).alias("score"))


@query("deny_list_filter", "SELECT min(doc_id) AS doc_id, text FROM documents WHERE source NOT IN ('src0', 'src1') AND lang IN ('en', 'de') GROUP BY text")
def _(spark, sf):
    d = V.table(spark, sf, "documents").filter(~F.col("source").isin("src0", "src1") & F.col("lang").isin("en", "de"))
    return D.dedupe(d.select("doc_id", "text"), ["text"], "doc_id", "first")


_SLUG = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(rtrim(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/'), '([^/]*)$', 1), '\.[A-Za-z0-9]+$', ''), '[-_+]+', ' ', 'g'), '\b\d{5,}\b', '', 'g'), '\s+', ' ', 'g'))"""


@query("title_from_url", f"SELECT page_id, array_to_string(list_transform(string_split({_SLUG}, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS title FROM pages")
def _(spark, sf):
    return V.table(spark, sf, "pages").select("page_id", S.title_from_url(F.col("url")).alias("title"))


@query("hash_sample")
def _(spark, sf):
    return A.hash_sample(V.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 100)


@query("resample_daily", """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, avg(value) AS m, count(value) AS n FROM events GROUP BY ALL), b AS (SELECT user_id, min(day) AS a, max(day) AS z FROM d GROUP BY 1),
g AS (SELECT user_id, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM b) SELECT user_id, day, round(m, 6) AS mean, coalesce(n, 0) AS n FROM g LEFT JOIN d USING (user_id, day)""")
def _(spark, sf):
    return _r(A.resample_daily(V.events(spark, sf), "ts", "value", "user_id"), "mean")


_DAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]


@query("weekday_hour_profile", "SELECT CAST(extract(hour FROM ts) AS INTEGER) AS hour, " + ", ".join(f"round(avg(value) FILTER (isodow(ts) = {i + 1}), 6) AS {d}" for i, d in enumerate(_DAYS)) + " FROM events GROUP BY 1")
def _(spark, sf):
    return _r(A.weekday_hour_profile(V.events(spark, sf), "ts", "value"), *_DAYS)


@query("interpolate_hourly", """WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, avg(value) AS known FROM events GROUP BY ALL), b AS (SELECT event_type, min(hour) AS a, max(hour) AS z FROM h GROUP BY 1),
g AS (SELECT event_type, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS hour FROM b), j AS (SELECT g.event_type, g.hour, known, CASE WHEN known IS NOT NULL THEN g.hour END AS kh FROM g LEFT JOIN h USING (event_type, hour)),
w AS (SELECT *, last_value(known IGNORE NULLS) OVER p AS pv, last_value(kh IGNORE NULLS) OVER p AS pt, first_value(known IGNORE NULLS) OVER n AS nv, first_value(kh IGNORE NULLS) OVER n AS nt FROM j
 WINDOW p AS (PARTITION BY event_type ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS (PARTITION BY event_type ORDER BY hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_type, hour, round(coalesce(known, pv + (nv - pv) * (epoch(hour) - epoch(pt)) / (epoch(nt) - epoch(pt))), 6) AS value, known IS NULL AS filled FROM w""")
def _(spark, sf):
    return _r(A.interpolate_hourly(V.events(spark, sf), "ts", "value", ["event_type"]), "value")


_SPECTRUM = """WITH h AS (SELECT CAST(epoch(date_trunc('hour', ts)) / 3600 AS DOUBLE) AS t, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS x FROM events GROUP BY 1), o AS (SELECT t - min(t) OVER () AS t, x FROM h),
l AS (SELECT regr_slope(x, t) AS b, regr_intercept(x, t) AS a, count(*) AS n FROM o), r AS (SELECT t, x - a - b * t AS x, n FROM o, l)
SELECT p.period, round(2 * (sum(x * cos(t * (2 * pi() / period))) ** 2 + sum(x * sin(t * (2 * pi() / period))) ** 2) / (n * n), 3) AS power FROM r, (SELECT unnest([12.0, 24.0, 168.0])::DOUBLE AS period) p GROUP BY p.period, n"""


@query("spectral_power", _SPECTRUM)
def _(spark, sf):
    h = V.events(spark, sf).groupBy((F.unix_timestamp(F.date_trunc("hour", "ts")) / 3600).alias("t")).agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("x"))
    first = h.agg(F.min("t").alias("t0"))
    series = h.join(F.broadcast(first)).select((F.col("t") - F.col("t0")).alias("t"), "x")
    return _r(A.spectral_power(series, "t", "x", [12.0, 24.0, 168.0]), "power", places=3)


@query("segment_events", """WITH s AS (SELECT conv_id, turn, text, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS segment FROM conversations)
SELECT conv_id, CAST(segment AS BIGINT) AS segment, count(*) AS n_lines, string_agg(text, chr(10) ORDER BY turn) AS event_text FROM s WHERE segment > 0 GROUP BY ALL""")
def _(spark, sf):
    return A.segment_events(V.table(spark, sf, "conversations"), "conv_id", "turn", F.col("role") == "user", "text")


@query("embedding_text", f"WITH {V.DOCS} SELECT doc_id, concat_ws(chr(10) || chr(10), record_id, nullif(trim(CASE WHEN doc_id % 2 = 0 THEN ' ' ELSE text END, ' '), '')) AS embedding_text FROM docs")
def _(spark, sf):
    return V.docs(spark, sf).select("doc_id", E.embedding_text(F.col("record_id"), F.when(F.col("doc_id") % 2 == 0, " ").otherwise(F.col("text"))).alias("embedding_text"))


@query("embed_select", "SELECT max(doc_id) AS doc_id, text FROM documents WHERE trim(text) <> '' GROUP BY text HAVING text NOT IN (SELECT text FROM documents JOIN labels USING (doc_id))")
def _(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    stored = d.join(V.table(spark, sf, "labels"), "doc_id").select("text")
    return E.select_to_embed(d, stored, "text", "doc_id", "text")


@query("embed_hashing")
def _(spark, sf):
    return E.hashing_vectors(V.table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")


@query("embed_status", "SELECT source, CASE WHEN count(*) FILTER (lang <> 'es') = 0 THEN 'empty' WHEN count(*) FILTER (lang = 'de') = 0 THEN 'up_to_date' ELSE 'success' END AS status FROM documents GROUP BY 1")
def _(spark, sf):
    per = V.table(spark, sf, "documents").groupBy("source").agg(F.count_if(F.col("lang") != "es").alias("t"), F.count_if(F.col("lang") == "de").alias("f"))
    return per.select("source", E.embed_status(F.col("t"), F.col("f")).alias("status"))


NEAREST = """WITH p AS (SELECT q.vec_id AS query, b.vec_id AS match, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s FROM embeddings q JOIN embeddings b ON q.vec_id <> b.vec_id WHERE q.vec_id % 50 = 0)
SELECT query, match, CAST(rank AS INTEGER) AS rank, round(s, 5) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY s DESC, match) AS rank FROM p) WHERE rank <= 5"""


@query("cosine_topk", NEAREST)
def _(spark, sf):
    e = V.table(spark, sf, "embeddings")
    return _r(E.cosine_topk(e.filter("vec_id % 50 = 0"), e, "vec_id", "embedding", 5), "similarity", places=5).select("query", "match", "rank", "similarity")


def _cells(spark, e):
    """A new index of the embeddings, in two runs."""
    index = CellIndex(spark, shared(spark), "vec_id", buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    index.fit(e, "embedding")
    for run in (0, 1):
        index.add(e.filter(F.pmod(F.xxhash64("vec_id"), F.lit(2)) == run), "embedding", run)
    return index


@query("cell_topk_exact", NEAREST)
def _(spark, sf):
    e = V.table(spark, sf, "embeddings")
    return _r(_cells(spark, e).search(e.filter("vec_id % 50 = 0"), "embedding", 5, exact=True), "similarity", places=5).select("query", "match", "rank", "similarity")


@query("cell_recall")
def _(spark, sf):
    e = V.table(spark, sf, "embeddings")
    queries = e.filter("vec_id % 50 = 0")
    index = _cells(spark, e)
    found = index.search(queries, "embedding", 5, index.calibrate(e, "embedding", 5))
    return recall(found, E.cosine_topk(queries, e, "vec_id", "embedding", 5))


@query("pca_project")
def _(spark, sf):
    return E.pca(V.table(spark, sf, "embeddings"), "embedding").select("vec_id", "projection")


@query("kmeans_sizes")
def _(spark, sf):
    return E.kmeans(V.table(spark, sf, "embeddings"), "embedding", 12)[0].groupBy("cluster").agg(F.count("*").alias("n"))


@query("topn_per_group", "SELECT label, vec_id, CAST(rn AS INTEGER) AS rn FROM (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings) WHERE rn <= 3")
def _(spark, sf):
    return D.numbered(V.table(spark, sf, "embeddings"), ["label"], "vec_id").filter("rn <= 3").select("label", "vec_id", "rn")
