"""Queries of the text records (P18 to P29, C09, A11, A26): the given tables in the shapes of landed notices, articles, alerts, bulletins and graph rows."""

import uuid

from pyspark.sql import functions as F

from gridmill.functions import scalars as S
from gridmill.functions import text as T
from gridmill.functions.user import SqlFunctions
from gridmill.operators import bulletins as B
from gridmill.operators import enrich as C
from gridmill.operators import explore as A
from gridmill.operators import records as R
from gridmill.plans import views as V
from gridmill.plans.registry import query


def _json(column: str) -> str:
    """A text column as JSON text, by the other engine's own writer."""
    return f"coalesce(CAST(to_json({column}) AS VARCHAR), 'null')"


# Messages of conversations as grouped notices: some without a topic, a time, or an absolute link; bodies with tags and entities.
_NOTICES = f"""n AS (SELECT conv_id, turn, CASE WHEN conv_id % 4 = 0 THEN '' ELSE 'Topic ' || (conv_id % 4) END AS topic, text AS subject, 'day ' || turn AS publish_date,
 CASE WHEN turn % 3 <> 0 THEN TIMESTAMP '2024-01-01' + to_hours(CAST(turn AS INTEGER)) END AS at_time, role, CASE WHEN turn % 2 = 0 THEN '/n/' || conv_id || '/' || turn ELSE 'https://other.example/' || turn END AS link FROM conversations)"""


def _notices(spark, sf):
    c = V.table(spark, sf, "conversations")
    text = lambda x: F.col(x).cast("string")
    at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("turn").cast("int"))
    notice = F.struct(
        F.concat_ws("-", text("conv_id"), text("turn")).alias("id"), F.col("text").alias("subject"), F.concat(F.lit("day "), text("turn")).alias("publishDate"), F.when(F.col("turn") % 3 != 0, F.date_format(at, S.ISO + "'Z'")).alias("publishDateUnformatted"),
        F.concat(F.lit("<p>A &eacute; "), "role", F.lit("</p>\t<b>&#8217;x&mdash;</b>")).alias("body"), F.when(F.col("turn") % 2 == 0, F.concat(F.lit("/n/"), text("conv_id"), F.lit("/"), text("turn"))).otherwise(F.concat(F.lit("https://other.example/"), text("turn"))).alias("permanentLinkUrl"),
    )
    topic = F.when(F.col("conv_id") % 4 == 0, "").otherwise(F.concat(F.lit("Topic "), (F.col("conv_id") % 4).cast("string")))
    return c.select("conv_id", topic.alias("topic"), notice.alias("n")).groupBy("conv_id", "topic").agg(F.collect_list("n").alias("notifications"))


@query("std_notices", f"""WITH {_NOTICES} SELECT 'miso:' || sha256('{{"permanent_link": ' || {_json('link')} || ', "publish_date": ' || {_json('publish_date')} || ', "subject": ' || {_json('subject')} || '}}') AS record_id,
 subject AS title, 'A é ' || role || ' ' || chr(9) || ' ’x—' AS text, at_time AS published_at, CASE WHEN turn % 2 = 0 THEN 'https://www.misoenergy.org' ELSE '' END || link AS url, 'MISO' AS region,
 CASE WHEN topic = '' THEN 'market_notice' ELSE 'market_notice|' || topic END AS categories, topic, conv_id || '-' || turn AS notification_id, publish_date FROM n""")
def _(spark, sf):
    m = lambda k: F.col("metadata")[k].alias(k)
    return R.notices(_notices(spark, sf)).select("record_id", "title", "text", "published_at", "url", "region", F.array_join("categories", "|").alias("categories"), m("topic"), m("notification_id"), m("publish_date"))


@query("std_articles", f"""SELECT 'newsapi:' || sha256('{{"url": ' || {_json('url')} || '}}') AS record_id, 'Title ' || page_id AS title,
 'Title ' || page_id || chr(10) || chr(10) || CASE WHEN page_id % 2 = 0 THEN '' ELSE 'd' || chr(10) || chr(10) END || 'c' || page_id AS text, TIMESTAMP '2024-01-01' + to_minutes(CAST(page_id AS INTEGER)) AS published_at, '  ' || url AS url,
 'news' AS categories, 'paper' AS news_source, CASE WHEN page_id % 3 = 0 THEN 'anna' END AS author, 'power' AS query FROM pages WHERE page_id % 7 <> 0 AND page_id % 5 <> 0""")
def _(spark, sf):
    k = F.col("page_id")
    at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=k.cast("int"))
    landed = V.table(spark, sf, "pages").select(
        F.when(k % 7 == 0, " \n").otherwise(F.concat(F.lit("  "), "url")).alias("url"), F.when(k % 5 != 0, F.date_format(at, S.ISO + "'Z'")).alias("publishedAt"), F.concat(F.lit("Title "), k.cast("string")).alias("title"),
        F.when(k % 2 == 0, " \t").otherwise(" d\n").alias("description"), F.concat(F.lit("c"), k.cast("string")).alias("content"), F.when(k % 3 == 0, "anna").alias("author"), F.struct(F.lit("paper").alias("name"), F.lit(None).cast("string").alias("id")).alias("source"),
    )
    m = lambda x: F.col("metadata")[x].alias(x)
    return R.articles(landed, query="power").select("record_id", "title", "text", "published_at", "url", F.array_join("categories", "|").alias("categories"), m("news_source"), m("author"), m("query"))


@query("std_alerts", """WITH a AS (SELECT CASE WHEN event_id % 3 = 0 THEN 'f' || event_id ELSE 'p' || event_id END AS record_id, event_id, event_type, date_trunc('second', ts) AS published_at FROM events WHERE event_id % 11 <> 0)
SELECT record_id, 'Head ' || event_id AS title, 'Head ' || event_id || CASE WHEN event_id % 2 = 0 THEN chr(10) || chr(10) || 'Act' ELSE '' END AS text, published_at, CASE WHEN event_id % 4 = 0 THEN 'https://a.example/' || event_id ELSE 'f' || event_id END AS url,
 'AREA' || (event_id % 2) AS region, CASE WHEN event_type = 'view' THEN 'Severe' ELSE event_type || '|Severe' END AS categories, 'AREA' || (event_id % 2) AS query_area, CASE WHEN event_type <> 'view' THEN event_type ELSE '' END AS event,
 'NWS' AS sender_name, '["z' || (event_id % 5) || '"]' AS affected_zones, 'e' || event_id AS effective_at, 17 AS n_keys FROM a""")
def _(spark, sf):
    k, text = F.col("event_id"), F.col("event_id").cast("string")
    properties = F.struct(
        F.when(k % 3 != 0, F.concat(F.lit("p"), text)).alias("id"), F.when(k % 11 != 0, F.concat(F.date_format("ts", S.ISO), F.lit("Z"))).alias("sent"), F.concat(F.lit("Head "), text).alias("headline"), F.lit(" ").alias("description"), F.when(k % 2 == 0, "Act").alias("instruction"),
        F.when(F.col("event_type") != "view", F.col("event_type")).otherwise("").alias("event"), F.lit("Severe").alias("severity"), F.lit(None).cast("string").alias("urgency"), F.when(k % 4 == 0, F.concat(F.lit("https://a.example/"), text)).alias("@id"),
        F.lit("NWS").alias("senderName"), F.array(F.concat(F.lit("z"), (k % 5).cast("string"))).alias("affectedZones"), F.concat(F.lit("e"), text).alias("effective"),
    )
    landed = V.events(spark, sf).select(F.concat(F.lit("AREA"), (k % 2).cast("string")).alias("query_area"), F.concat(F.lit("f"), text).alias("id"), properties.alias("properties"))
    m = lambda x: F.col("metadata")[x].alias(x)
    return R.alerts(landed).select("record_id", "title", "text", "published_at", "url", "region", F.array_join("categories", "|").alias("categories"), m("query_area"), m("event"), m("sender_name"), m("affected_zones"), m("effective_at"), F.size("metadata").alias("n_keys"))


# Documents as bulletins: two products a response, one of them with a time in its body alone; bodies are the texts' plain words. Stamps come in mixed, lower and upper case.
_OFFICES = ("IND", "MPX", "JAN", "LOT")
_BULLETINS = f"""b AS (SELECT doc_id, {list(_OFFICES)}[1 + doc_id % 4] AS office, [6, 1, 9, NULL][1 + doc_id % 4] AS lrz, 1 + doc_id % 12 AS hh, CAST(doc_id % 60 AS INTEGER) AS mm, doc_id % 2 = 0 AS am,
 trim(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[^a-z]', ' ', 'g'), ' +', ' ', 'g')) AS body FROM documents),
s AS (SELECT *, hh || printf('%02d', mm) || CASE WHEN am THEN ' AM' ELSE ' PM' END || ' EDT Mon Jul 8 2024' AS mixed FROM b),
c AS (SELECT *, CASE doc_id % 3 WHEN 0 THEN mixed WHEN 1 THEN lower(mixed) ELSE upper(mixed) END AS stamp,
 TIMESTAMP '2024-07-08 04:00:00' + to_hours(CAST(hh % 12 + CASE WHEN am THEN 0 ELSE 12 END AS INTEGER)) + to_minutes(mm) AS published_at FROM s)"""


def _bulletins(spark, sf):
    k = F.col("doc_id")
    office = F.get(F.array(*[F.lit(o) for o in _OFFICES]), (k % 4).cast("int"))
    body = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]", " "), " +", " "))
    stamp = F.concat((k % 12 + 1).cast("string"), F.format_string("%02d", k % 60), F.when(k % 2 == 0, " AM").otherwise(" PM"), F.lit(" EDT Mon Jul 8 2024"))
    stamp = F.when(k % 3 == 0, stamp).when(k % 3 == 1, F.lower(stamp)).otherwise(F.upper(stamp))
    office_lines = F.when(k % 5 == 0, "1100 PM EDT Sun Jul 7 2024\nNATIONAL WEATHER SERVICE A\nIssued by National Weather Service B\n").otherwise("National Weather Service A\n")
    head = F.concat(F.lit("000 \r\nFXUS63 K"), office, F.lit(" 081900\r\nAFD"), office, F.lit("\r\n\r\n"))
    sections = F.concat(F.lit("\n\n.SHORT TERM (To \n night)...\nIssued at "), stamp, F.lit("\n\nfirst\n\n\n\n.LONG TERM /A/...\n"), body, F.lit("\n&&\nnot this\n.lower case...\nnor this\n.SHORT TERM...\n"), body, F.lit(" second\n$$\n"))
    response = F.concat(F.lit("before the first heading\n"), head, office_lines, stamp, sections, head, F.lit("1000 AM EDT Mon Jul 8 2024\nNational Weather Service A\n\n1000 AM EDT Mon Jul 8 2024\n"))
    return V.table(spark, sf, "documents").select("doc_id", F.concat(F.lit("AFD"), office).alias("pil"), response.alias("response"))


@query("std_bulletins", f"""WITH {_BULLETINS} SELECT 'iem::' || sha256('{{"issued_code": "081900", "office": "K' || office || '", "pil": "AFD' || office || '", "published_at": "' || strftime(published_at, '%Y-%m-%d %H:%M:%S') || '+00:00", "raw_id": "000", "source": "iem_afos"}}') AS record_id,
 'AFD | K' || office || ' | ' || stamp AS title, published_at, office AS region, CAST(lrz AS VARCHAR) AS lrz, 'FXUS63 K' || office || ' 081900' AS wmo_header, 'weather|nws|iem|afos|afd' AS categories, length(body) AS body_length FROM c""")
def _(spark, sf):
    made = B.standard_bulletins(B.bronze_bulletins(_bulletins(spark, sf), "pil", "response"))
    body = F.regexp_extract("text", r"(?s)\.LONG TERM /A/\.\.\.\n(.*?)\n&&", 1)
    return made.select("record_id", "title", "published_at", "region", F.col("dimensions")["lrz"].alias("lrz"), F.col("metadata")["wmo_header"].alias("wmo_header"), F.array_join("categories", "|").alias("categories"), F.length(body).cast("long").alias("body_length"))


@query("bulletin_products", f"""WITH {_BULLETINS} SELECT 'AFD' || office AS pil, '081900' AS issued_code, stamp AS issued_at_text, published_at, false AS rejected FROM c UNION ALL SELECT 'AFD' || office, '081900', NULL, NULL, true FROM c""")
def _(spark, sf):
    return B.bronze_bulletins(_bulletins(spark, sf), "pil", "response").select("pil", F.col("header.issued_code").alias("issued_code"), "issued_at_text", "published_at", "rejected")


@query("bulletin_sections", f"""WITH {_BULLETINS} SELECT doc_id, 'SHORT TERM' AS section, NULL::VARCHAR AS detail, trim(body || ' second') AS section_text FROM c UNION ALL SELECT doc_id, 'LONG TERM', 'A', body FROM c""")
def _(spark, sf):
    return B.parse_sections(_bulletins(spark, sf), "doc_id", "response").select("doc_id", "section", "detail", "section_text")


@query("office_zones", f"WITH {_BULLETINS} SELECT office, CAST(lrz AS INTEGER) AS lrz, count(*) AS n FROM c GROUP BY ALL")
def _(spark, sf):
    b = _bulletins(spark, sf).select(F.substring("pil", 4, 3).alias("office"))
    return b.join(F.broadcast(B.load_zones(spark)), "office", "left").groupBy("office", "lrz").agg(F.count("*").alias("n"))


# Parts as knowledge-graph rows.
_GRAPH = """g AS (SELECT 'g' || p_partkey AS id, CASE WHEN p_size % 5 = 0 THEN 'bad' ELSE '202405011200' || printf('%02d', p_size) END AS date_text, p_size, p_name, p_brand, p_type, p_partkey FROM part)"""


def _graph(spark, sf):
    size = F.col("p_size")
    extras = F.concat(F.lit("<PAGE_TITLE> "), "p_name", F.lit(" </PAGE_TITLE>"), F.when(size % 3 == 0, F.concat(F.lit("<PAGE_PRECISEPUBTIMESTAMP>202404300000"), F.format_string("%02d", size), F.lit("</PAGE_PRECISEPUBTIMESTAMP>"))).otherwise(""))
    return V.table(spark, sf, "part").select(
        F.when(size % 7 == 0, " ").otherwise(F.concat(F.lit("g"), F.col("p_partkey").cast("string"))).alias("GKGRECORDID"), F.when(size % 5 == 0, "bad").otherwise(F.concat(F.lit("202405011200"), F.format_string("%02d", size))).alias("DATE"), F.col("p_brand").alias("SourceCommonName"), F.col("p_name").alias("DocumentIdentifier"),
        F.replace("p_type", F.lit(" "), F.lit(";")).alias("Themes"), F.concat(F.lit("1#n#us#"), F.when(size % 2 == 0, "mn").otherwise("")).alias("Locations"), F.lit("P1;P2").alias("Persons"), F.lit(None).cast("string").alias("Organizations"), F.lit("1.5,2").alias("Tone"), extras.alias("Extras"),
    )


@query("std_news_graph", f"""WITH {_GRAPH} SELECT 'gdelt::' || id AS record_id, trim(p_name) AS title, CASE WHEN p_size % 3 = 0 THEN strptime('202404300000' || printf('%02d', p_size), '%Y%m%d%H%M%S') ELSE strptime(date_text, '%Y%m%d%H%M%S') END AS published_at, p_name AS url,
 CASE WHEN p_size % 2 = 0 THEN 'MN' ELSE 'US' END AS region, replace(p_type, ' ', '|') AS categories, CASE WHEN p_size % 3 = 0 THEN 'second' ELSE '15min' END AS time_precision, 'P1|P2' AS persons FROM g WHERE p_size % 7 <> 0 AND (p_size % 3 = 0 OR p_size % 5 <> 0)""")
def _(spark, sf):
    return R.news_graph_records(_graph(spark, sf)).select("record_id", "title", "published_at", "url", "region", F.array_join("categories", "|").alias("categories"), F.col("metadata.time_precision").alias("time_precision"), F.array_join("metadata.persons", "|").alias("persons"))


@query("clean_rows", "SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN value END AS value, event_type FROM events WHERE event_id % 9 <> 0")
def _(spark, sf):
    e = V.events(spark, sf).select("event_id", F.when(F.col("event_id") % 4 == 0, float("nan")).otherwise(F.col("value")).alias("value"), F.when(F.col("event_id") % 9 == 0, " ").otherwise(F.col("event_type")).alias("event_type"))
    return S.clean_row(e, "event_type")[0]


@query("normalize_unicode", "SELECT doc_id, text || CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'five 1' END AS text FROM documents")
def _(spark, sf):
    odd = F.when(F.col("doc_id") % 2 == 0, "").otherwise("ﬁve ①")
    return V.table(spark, sf, "documents").select("doc_id", T.normalize_unicode(F.concat("text", odd)).alias("text"))


@query("decode_entities", "SELECT page_id, 'é—’&<' || page_id || '>' || chr(160) || '&bad;' AS text FROM pages")
def _(spark, sf):
    coded = F.concat(F.lit("&eacute;&mdash;&#8217;&amp;&lt;"), F.col("page_id").cast("string"), F.lit("&gt;&nbsp;&bad;"))
    return V.table(spark, sf, "pages").select("page_id", T.decode_entities(coded).alias("text"))


@query("publish_time", """SELECT page_id, CASE WHEN page_id % 4 = 3 THEN NULL ELSE TIMESTAMP '2024-05-01' + to_minutes(CAST(page_id AS INTEGER)) - CASE WHEN page_id % 4 = 1 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END END AS published_at,
 CASE WHEN page_id % 4 = 3 THEN '2024-05-09' ELSE strftime(TIMESTAMP '2024-05-01' + to_minutes(CAST(page_id AS INTEGER)) - CASE WHEN page_id % 4 = 1 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END, '%Y-%m-%d') END AS date, 'Ann & Co ' || page_id AS author FROM pages""")
def _(spark, sf):
    k = F.col("page_id")
    stamp = F.date_format(F.lit("2024-05-01").cast("timestamp") + F.make_dt_interval(mins=k.cast("int")), S.ISO)
    tag = (F.when(k % 4 == 0, F.concat(F.lit('<meta content="'), stamp, F.lit('Z" property="article:published_time">'))).when(k % 4 == 1, F.concat(F.lit("<meta name='pubdate' content='"), stamp, F.lit("+02:00'>")))
        .when(k % 4 == 2, F.concat(F.lit("<time class=x datetime='"), stamp, F.lit("Z'>then</time>"))).otherwise('<meta name="date" content="2024-05-09">'))
    author = F.when(k % 2 == 0, F.concat(F.lit('<meta name="author" content="Ann &amp; Co '), k.cast("string"), F.lit('">'))).otherwise(F.concat(F.lit('<span class="small byline">By <b>Ann</b> &amp; Co '), k.cast("string"), F.lit("</span>")))
    html = F.concat(tag, author, F.col("html"))
    page = V.table(spark, sf, "pages").select("page_id", C.publish_time(html).alias("published_at"), C.extract_article(html).alias("a"))
    return page.select("page_id", "published_at", "a.date", "a.author")


_PLACES = "l AS (SELECT p_partkey, [CAST(1 + p_size % 4 AS VARCHAR), replace(p_brand, '#', ''), 'C' || (p_size % 3), CASE WHEN p_size % 2 = 0 THEN 'A' END] AS parts FROM part)"


def _places(spark, sf):
    size = F.col("p_size")
    item = F.concat_ws("#", (size % 4 + 1).cast("string"), F.replace("p_brand", F.lit("#"), F.lit("")), F.concat(F.lit("C"), (size % 3).cast("string")), F.when(size % 2 == 0, "A").otherwise(" "))
    return A.location_parts(V.table(spark, sf, "part").select("p_partkey", F.concat(item, F.lit("; ;")).alias("l")), "p_partkey", "l")


@query("location_parts", f"WITH {_PLACES} SELECT p_partkey, parts[1] AS type, parts[2] AS name, parts[3] AS country, parts[4] AS adm1, NULL::VARCHAR AS feature_id FROM l")
def _(spark, sf):
    return _places(spark, sf).select("p_partkey", "type", "name", "country", "adm1", "feature_id")


@query("location_shares", f"WITH {_PLACES} SELECT parts[3] AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM l), 6) AS share FROM l GROUP BY 1")
def _(spark, sf):
    return A.location_shares(_places(spark, sf), "country").withColumn("share", F.round("share", 6))


@query("city_counts", f"WITH {_PLACES} SELECT parts[2] AS name, count(*) AS n FROM l WHERE parts[3] = 'C1' AND parts[1] IN ('3', '4') GROUP BY 1")
def _(spark, sf):
    return A.city_counts(_places(spark, sf), "C1")


@query("key_set_counts", "SELECT CASE WHEN event_id % 3 = 0 THEN 'a,b' WHEN event_id % 3 = 1 THEN 'b' ELSE '' END AS keys, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    k = F.col("event_id") % 3
    m = F.when(k == 0, F.create_map(F.lit("b"), F.lit("1"), F.lit("a"), F.lit("2"))).when(k == 1, F.create_map(F.lit("b"), F.lit("1"))).otherwise(F.create_map().cast("map<string,string>"))
    return A.key_set_counts(V.table(spark, sf, "events").select(m.alias("m")), "m")


def _functions(spark):
    """The session's user functions, under names of this call's own."""
    return SqlFunctions(spark), f"u{uuid.uuid4().hex[:12]}"


@query("user_parser", "SELECT p_partkey, CAST(i - 1 AS INTEGER) AS at, string_split(p_name, ' ')[i] AS word FROM part, range(1, 50) t(i) WHERE i <= len(string_split(p_name, ' '))")
def _(spark, sf):
    functions, name = _functions(spark)

    def words(text):
        for i, word in enumerate((text or "").split(" ")):
            yield {"word": word, "at": i}

    functions.parser(name, words, "at int, word string")
    V.table(spark, sf, "part").select("p_partkey", "p_name").createOrReplaceTempView(f"{name}_part")
    return spark.sql(f"SELECT p_partkey, w.at, w.word FROM {name}_part, LATERAL {name}(p_name) w")


@query("user_aggregate", "SELECT event_type, round(max(value) - min(value), 6) AS spread FROM events GROUP BY 1")
def _(spark, sf):
    functions, name = _functions(spark)
    functions.aggregate(name, lambda column: float(column.max() - column.min()), "double")
    V.events(spark, sf).createOrReplaceTempView(f"{name}_events")
    return spark.sql(f"SELECT event_type, round({name}(value), 6) AS spread FROM {name}_events GROUP BY event_type")


@query("user_table_function", "SELECT date_trunc('hour', ts) AS observed_at, event_type, count(*) AS n, count(*) FILTER (value >= 70) AS severe FROM events GROUP BY ALL HAVING count(*) FILTER (value >= 70) > 0")
def _(spark, sf):
    functions, name = _functions(spark)
    V.events(spark, sf).createOrReplaceTempView(f"{name}_events")
    functions.table(name, "least DOUBLE", "observed_at TIMESTAMP, event_type STRING, n BIGINT, severe BIGINT", f"SELECT hour, event_type, count(*), count_if(severe) FROM (SELECT date_trunc('hour', ts) AS hour, event_type, value >= {name}.least AS severe FROM {name}_events) GROUP BY hour, event_type")
    return spark.sql(f"SELECT * FROM {name}(70.0D) WHERE severe > 0")
