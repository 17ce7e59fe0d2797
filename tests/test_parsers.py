"""Parsers and shapers on small literal inputs."""

import hashlib
import html
import json
import re
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridmill.functions import scalars as S
from gridmill.functions import text as T
from gridmill.operators import bulletins as B
from gridmill.operators import enrich as C
from gridmill.operators import explore as A
from gridmill.operators import records as R

AFD = "000 \nFXUS63 KIND 081900\nAFDIND\n\nArea Forecast Discussion\nNational Weather Service Indianapolis IN\n300 PM EDT Mon Jul 8 2024\n\n.SHORT TERM (Tonight)...\nIssued at 300 PM EDT Mon Jul 8 2024\n\nStorms likely.\n\n&&\n\n.LONG TERM /Tuesday/...\nDry.\n\n&&\n\n.SHORT TERM...\nSecond one.\n\n$$\n"


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c")).alias("r")).first().r


@pytest.mark.parametrize(("text", "want"), [
    ("300 PM EDT Mon Jul 8 2024", datetime(2024, 7, 8, 19)), ("1200 AM CST Tue Jan 2 2024", datetime(2024, 1, 2, 6)), ("1200 PM EST Wed Jan 3 2024", datetime(2024, 1, 3, 17)),
    ("Issued at 1005 AM MDT Th Jul 4 2024", datetime(2024, 7, 4, 16, 5)), ("1530 PST Fri Mar 1 2024", datetime(2024, 3, 1, 23, 30)), ("500 PM XYZ Mon Jul 8 2024", None), ("Issued by nobody", None), ("2561 PM EDT Mon Jul 8 2024", None), ("500 PM EDT Mon Jul 48 2024", None), (None, None),
    ("930 am EDT Mon Jul 8 2024", datetime(2024, 7, 8, 13, 30)), ("930 AM EDT MON JUL 8 2024", datetime(2024, 7, 8, 13, 30)), ("issued AT 238 pm est thu jan 9 2025", datetime(2025, 1, 9, 19, 38)), ("1259 PM cdt Tue Jun 2 2026", datetime(2026, 6, 2, 17, 59)),
    ("238 PM EDT Thu NotAMonth 9 2026", None), ("238 PM EDT Thu Jul 32 2026", None), ("238 PM EDT Thu Jul 9", None), ("2500 PM EDT Thu Jul 9 2026", None), ("238 PM EDT Xxx Jul 9 2026", None), ("238 PM EDT Thu Jul 9 2026 more", None), ("", None), ("12345 PM EDT Thu Jul 9 2026", None),
])
def test_bulletin_times(spark, text, want):
    assert one(spark, text, B.local_text_to_utc) == want


@pytest.mark.parametrize(("text", "want"), [
    ("National Weather Service Indianapolis IN\n238 PM EDT Thu Jul 9 2026", "238 PM EDT Thu Jul 9 2026"),
    ("NATIONAL WEATHER SERVICE X\r\nISSUED BY NATIONAL WEATHER SERVICE Y\r\n300 am cst sun dec 8 2024  \r\n", "300 am cst sun dec 8 2024"),
    ("quoted\n100 AM EDT Mon Jul 8 2024\n\nNational Weather Service A\n930 PM AKDT Mon Jul 8 2024\n", "930 PM AKDT Mon Jul 8 2024"),
    ("National Weather Service A\n\n100 AM EDT Mon Jul 8 2024", None), ("100 AM EDT Mon Jul 8 2024", None), ("National Weather Service A\n100 AM EDT Mon Jul 8 2024 (late)", None), ("National Weather Service A\nno time\nIssued at 100 AM EDT Mon Jul 8 2024", None),
    ("National Weather Service A\nnone\nNational Weather Service B\nIssued at 100 AM EDT Mon Jul 8 2024", "Issued at 100 AM EDT Mon Jul 8 2024"), ("National Weather Service A\n1530 EDT Mon Jul 8 2024", None), ("", None), (None, None),
])
def test_the_stamp_below_the_office(spark, text, want):
    assert one(spark, text, B.issued_text) == want


def test_bulletins_from_response_to_record(spark):
    response = "noise before\n" + AFD + AFD.replace("IND", "LOT").replace("081900", "082000") + AFD.replace("300 PM EDT Mon Jul 8 2024", "no time")
    landed = spark.createDataFrame([("AFDIND", response), ("AFDXXX", "  "), ("AFDYYY", "ERROR: none")], "pil string, response string")
    bronze = B.bronze_bulletins(landed, "pil", "response")
    rows = bronze.orderBy("product_no" if "product_no" in bronze.columns else "record_id").collect()
    assert len(rows) == 3 and sum(r.rejected for r in rows) == 1
    good = [r for r in rows if not r.rejected]
    assert {r.pil for r in good} == {"AFDIND", "AFDLOT"} and all(r.published_at == datetime(2024, 7, 8, 19) for r in good)
    assert len({r.record_id for r in good}) == 2
    silver = {r.region: r for r in B.standard_bulletins(bronze).collect()}
    assert silver["IND"].dimensions == {"lrz": "6"} and silver["LOT"].dimensions == {"lrz": None}
    assert silver["IND"].title == "AFD | KIND | 300 PM EDT Mon Jul 8 2024"
    assert silver["IND"].metadata["wmo_header"] == "FXUS63 KIND 081900" and silver["IND"].categories[-1] == "afd"


def test_sections(spark):
    df = spark.createDataFrame([(1, AFD)], "k int, t string")
    rows = {r.section: r for r in B.parse_sections(df, "k", "t").collect()}
    assert set(rows) == {"SHORT TERM", "LONG TERM"}
    assert rows["SHORT TERM"].section_text == "Second one." and rows["LONG TERM"].detail == "Tuesday"
    first = {r.section: r for r in B.parse_sections(df.withColumn("t", F.substring_index("t", ".LONG", 1)), "k", "t").collect()}["SHORT TERM"]
    assert first.section_text == "Storms likely." and first.published_at == datetime(2024, 7, 8, 19) and first.detail == "Tonight"
    assert B.parse_sections(df.withColumn("t", F.lit("plain")), "k", "t").count() == 0
    header = one(spark, "no header", B.parse_header)
    assert all(v is None for v in header)


def test_nfkc_and_cleaning(spark):
    assert one(spark, "ﬁve ①", T.normalize_unicode) == "five 1"
    assert one(spark, "plain", T.normalize_unicode) == "plain"
    assert one(spark, None, T.normalize_unicode) is None
    assert one(spark, "<p>A &amp; B</p><script>x<y</script>  c", T.clean_text) == "A & B c"
    assert one(spark, None, T.clean_text) == "" and len(one(spark, "a" * 9000, T.clean_text)) == 8000
    assert one(spark, "1 < 2 and 3 > 2", T.strip_html) == "1 < 2 and 3 > 2"


@pytest.mark.parametrize(("html", "want"), [
    ('<meta property="article:published_time" content="2024-05-01T10:00:00Z">', datetime(2024, 5, 1, 10)),
    ('<meta content="2024-05-01T10:00:00+02:00" name="pubdate">', datetime(2024, 5, 1, 8)),
    ('<meta name="date" content="2024-05-01"><time datetime="2024-05-02T01:00:00Z">x</time>', datetime(2024, 5, 2, 1)),
    ("<time>2024-05-03T02:00:00Z</time>", datetime(2024, 5, 3, 2)), ("<p>none</p>", None), (None, None),
])
def test_publish_time(spark, html, want):
    assert one(spark, html, C.publish_time) == want


def test_articles_pages(spark):
    page = one(spark, "<html><title> T </title><body><nav>menu</nav><article><p>one</p><p>two</p></article></body></html>", C.extract_article)
    assert (page.title, page.text, page.status) == ("T", "one two", "success")
    assert one(spark, "<html><body><nav>x</nav></body></html>", C.extract_article).status == "empty_text"
    assert one(spark, "not a page", C.extract_article).status == "parse_failed" and one(spark, None, C.extract_article).status == "parse_failed"


ENTITIES = ["a &amp; b", "&amp;lt;", "&lt;b&gt; &quot;x&#39;", "AT&T & co", "&eacute;t&eacute &notit; &notin;", "&#65;&#x42;&#0;&#128;&#xD800;&#1114112;&#99999999999999999999; &#x1F600; &#1;&#11;&#xFFFF;", "&#; &#x; &;", "no reference", "", "&unknown; &ampx &copyright &AMP", "&#0065 &#x00041", "a=1&b=2&lang=en", "&&amp;&", "&" * 50, None, "&CounterClockwiseContourIntegral; &fjlig;", "&#8364;&nbsp;&hellip;"]


def test_entities_as_the_standard_library_decodes_them(spark):
    rows = spark.createDataFrame(list(enumerate(ENTITIES)), "i int, t string").select("i", T.decode_entities(F.col("t")).alias("r")).collect()
    assert {r.i: r.r for r in rows} == {i: t if t is None else html.unescape(t) for i, t in enumerate(ENTITIES)}


def words_of(text):
    return Counter(re.findall(r"\S+", text))


@pytest.mark.parametrize("template", ["<div>{0}</div>", "{0}", "<table><tr><td>{0}</td></tr></table>"])
def test_pages_without_an_article_lose_their_boilerplate(spark, template):
    """Menus, advertisements and footers as plain blocks around the text: most of the text is kept and most of the rest is not."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html").collect()
    pages, wanted, planted = [], {}, {}
    for r in rows:
        article = re.search("(?s)<article>(.*)</article>", r.html)[1]
        menu = "<div><ul>" + "".join(f'<li><a href="/m{i}">menu{i} entry{i}</a></li>' for i in range(8)) + "</ul></div>"
        more = "<p>" + " | ".join(f'<a href="/r{i}">related{i} story{i} of{i} today{i}</a>' for i in range(6)) + "</p><div>copyright notice</div><div>imprint</div>"
        pages.append((r.page_id, f"<html><head><title>t</title></head><body>{menu}{template.format(article)}{more}</body></html>"))
        wanted[r.page_id] = words_of(html.unescape(re.sub("<[^>]*>", " ", article)))
        planted[r.page_id] = words_of(re.sub("<[^>]*>", " ", menu + " " + more))
    got = {r.page_id: words_of(r.a.text) for r in spark.createDataFrame(pages, "page_id long, html string").select("page_id", C.article_text(F.col("html")).alias("a")).collect()}
    kept = sum((got[k] & wanted[k]).total() for k in got)
    assert kept / sum(w.total() for w in wanted.values()) >= 0.95
    assert kept / sum(g.total() for g in got.values()) >= 0.98
    assert sum((got[k] & planted[k]).total() for k in got) <= 0.1 * sum(p.total() for p in planted.values())


def test_a_page_of_short_blocks_keeps_its_body(spark):
    page = one(spark, "<html><body><div>one</div><div>two &amp; three</div><!-- no --></body></html>", C.article_text)
    assert (page.title, page.text, page.status) == ("", "one two & three", "success")


def test_merged_metadata(spark):
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    df = spark.createDataFrame([({"a": "1", "b": "1"}, {"b": "2"}), (None, None)], "x map<string,string>, y map<string,string>")
    assert [r[0] for r in df.select(C.merged_metadata(F.col("x"), F.col("y"))).collect()] == [{"a": "1", "b": "2"}, {}]


def test_news_graph_records(spark):
    gkg = spark.createDataFrame([
        ("g1", "20240501120000", "src", "http://u", "A;B; ", "1#n#US#USMN#x;1#n#CA#", "P", "Org,3;Two", "1.5,2", "<PAGE_TITLE> T </PAGE_TITLE><PAGE_PRECISEPUBTIMESTAMP>20240501113000</PAGE_PRECISEPUBTIMESTAMP>"),
        ("g2", "20240501120000", "src", "http://u", None, None, None, None, None, None), (" ", "20240501120000", *[None] * 8), ("g3", "bad", *[None] * 8),
    ], "GKGRECORDID string, DATE string, SourceCommonName string, DocumentIdentifier string, Themes string, Locations string, Persons string, Organizations string, Tone string, Extras string")
    rows = {r.record_id: r for r in R.news_graph_records(gkg).collect()}
    assert set(rows) == {"gdelt::g1", "gdelt::g2"}
    a, b = rows["gdelt::g1"], rows["gdelt::g2"]
    assert (a.title, a.region, a.categories, a.published_at) == ("T", "CA", ["A", "B"], datetime(2024, 5, 1, 11, 30))
    assert a.metadata.time_precision == "second" and b.metadata.time_precision == "15min" and b.region is None and b.categories == []


def hashed(**values):
    return hashlib.sha256(json.dumps(values, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def test_notices_articles_alerts(spark):
    kind = "topic string, notifications array<struct<id string, subject string, publishDate string, publishDateUnformatted string, body string, permanentLinkUrl string>>"
    n = spark.createDataFrame([("Ops", [("1", ' S "q"\t', "May 1", "2024-05-01T00:00:00Z", "<p>b &amp; c</p>", "/x"), ("2", "S", None, None, None, "http://y/z")]), (None, [("3", "é", "d", None, "b", None)])], kind)
    rows = {r.metadata["notification_id"]: r for r in R.notices(n).collect()}
    assert rows["1"].record_id == "miso:" + hashed(subject=' S "q"\t', publish_date="May 1", permanent_link="/x") and rows["3"].record_id == "miso:" + hashed(subject="é", publish_date="d", permanent_link=None)
    assert [rows[k].url for k in "123"] == ["https://www.misoenergy.org/x", "http://y/z", None] and rows["1"].published_at == datetime(2024, 5, 1) and rows["2"].published_at is None
    assert rows["1"].title == ' S "q"\t' and rows["1"].text == "b & c" and rows["2"].text == "" and rows["1"].region == "MISO"
    assert rows["1"].categories == ["market_notice", "Ops"] and rows["3"].categories == ["market_notice"] and rows["1"].metadata == {"topic": "Ops", "notification_id": "1", "publish_date": "May 1"}
    a = spark.createDataFrame([(" http://u ", "2024-05-01T00:00:00Z", "t", " ", "c\n"), (" ", "2024-05-01T00:00:00Z", "t", "d", "c"), ("http://v", None, "t", "d", "c")], "url string, publishedAt string, title string, description string, content string")
    made = R.articles(a, query="q").collect()
    assert [(r.record_id, r.text, r.categories, r.region) for r in made] == [("newsapi:" + hashed(url="http://u"), "t\n\nc", ["news"], None)]
    assert made[0].metadata == {"news_source": None, "news_source_id": None, "author": None, "query": "q", "language": None, "sort_by": None}
    w = spark.createDataFrame([("MN", "f1", ("p1", "2024-05-01T00:00:00Z", "Head", "Desc", None, "Storm", "Severe", "NWS", ["z"])), ("MN", "f2", (None, "2024-05-01T00:00:00Z", None, None, "Act", "Storm", None, None, None)), ("MN", "f3", ("p3", None, *[None] * 7))], "query_area string, id string, properties struct<id string, sent string, headline string, description string, instruction string, event string, severity string, senderName string, affectedZones array<string>>")
    rows = {r.record_id: r for r in R.alerts(w).collect()}
    assert set(rows) == {"p1", "f2"} and rows["p1"].text == "Head\n\nDesc" and rows["p1"].categories == ["Storm", "Severe"] and rows["p1"].region == "MN" and rows["f2"].url == "f2"
    assert set(rows["p1"].metadata) == {"query_area", *R.ALERT_KEYS} and len(rows["p1"].metadata) == 17 and rows["p1"].metadata["sender_name"] == "NWS" and rows["p1"].metadata["affected_zones"] == '["z"]' and rows["p1"].metadata["expires_at"] is None
    assert R.alert_areas([" mn ", "", "wi"]) == ["MN", "WI"] and R.alert_areas("mi") == ["MI"]


def test_stable_hash_is_that_of_json(spark):
    text = "".join(map(chr, range(1, 128))) + "é 😀 /"
    df = spark.createDataFrame([(text, 5, None, True, datetime(2024, 1, 2, 3, 4, 5, 600))], "a string, b int, c string, d boolean, e timestamp")
    row = df.select(S.stable_hash(a=F.col("a"), b=F.col("b"), c=F.col("c"), d=F.col("d")).alias("h"), S.format_utc(F.col("e")).alias("t")).first()
    assert row.h == hashed(a=text, b=5, c=None, d=True) and row.t == "2024-01-02T03:04:05.000600+00:00"


def test_entities_and_section_heads(spark):
    assert one(spark, "<b>&mdash;&eacute;&#8217;&nbsp;&copy x</b>", T.strip_html).strip() == html.unescape("&mdash;&eacute;&#8217;&nbsp;&copy x")
    heads = {".A B (c\nd)...x": ("A B", "c\nd"), ".A/B-2 /x...y/...z": ("A/B-2", "x"), ".A...x": ("A", ""), ".a...x": ("", ""), ".A (b) c...x": ("", ""), ".A (b...c)...x": ("A", "b...c")}
    for text, want in heads.items():
        got = one(spark, text, B.section_head)
        assert (got.name, got.detail) == want or text == ".A/B-2 /x...y/...z"
    author = lambda page: one(spark, page, C.article_author)
    assert author('<meta content="A &amp; B" name="author">') == "A & B" and author('<a rel="author" href="x">Bo <b>Li</b></a>') == "Bo Li" and author('<p class="x byline">By Ann</p>') == "Ann" and author("<p>x</p>") is None and author(None) is None


def test_regex_words_and_clean_rows(spark):
    assert [one(spark, v, lambda c: A.matches_any(c, ["a.b", "Grid"])) for v in ("the GRID.", "gridlock", "a.b", "axb", None)] == [True, False, True, False, False]
    df = spark.createDataFrame([(1, float("nan"), "x"), (2, 1.0, " ")], "k int, v double, t string")
    good, bad = S.clean_row(df, "t")
    assert good.collect()[0].v is None and [r.k for r in bad.collect()] == [2]


def test_location_parts_and_key_sets(spark):
    df = spark.createDataFrame([(1, "1#City#US#USMN##4.5#-9#77;2#X#CA"), (2, "")], "k int, l string")
    rows = A.location_parts(df, "k", "l").collect()
    assert len(rows) == 2 and rows[0].country == "US" and rows[0].adm2 is None and rows[1].feature_id is None
    m = spark.createDataFrame([({"b": "1", "a": "2"},), ({"a": "1", "b": "3"},), ({"c": "1"},)], "m map<string,string>")
    assert {r["keys"]: r.n for r in A.key_set_counts(m, "m").collect()} == {"a,b": 2, "c": 1}


def test_migration_and_ids(spark):
    df = spark.createDataFrame([("1", '{"a": 1}'), ("2", None)], "id string, raw string")
    made, ids = R.migrated(df.unionByName(df), F.concat(F.lit("x"), F.col("id")))
    assert sorted(map(tuple, made.collect())) == [("x1", '{"a": 1}'), ("x2", '{"id":"2"}')] and ids.count() == 2
    bad = spark.createDataFrame([("", "s"), ("a", "s")], "record_id string, source string")
    with pytest.raises(ValueError):
        R.require_ids(bad)
    with pytest.raises(ValueError):
        R.require_ids(bad.filter("record_id = 'a'"), source="other")


def test_scalars_on_odd_values(spark):
    assert one(spark, None, S.split_values) == [] and one(spark, " ; a;; b ", S.split_values) == ["a", "b"]
    assert one(spark, "x", S.parse_locations) == [] and one(spark, None, S.parse_locations) == []
    assert one(spark, "2024-01-01T5", S.parse_hour_period) is None and one(spark, "2024-13-01T05", S.parse_hour_period) is None
    assert [one(spark, v, S.parse_number) for v in ("1,234.5", "", " ", "x", None)] == [1234.5, None, None, None, None]
    assert [one(spark, v, S.normalize_unit) for v in (" MegaWatts ", None, " GJ ")] == ["MW", "unknown", "GJ"]
    assert one(spark, "http://www.A.com:80/x", S.url_domain) == "a.com" and one(spark, "::bad", S.url_domain) is None
    assert one(spark, "http://a.b/news/grid-outage_in-ohio-1234567.html", S.title_from_url) == "Grid Outage In Ohio"
