"""The queries on pages whose titles are cut off within a reference, as their SQL reads them: a reference ends with its semicolon."""

import html

import duckdb
import pytest
from pyspark.sql import functions as F

from gridmill.functions import text as T
from gridmill.plans import catalog

PAGE = "<html><head><title>{0}</title></head><body><article><h1>{0}</h1><p>one &amp; two</p></article></body></html>"
TITLES = ["a&amp;&amp", "a &am", "a &quot;b&quot", "&amp;lt; &ampx; &copy;", "&copy x", "&a", "plain"]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pages"))
    rows = [(i, f"https://h/{i}", PAGE.format(t)) for i, t in enumerate(TITLES * 3)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{folder}/pages.parquet")
    return folder


def differing(spark, folder, name):
    """Rows of the query and of its SQL that are not in both."""
    df = catalog.QUERIES[name](spark, folder)
    with duckdb.connect() as duck:
        duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
        want = set(duck.sql(f"SELECT {', '.join(df.columns)} FROM ({catalog.ORACLES[name]})").fetchall())
    return {tuple(r) for r in df.collect()} ^ want


def test_closed_references_alone(spark):
    for text, want in {"&eacute;&#8217;&#x2019;&eacute &#8217 &notit; &amp": "é’’&eacute &#8217 &notit; &amp", "&lt &lt;": "&lt <", "&amp;&": "&&"}.items():
        assert spark.range(1).select(T.decode_closed(F.lit(text))).first()[0] == want
    assert spark.range(1).select(T.decode_entities(F.lit("&copy x"))).first()[0] == html.unescape("&copy x")


def test_strip_html(spark, pages):
    assert differing(spark, pages, "strip_html") == set()


def test_clean_text(spark, pages):
    assert differing(spark, pages, "clean_text") == set()
    for text in ("<b>&eacute;&#8217;&#x2019;&eacute &#8217 &notit; &amp</b>", "<b>&lt &lt;&ampx;</b>"):
        row = spark.range(1).select(T.clean_text(F.lit(text), closed=True).alias("a"), T.normalize_whitespace(T.strip_html(F.lit(text), T.decode_closed)).alias("b")).first()
        assert row.a == row.b


def test_clean_if_success(spark, pages):
    assert differing(spark, pages, "clean_if_success") == set()


def test_extract_article(spark, pages):
    assert differing(spark, pages, "extract_article") == set()


def test_scrape_result(spark, pages):
    assert differing(spark, pages, "scrape_result") == set()
