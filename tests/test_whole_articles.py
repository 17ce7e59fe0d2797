"""extract_article reads all of a page: every article, nested and unclosed ones, pages without one, author and date; its SQL does, too."""

import duckdb
import pytest

from gridmill.plans import catalog

LONG = " ".join(f"word{i}" for i in range(20))


def page(body, head=""):
    return f"<html><head><title>T</title>{head}</head><body>{body}</body></html>"


# The page, then its text, author and date.
PAGES = {
    "two": (page("<article><p>first</p></article><div>x</div><ARTICLE class=b><p>second &amp; more</p></ARTICLE>"), "first second & more", None, None),
    "nested": (page("<article>before<article>inner</article>after</article><p>outside</p>"), "before inner after", None, None),
    "unclosed": (page("<p>menu</p><article><p>never</p><p>closed</p>"), "never closed", None, None),
    "space in the end tag": (page("<article>a</article ><p>not</p>"), "a", None, None),
    "stray end tags": (page("</article><article>a</article></article>no<article>b</article>"), "a b", None, None),
    "empty before full": (page("<article> <b></b></article><article>text</article>"), "text", None, None),
    "menu alone in the article": (page(f"<article><nav>menu</nav></article><p>{LONG}</p>"), LONG, None, None),
    "article in a comment": (page("<!-- <article>old</article> --><article>new</article>"), "new", None, None),
    "menu tag in a comment": (page("<!-- <nav> --><article>kept<nav>menu</nav> also</article>"), "kept also", None, None),
    "other names": (page("<article-card>card</article-card><nav-bar>bar</nav-bar><article>a<nav>m</nav>b</article>"), "a b", None, None),
    "unclosed body": (f"<html><head><title>T</title></head><body><p>{LONG}</p>", LONG, None, None),
    "no body": (f"<title>T</title><p>{LONG}</p>", LONG, None, None),
    "after the body": (page(f"<p>{LONG}</p></body><p>{LONG} more</p>"), f"{LONG} {LONG} more", None, None),
    "menu by blocks": (page(f"<ul><li><a href=/a>menu</a></li></ul><div>{LONG}</div><p>{LONG}</p>"), f"{LONG} {LONG}", None, None),
    "short blocks": (page("<div>one</div><div>two &amp; three</div>"), "one two & three", None, None),
    "many": (page("".join(f"<article>a{i}</article>" for i in range(200))), " ".join(f"a{i}" for i in range(200)), None, None),
    "deep": (page("<article>a" * 50 + "</article>z" * 50), " ".join("a" * 50 + "z" * 49), None, None),
    "meta": (page("<article>a</article>", '<meta property="article:published_time" content="2024-05-01T23:30:00-02:00"><meta content="Ann &amp; Co" name="author">'), "a", "Ann & Co", "2024-05-02"),
    "byline": (page('<article><span class="small byline">By <b>Ann</b> Lee</span>text</article>', '<link rel="author" href="/a"><meta name="date" content="2024-05-09">'), "By Ann Lee text", "Ann Lee", "2024-05-09"),
    "time": (page("<article>a</article><time>2024-05-03T02:00:00Z</time>"), "a", None, "2024-05-03"),
    "no text": (page("<article> &nbsp; </article>"), "", None, None),
    "no tag": ("plain text", "", None, None),
    "null": (None, "", None, None),
}


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    """Rows of the query and of its SQL by the name of the page."""
    folder, names = str(tmp_path_factory.mktemp("pages")), list(PAGES)
    spark.createDataFrame([(i, f"https://h/{i}", PAGES[n][0]) for i, n in enumerate(names)], "page_id long, url string, html string").coalesce(1).write.parquet(f"{folder}/pages.parquet")
    df = catalog.QUERIES["extract_article"](spark, folder)
    with duckdb.connect() as duck:
        duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
        sql = duck.sql(catalog.ORACLES["extract_article"])
        want = [dict(zip(sql.columns, r)) for r in sql.fetchall()]
    return {names[r.page_id]: r.asDict() for r in df.collect()}, {names[r["page_id"]]: r for r in want}


@pytest.mark.parametrize("name", PAGES)
def test_whole_page(both, name):
    html, text, author, date = PAGES[name]
    got, want = both[0][name], both[1][name]
    assert (got["text"], got.get("author"), got.get("date")) == (text, author, date)
    assert got["status"] == ("parse_failed" if html is None or "<" not in html else "success" if text else "empty_text")
    assert got == want
