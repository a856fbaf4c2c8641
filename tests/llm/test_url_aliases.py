"""URL rules, link extraction and verdicts of alias classes."""

from __future__ import annotations

import duckdb
import pytest
from larder.llm import url_aliases

PAGES = [
    (1, "https://a.example.org/one#x", ""),
    (2, "http://a.example.org/one/?utm_source=f", '<LINK href="https://b.example.net/es/9" rel="canonical">'),
    (3, "https://b.example.net/es/9", "<p>"),
    (4, "https://www.example.com/en/a", '<link rel=canonical href="/en/b">'),
    (5, "https://example.com/en/a", None),
    (6, "https://EXAMPLE.COM/en/a", '<meta http-equiv="refresh" content="0; url=https://c.example.org/q?id=1&ref=z">'),
    (7, "https://c.example.org/q?ref=y&id=1", ""),
    (8, "http://shop.net/fr/1", '<link rel="canonical" href="//d.example.org/k">'),
    (9, "http://d.example.org/k/", '<link rel="canonical" href="http://www.x.com/ok">'),
    (10, None, '<link rel="canonical" href="http://shop.net/fr/1">'),
    (11, "no scheme", ""),
    (12, "http://net", ""),
    (13, "http://user@mynet/es/1?x=http://shop.net/es/", None),
    (None, "https://x.example.org/://net/es/", ""),
    (14, "https://b.example.net/es/9", "<p>"),
    (14, "https://b.example.net/es/9", "<p>"),
]
EXPECTED = {
    1: (None, "block"), 2: (None, "block"), 3: ("net/es/", "block"), 4: ("www.example.com/en/", "allow"),
    5: ("example.com/en/", "block"), 6: ("example.com/en/", "block"), 7: (None, "block"), 8: ("net/fr/", "block"),
    9: (None, "allow"), 10: (None, "allow"), 11: (None, "allow"), 12: (None, "allow"), 13: (None, "allow"),
    None: (None, "allow"), 14: ("net/es/", "block"),
}


@pytest.fixture(scope="module")
def pages(spark):
    data = [(*p, "r", "v", "n") for p in PAGES]
    return spark.createDataFrame(data, "page_id long, url string, html string, rule string, verdict string, node string")


def test_verdicts(pages):
    found = url_aliases.verdicts(pages).collect()
    assert len(found) == len(PAGES)
    for r in found:
        assert (r["rule"], r["verdict"]) == EXPECTED[r["page_id"]], r
    parts = {r["page_id"]: (r["host"], r["path"]) for r in found}
    assert parts[6] == ("example.com", "/en/a") and parts[13] == ("user@mynet", "/es/1")
    assert parts[11] == parts[10] == ("", "") and parts[12] == ("net", "") and parts[None] == ("x.example.org", "/://net/es/")


def test_sql_agrees(pages):
    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url", "html").toPandas().astype({"page_id": "Int64"}))
    names = ["page_id", "host", "path", "rule", "verdict"]
    ours = sorted((tuple(r) for r in url_aliases.verdicts(pages).select(names).collect()), key=repr)
    assert sorted(con.execute(f"SELECT {', '.join(names)} FROM ({url_aliases.ORACLE})").fetchall(), key=repr) == ours


def test_redirects_join_classes(pages, spark):
    redirects = spark.createDataFrame([("http://net", "https://b.example.net/es/9"), (None, "http://net")], "source string, target string")
    found = {r["page_id"]: r["verdict"] for r in url_aliases.verdicts(pages, redirects=redirects).collect()}
    assert found[12] == "block" and found[11] == "allow"


def test_empty_table(pages):
    assert url_aliases.verdicts(pages.limit(0)).count() == 0


def test_an_allow_wins_among_rules_of_one_length(spark):
    rules = [("allow", "b.c", "/x/"), ("block", "b.c", "/x/"), ("block", "a.b.c", "/"), ("allow", "b.c", "/xy")]
    pages = spark.createDataFrame([(1, "http://b.c/x/1", None), (2, "http://a.b.c/xy", None)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_aliases.verdicts(pages, rules).collect()}
    assert got == {1: ("b.c/x/", "allow"), 2: ("b.c/xy", "allow")}


def test_all_links_of_a_page_are_followed_from_its_folder(spark):
    url = "https://H.org/a/b/page.html?q=1"
    tags = ["../up.html", "./same.html", "next.html", "?p=2", "/root", "//other.net/x", "http://full.org/y", "#place", "mailto:x@y", "../../../top"]
    html = "".join(f'<link rel="canonical" href="{t}">' for t in tags) + '<meta http-equiv="refresh" content="0; url=later.html">'
    pages = spark.createDataFrame([(1, url, html), (2, url, None), (3, None, html)], "page_id long, url string, html string")
    got = {r["target"] for r in url_aliases.alias_links(pages).collect() if r["source"]}
    site = "https://h.org"
    assert got == {
        f"{site}/a/up.html", f"{site}/a/b/same.html", f"{site}/a/b/next.html", f"{site}/a/b/page.html?p=2", f"{site}/root",
        "https://other.net/x", "http://full.org/y", f"{site}/top", f"{site}/a/b/later.html",
    }
