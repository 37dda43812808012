import random

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from clearwell.llm.common import connected_components
from clearwell.llm.queries import URL_RULES
from clearwell.llm.urlfilter import judge_urls

SF = "/root/testdata/sf0.001"


def components(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


@pytest.mark.parametrize("kind", ["path", "star", "random", "empty"])
def test_components_equal_union_find(spark, kind):
    rng = random.Random(6)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(90)] + [(500, 500), (None, 3), (7, 7)],
        "random": [(rng.randrange(150), rng.randrange(150)) for _ in range(110)] * 2,
        "empty": [(None, 1), (4, 4)],
    }[kind]
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r["node"]: r["component"] for r in connected_components(df).collect()} == components(edges)


def page(url, html=""):
    return url, html


def test_rules_aliases_and_awkward_rows(spark):
    canonical = '<head><link rel="canonical" href="{}"></head>'
    pages = [
        (1, "https://Example.com/en/x?a#b", None),
        (2, "http://www.example.com/en/", ""),
        (3, "http://notexample.com", None),  # path is empty: com/ does not fit
        (4, "no url", ""),
        (5, None, None),
        (6, "http://blog.a.org/1", canonical.format("http://example.com/en/spam")),  # alias of a blocked address
        (7, "http://b.org/r", '<meta http-equiv="refresh" content="0; url=http://blog.a.org/1">'),  # two steps away
        (8, "http://c.org/1", canonical.format("/2")),
        (9, "http://c.org/2", ""),
        (10, "http://d.org/1", canonical.format("http://example.com/en/t")),
        (11, "http://d.org/2", canonical.format("http://d.org/1") + canonical.format("http://fine.com/z")),  # allow wins
        (12, "https://shop.com/p", canonical.format("http://example.com/en/u")),  # its own rule decides
        (None, "ftp://x.net/fr/y", None),
        (8, "http://c.org/1", canonical.format("/2")),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS verdict")
    got = sorted(map(tuple, judge_urls(df, URL_RULES).collect()), key=str)
    want = [
        (1, "example.com", "/en/x", "example.com/en/", "block", "rule"),
        (2, "www.example.com", "/en/", "www.example.com/en/", "allow", "rule"),
        (3, "notexample.com", "", None, "allow", "default"),
        (4, "", "", None, "allow", "default"),
        (5, "", "", None, "allow", "default"),
        (6, "blog.a.org", "/1", None, "block", "alias"),
        (7, "b.org", "/r", None, "block", "alias"),
        (8, "c.org", "/1", None, "allow", "default"),
        (9, "c.org", "/2", None, "allow", "default"),
        (10, "d.org", "/1", None, "allow", "alias"),
        (11, "d.org", "/2", None, "allow", "alias"),
        (12, "shop.com", "/p", "com/", "allow", "rule"),
        (None, "x.net", "/fr/y", "net/fr/", "block", "rule"),
        (8, "c.org", "/1", None, "allow", "default"),
    ]
    assert got == sorted(want, key=str)
    assert judge_urls(df.limit(0), URL_RULES).count() == 0


def test_every_spelling_of_a_target(spark):
    blocked = '<link rel="canonical" href="http://example.com/en/s">'
    alias = {  # page, its link, the address of the page that a blocked address names canonical
        1: ("http://a1.org/d/a.html", '<meta http-equiv="refresh" content="0; url=next.html">', "http://a1.org/d/next.html"),
        2: ("http://a2.org/d/e/a", "<link rel=canonical href=../x>", "http://a2.org/d/x"),
        3: ("http://a3.org/p?q", '<meta http-equiv=refresh content="0;url=?p=1">', "http://a3.org/p?p=1"),
        4: ("http://a4.org/a", "<link rel='canonical' href='http://a4.org/x?a=1&amp;b=2'>", "http://a4.org/x?a=1&b=2"),
        5: ("http://a5.org/a", '<meta http-equiv="refresh" content="0;url=/x?a=1&amp;b=2">', "http://a5.org/x?a=1&b=2"),
        6: ("http://a6.org/a", '<link rel="canonical" href="b&#x2F;&#228;&#47;&#x1F600;&amp;lt;">', "http://a6.org/b/\u00e4/\U0001f600&lt;"),
        7: ("http://a7.org/a", "<link rel='nofollow canonical' href='/x'>", "http://a7.org/x"),
        8: ("http://a8.org", '<link href="./b/../../c/." rel="canonical nofollow">', "http://a8.org/c/"),
        9: ("http://a9.org/a", "<link rel=canonical href=/go?u=http://fine.com/>", "http://a9.org/go?u=http://fine.com/"),
    }
    none = {
        31: ("http://b1.org/", "<link rel=canonical href=mailto:x@example.com>"),
        32: ("http://b2.org/", "<link rel=canonical href=#top>"),
        33: ("http://b3.org/", "<link rel=canonical href=/go?u=http://example.com/en/s>"),
        34: ("http://b4.org/", "<link rel=not-canonical href=http://example.com/en/s>"),
        35: ("http://b5.org/", "<link rel=canonical href=&#xD800;&#9999999;&#0;&nbsp;>"),
        36: ("no url", "<link rel=canonical href=x>"),
    }
    rows = [(i, url, html) for i, (url, html, _) in alias.items()] + [(i, *row) for i, row in none.items()]
    rows += [(100 + i, to, blocked) for i, (_, _, to) in alias.items()]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in judge_urls(df, URL_RULES).collect()}
    assert got == {i: "allow" if i in none else "block" for i, _, _ in rows}


def test_given_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (2, "http://b.org/")], "page_id long, url string")
    edges = spark.createDataFrame([("http://a.org/", "http://z.net/es/"), (None, "x")], "a string, b string")
    got = {r["page_id"]: r["verdict"] for r in judge_urls(pages, URL_RULES, edges, html_col=None).collect()}
    assert got == {1: "block", 2: "allow"}
    assert {r["via"] for r in judge_urls(pages, URL_RULES, html_col=None).collect()} == {"default"}


def test_query_equals_its_sql_and_stays_native(spark):
    query = entry.queries()["op4_url_filters"]
    assert compare(spark, connect(SF), query, entry.oracle_sql()["op4_url_filters"], SF) is None
    plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop") if w in plan]
