import html as entities
import math
import re
import time

import pytest

import __spark_entry__ as entry
from clearwell.llm import html
from clearwell.llm.html import extract_main_text, main_text

SF = "/root/testdata/sf0.01"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:"</p>"}</style></head><body class="menu-open">
<header><h1>Site</h1></header><div id=menu><a href=x>Home</a> <a href=y>News</a></div>
<div class="cookie-notice">We use cookies, ok? Long, long, long text. Really.</div>
<div class="content"><h2>Title &amp; more</h2><p>First para, with <a href=q>link</a> text.<br>Same block.
<p>Second   para &lt;b&gt; of a &nbsp; text, which has commas. And more.</p><!-- <p>hidden</p> --><script>var a = "<p>no</p>";</script>
<ul><li>one<li>two</ul><aside>related</aside><form>Sign up<input></form><table><tr><td>c1<td>c2</table></div>
<div class="comments"><p>I think that, well, this is a comment, a long one. Really long, isn't it?</p></div>
<div id="sidebar"><p>Side text.</p></div><footer>&copy; x</footer></body></html>"""


def test_article_without_the_rest():
    assert main_text(PAGE).split("\n") == [
        "Title & more", "First para, with link text. Same block.", "Second para <b> of a text, which has commas. And more.",
        "one", "two", "c1", "c2",
    ]


def test_layout_words_do_not_hide_the_article():
    page = '<div id="page" class="has-sidebar layoutWide"><div class="articleBody"><p>Long text, kept. Yes.</p></div>{}</div>'
    aside = '<div class="sidebar"><p>Side text, dropped.</p></div><ol class="commentlist"><li>First!</ol>'
    assert main_text(page.format(aside)) == "Long text, kept. Yes."


def test_broken_and_empty_pages():
    for page in ("", " ", "<p", "<!-- never closed <p>x", "<script>x", "</p></div>", "<nav>only a menu</nav>"):
        assert main_text(page) == "", page
    assert main_text("plain words") == "plain words" and main_text("1 < 2") == "1 < 2"
    assert main_text("<p>a<p>b</div></span><p>c &#233; &lt;") == "a\nb\nc é <"
    assert main_text("<article><p>x" + "<b>" * 5000 + "deep") == "xdeep"
    assert main_text('<article><p title="a > b">kept</article>') == "kept"


def test_awkward_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", ""), (3, "w", "<article>" + "<p>wörd, wörd.</p>" * 20_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS a", "3 AS n_chars")
    got = extract_main_text(df).collect()
    assert len(got) == 5 and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    assert sorted(r["n_chars"] for r in got) == sorted(len(main_text(h or "")) for _, _, h in rows)
    assert extract_main_text(df.limit(0)).count() == 0


def test_query_gives_every_article(spark):
    got = {r["page_id"]: r["text"] for r in entry.queries()["op9_html_text"](spark, SF).collect()}
    for page in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", page["html"], re.S).group(1)
        blocks = [" ".join(entities.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", article)]
        assert got[page["page_id"]] == "\n".join(b for b in blocks if b)


TEXT = "<p>Long text, with commas. And more, of it.</p>" * 4
LINES = "\n".join(["Long text, with commas. And more, of it."] * 4)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<div id=page><h1>Title</h1><p>Lead</p><div class=body>{TEXT}</div></div>", f"Title\nLead\n{LINES}"),
        (f'<div class="post tag-ads"><h1>T</h1>{TEXT}</div><div class=ads>Buy this, now. Really.</div>', f"T\n{LINES}"),
        ('<article><p>Dig <span class="search-term">for gold</span>, they said.</p></article>', "Dig for gold, they said."),
        (f"<article>{TEXT}<ul><li><a href=x>linked item</a></li></ul></article>", f"{LINES}\nlinked item"),
        (f"<article>{TEXT}<figure><img><figcaption>A caption</figcaption></figure></article>", f"{LINES}\nA caption"),
        (f"<header>Site</header><article><header><h1>Title</h1></header>{TEXT}</article>", f"Title\n{LINES}"),
        (f"<form id=aspnet><div>{TEXT}</div><form class=login>Sign in, please. Or else.</form></form>", LINES),
        (f'<section id="login-guide"><h2>How to log in</h2>{TEXT}</section>', f"How to log in\n{LINES}"),
        (f'<div class="article-with-comments">{TEXT}<div class="comments">{TEXT}</div></div>', LINES),
        (f'<article>{TEXT}<div id="comment-list"><p>First, of all. Yes, really.</p></div></article>', LINES),
        (f"<b><div>{TEXT}</b><p>Rest, of it all. Also long.</div>", f"{LINES}\nRest, of it all. Also long."),
        (f"<p><a href=x>only links, here. Many.</a></p><div class=x>{TEXT}</div><p><a href=y>More links, here.</a></p>", LINES),
    ],
)
def test_no_article_text_is_lost(page, want):
    assert main_text(page) == want


def article_of(page):
    article = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    blocks = [" ".join(entities.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", article)]
    return "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("tags", [("", ""), ('<div class="post">', "</div>"), ('<td id="x1"><section>', "</section></td>")])
def test_ratios_find_the_article_without_its_element(spark, monkeypatch, tags):
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect()]
    bare = [p.replace("<article>", tags[0]).replace("</article>", tags[1]) for p in pages]
    assert [main_text(p) for p in bare] == [article_of(p) for p in pages]
    monkeypatch.setattr(html, "path_scores", lambda page: [1.0] * len(page.text))
    assert sum(main_text(p) != article_of(q) for p, q in zip(bare, pages, strict=True)) > 0.9 * len(pages)


def test_scores_of_paths():
    page = html._Page('<div><p>ab, cd.</p><p><a href=x>linked, all. of</a></p></div><div class=ads><p>Ten chars.</p></div><i>x</i>')
    def fused(length, marks):
        return math.sqrt(math.log1p(length) * math.log1p(1 + marks))
    raw = [fused(7 / 2, 2 / 2), fused(7 / 2, 2 / 2), fused(10, 1), fused(1, 0)]
    near = [(raw[0] + raw[1]) / 2, sum(raw[:3]) / 3, sum(raw[1:]) / 3, (raw[2] + raw[3]) / 2]
    smooth = [(3 * r + n) / 4 for r, n in zip(raw, near, strict=True)]
    path = (smooth[0] + smooth[1]) / 2
    assert html.path_scores(page) == pytest.approx([path, path, smooth[2] * html.CERTAIN, smooth[3]])


def test_deep_pages_take_linear_time():
    n = 5000
    for page in (
        "".join(f"<div>ab, c{i}." for i in range(n)),
        "<article><ul>" + "<div>x<li>y" * n,
        "<p><b>x<a>" * n + "</b></a></p>" * n,
        "<table>" + "<tr><td>x<table>" * n,
        "<form class=ad>" * n + "x, y." + "</form>" * n,
    ):
        start = time.perf_counter()
        assert main_text(page)
        assert time.perf_counter() - start < 1
