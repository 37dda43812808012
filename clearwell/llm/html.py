"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clearwell.llm.common import slices

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|template|noscript|iframe|object|svg|math|textarea|title)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|([^<]++|<)",
    re.S | re.I,
)
_LABEL = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_PUNCTUATION = re.compile(r"[.,;:!?…。，！？；：]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s"
    " samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that never hold main text.
BOILERPLATE = frozenset("nav footer aside menu dialog button select option head".split())
#: Elements that do so only if the page's article stands in them.
UNLIKELY = frozenset("form fieldset header".split())
#: Words in class, id or role that mark what is not the article.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies"
    " consent gdpr notice notices alert menu nav navbar navigation sidebar comment comments commentlist reply replies"
    " respond disqus share sharing social related recommended footer header masthead breadcrumb breadcrumbs"
    " newsletter subscribe subscription signup popup modal overlay widget widgets pagination pager toolbar"
    " complementary contentinfo search login tags outbrain taboola skip".split()
)
#: Words that say where or how a part stands and not what it is.
PLACES = frozenset(
    "area bar block bottom box container footer form group header inner item items left list main page panel"
    " policy right row section site slot thread top unit wrap wrapper zone".split()
)
#: What a hint leaves of a path's score: a name made of hints alone, and one among other words.
CERTAIN, POSSIBLE = 0.2, 0.8
#: Elements that hold running text; the article is never smaller.
TEXT = frozenset("p li h1 h2 h3 h4 h5 h6 dt dd td th tr blockquote pre".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What opening a tag closes, up to the element that holds the list or table.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}


def _hinted(tag: str, attributes: str, in_article: bool) -> float:
    """What the names of an element leave of its score.

    A header in an article is its title's.
    """
    left = CERTAIN if tag in UNLIKELY and not (tag == "header" and in_article) else 1.0
    if "=" not in attributes:
        return left
    for m in _LABEL.finditer(attributes):
        label = _CAMEL.sub("-", m.group(1) or m.group(2) or m.group(3) or "").lower()
        for name in label.split():
            parts = [p for p in _PARTS.split(name) if p and not p.isdigit()]
            if not HINTS.isdisjoint(parts):
                certain = all(p in HINTS or p in PLACES for p in parts)
                left = min(left, CERTAIN if certain else POSSIBLE)
    return left


class _Page:
    """Text blocks of a page in page order, and the elements that hold them.

    Element 0 is the page itself; a parent stands before its children.  ``path`` numbers
    the tag paths from the root, which elements share; ``left`` is what the hints on
    the way from the root leave of a score.
    """

    def __init__(self, page: str) -> None:
        self.parent, self.tag, self.path, self.left = [-1], [""], [0], [1.0]
        self.paths: dict[tuple[int, str, float], int] = {}
        self.node: list[int] = []
        self.text: list[str] = []
        self.linked: list[int] = []
        self._read(page)

    def _element(self, parent: int, tag: str, attributes: str, in_article: bool) -> int:
        left = 1.0 if tag in ("html", "body", "article", "main") else _hinted(tag, attributes, in_article)
        step = tag if tag in ("p", "li", "html", "body") else tag + _step(attributes)
        key = (self.path[parent], step, left)
        self.parent.append(parent)
        self.tag.append(tag)
        self.path.append(self.paths.setdefault(key, len(self.paths) + 1))
        self.left.append(max(1e-12, self.left[parent] * left))  # however deep, not zero
        return len(self.parent) - 1

    def _read(self, page: str) -> None:
        stack: list[tuple[str, int]] = []  # open tag, innermost element that is no inline one
        places: dict[str, list[int]] = {}  # where in the stack a tag is open
        hidden = 0  # open elements that never hold main text
        parts: list[str] = []
        linked = 0

        def pop() -> str:
            nonlocal hidden
            tag = stack.pop()[0]
            if tag:
                places[tag].pop()
                hidden -= tag in BOILERPLATE
            return tag

        def close(at: int) -> None:
            while len(stack) > at:
                pop()

        def flush() -> None:
            nonlocal parts, linked
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    self.node.append(stack[-1][1] if stack else 0)
                    self.text.append(text)
                    self.linked.append(linked)
                parts, linked = [], 0

        def nearest(tags: frozenset) -> int:
            return max((places[t][-1] for t in tags if places.get(t)), default=-1)

        for m in _TOKEN.finditer(page):
            text = m.group(8)
            if text is not None:
                if not hidden:
                    text = entities.unescape(text) if "&" in text else text
                    parts.append(text)
                    if places.get("a"):
                        linked += len(text.strip())
                continue
            tag = m.group(3) or m.group(6)
            if tag is None:
                if m.group(1) and m.group(1).lower() not in INLINE:
                    parts.append(" ")
                continue
            tag = tag.lower()
            inline = tag in INLINE
            if not inline:
                flush()
            elif tag == "br":
                parts.append(" ")
            if m.group(2) or m.group(5):
                if places.get(tag):
                    at = places[tag][-1]
                    if inline and stack[at][1] != stack[-1][1]:
                        places[tag].pop()  # blocks within an inline element stay open
                        stack[at] = ("", stack[at][1])
                    else:
                        close(at)
                continue
            if tag in VOID:
                continue
            if not inline and places.get("p") and tag != "option":
                close(places["p"][-1])
            if tag in CLOSES:
                ends, holders = CLOSES[tag]
                at = nearest(ends | holders)
                if at >= 0 and stack[at][0] in ends:
                    close(at)
            if tag in ("html", "body") and places.get(tag):
                continue
            attributes = m.group(4) or m.group(7) or ""
            above = stack[-1][1] if stack else 0
            if not inline:
                above = self._element(above, tag, attributes, bool(places.get("article") or places.get("main")))
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, above))
            hidden += tag in BOILERPLATE
        flush()


def _step(attributes: str) -> str:
    m = _LABEL.search(attributes) if "=" in attributes else None
    return "." + re.sub(r"\d+", "0", m.group(1) or m.group(2) or m.group(3) or "") if m else ""


def path_scores(page: _Page) -> list[float]:
    """The score of each block's tag path.

    For every root-to-leaf tag path, text length and punctuation are summed over its
    blocks and divided by their number (the two path ratios), leaving out linked text.
    The ratios are fused by their geometric mean, on a log scale, smoothed over
    neighbouring blocks, averaged over the path, and lowered by hints.
    """
    path = [page.path[n] for n in page.node]
    plain = [max(0, len(t) - x) for t, x in zip(page.text, page.linked, strict=True)]
    length: dict[int, int] = {}
    marks: dict[int, int] = {}
    number: dict[int, int] = {}
    for p, text, size in zip(path, page.text, plain, strict=True):
        length[p] = length.get(p, 0) + size
        marks[p] = marks.get(p, 0) + (len(_PUNCTUATION.findall(text)) if size else 0)
        number[p] = number.get(p, 0) + 1
    fused = {
        p: math.sqrt(math.log1p(length[p] / n) * math.log1p(1 + marks[p] / n)) for p, n in number.items()
    }
    raw = [fused[p] for p in path]
    smooth: dict[int, float] = {}
    for i, p in enumerate(path):
        near = raw[max(0, i - 1) : i + 2]
        smooth[p] = smooth.get(p, 0.0) + (3 * raw[i] + sum(near) / len(near)) / 4
    return [smooth[p] / number[p] * page.left[n] for p, n in zip(path, page.node, strict=True)]


def main_text(html: str, share: float = 0.75, most: float = 0.8) -> str:
    """The article's blocks, one a line.

    `path_scores` fuses the ratios of every tag path.  Paths whose score reaches
    ``share`` of the mean score of the page's text are content.  The article is the
    deepest element with ``most`` of the content, weighed by score; if that stands in an
    article or main element, the whole of it.  All blocks in it are kept, short and linked
    ones too, but for those of elements that a hint marks and whose score is not content.

    Without such an element, what stands beside the article belongs to it if it is not
    mostly links and not marked: any block of an element around it, up to the body,
    and of the body itself headings and content.
    """
    page = _Page(html)
    if not page.text:
        return ""
    scores = path_scores(page)
    plain = [max(0, len(t) - x) for t, x in zip(page.text, page.linked, strict=True)]
    weights = [s * x for s, x in zip(scores, plain, strict=True)]
    total = sum(weights)
    if not total:
        return ""
    least = share * sum(s * w for s, w in zip(scores, weights, strict=True)) / total
    content = [s >= least for s in scores]
    held = [0.0] * len(page.parent)
    for n, w, own in zip(page.node, weights, content, strict=True):
        held[n] += w if own else 0.0
    best = [-1] * len(held)
    for n in range(len(held) - 1, 0, -1):
        p = page.parent[n]
        held[p] += held[n]
        if best[p] < 0 or held[n] >= held[best[p]]:
            best[p] = n
    here = 0
    while best[here] >= 0 and held[best[here]] >= most * held[0] and page.tag[best[here]] not in TEXT:
        here = best[here]
    around = [here]
    while page.parent[around[-1]] >= 0:
        around.append(page.parent[around[-1]])
    semantic = next((n for n in around if page.tag[n] in ("article", "main")), None)
    if semantic is not None:
        around = around[around.index(semantic) :]
        here = semantic
    # the innermost element around the article that holds each element too
    meet = [-1] * len(held)
    for n in around:
        meet[n] = n
    kept = []
    for n in range(len(held)):
        if meet[n] < 0:
            meet[n] = meet[page.parent[n]]
    for i, n in enumerate(page.node):
        shared = meet[n]
        if page.left[n] < 0.5 * page.left[shared] and not content[i]:
            continue
        if shared != here:
            if semantic is not None or page.linked[i] > 0.6 * len(page.text[i]):
                continue
            in_body = page.tag[shared] in ("", "html", "body")
            if in_body and not content[i] and page.tag[n] not in HEADING:
                continue
        kept.append(page.text[i])
    return "\n".join(kept)


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Main text of every page: ``id_col``, ``url_col``, ``text``, ``n_chars``.

    The whole html is read (`main_text`), in time linear in its length however deep it
    is.  A null or empty html, or one without text, gives an empty text, and so does one
    that has nothing but links; repeated rows are kept, null ids and urls too; other
    columns are ignored.  A page is one row of one task, so nothing is shuffled.

    Of what the article stands apart from, ``header`` means the page's: a header element
    inside an article or main element holds its title and is kept.
    """
    kinds = [to_arrow_type(pages.schema[c].dataType) for c in (id_col, url_col)]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(h) if h else "" for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(kinds[0]), batch.column(1).cast(kinds[1]),
                    pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()),
                ],
                ["a", "b", "text", "n_chars"],
            )

    a, b = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    return (
        pages.select(F.col(id_col).alias("a"), F.col(url_col).alias("b"), F.col(html_col).alias("h"))
        .mapInArrow(extract, f"a {a}, b {b}, text string, n_chars long")
        .withColumnsRenamed({"a": id_col, "b": url_col})
    )
