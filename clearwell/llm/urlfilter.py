"""URL filters: block rules carried over redirect and canonical-link edges to aliases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import connected_components, written

Rule = tuple[str, str, str]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``? #`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null.

    A rule (verdict, host, path) fits its host and all subdomains if the path starts
    with the rule's.  Of rules of one length the first in code-point order wins, an
    allow rule before a block rule with the same text.
    """
    fitting = F.lit(None).cast("struct<rule:string,verdict:string>")
    order = sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]], r[0] == "allow"))
    for verdict, rule_host, rule_path in order:  # later ones win
        own = (host == rule_host) | host.endswith("." + rule_host)
        fits = own & path.startswith(rule_path)
        hit = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        fitting = F.when(fits, hit).otherwise(fitting)
    return fitting


def unescaped(text: Column) -> Column:
    """Numeric character references and the five named ones of markup, decoded once; others stay."""
    named = F.create_map(*[F.lit(x) for pair in zip(("amp", "lt", "gt", "quot", "apos"), "&<>\"'") for x in pair])
    reference = r"&(?:#[xX]0*[0-9a-fA-F]{1,6}|#0*[0-9]{1,7}|amp|lt|gt|quot|apos);"

    def decoded(piece: Column) -> Column:
        hexadecimal = F.nullif(F.regexp_extract(piece, r"^&#[xX]0*([0-9a-fA-F]+);$", 1), F.lit(""))
        decimal = F.nullif(F.regexp_extract(piece, r"^&#0*([0-9]+);$", 1), F.lit(""))
        code = F.coalesce(F.conv(hexadecimal, 16, 10), decimal).cast("long")
        fit = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        # four bytes a character
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(fit, code)), 8, "0")), "UTF-32")
        return F.coalesce(char, F.try_element_at(named, F.regexp_extract(piece, "^&([a-z]+);$", 1)), piece)

    pieces = F.regexp_extract_all(text, F.lit(f"(?s)({reference}|[^&]+|&)"), F.lit(1))
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, decoded), "")).otherwise(text)


def without_dots(path: Column) -> Column:
    """A path from ``/`` on with its segments ``.`` and ``..`` folded."""
    steps = F.split(F.concat(path, F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")), "/", -1)

    def fold(done: Column, step: Column) -> Column:
        return (
            F.when(step == ".", done)
            .when(step == "..", F.slice(done, 1, F.greatest(F.lit(1), F.size(done) - 1)))
            .otherwise(F.concat(done, F.array(step)))
        )

    # the first is the empty one before the leading slash, which stays
    folded = F.aggregate(F.slice(steps, 2, F.size(steps)), F.array(F.lit("")), fold)
    return F.when(path.contains("/."), F.array_join(folded, "/")).otherwise(path)


def html_links(html: Column, url: Column) -> Column:
    """Targets of canonical links and immediate refreshes in a page, made absolute.

    Character references are decoded.  Targets relative to the page's path or query are
    resolved against its url, and dots in relative paths are folded; a target that
    is only a fragment, or of a scheme without ``//``, is none.
    """
    text = F.coalesce(html, F.lit(""))
    quoted = r"""["']?([^"'\s>]+)"""
    tags = F.regexp_extract_all(text, F.lit(r"(?is)(<(?:link|meta)\b[^>]*>)"), F.lit(1))
    # canonical among the words of rel
    rel = r"""(?is)^<link\b.*(?<![\w-])rel\s*=\s*(?:"(?:[^"]*\s)?canonical[\s"]|'(?:[^']*\s)?canonical[\s']|canonical[\s/>])"""
    canonical = F.transform(
        F.filter(tags, lambda t: t.rlike(rel)),
        lambda t: F.regexp_extract(t, r"(?is)\bhref\s*=\s*" + quoted, 1),
    )
    refresh = F.transform(
        F.filter(tags, lambda t: t.rlike(r"""(?is)^<meta\b.*\bhttp-equiv\s*=\s*["']?refresh\b""")),
        lambda t: F.regexp_extract(t, r"(?is)\burl\s*=\s*['\"]?((?:&#?\w+;|[^\"'\s>;])+)", 1),
    )
    scheme = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(.*?)://", 1)
    root = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(.*?://[^/?#]*)", 1)
    page = F.coalesce(url_path(url), F.lit(""))
    folder = F.coalesce(F.nullif(F.regexp_extract(page, r"(?s)^(.*/)", 1), F.lit("")), F.lit("/"))

    def resolved(target: Column) -> Column:
        path = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
        rest = F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
        return (
            F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when((target == "") | (root == "") | target.startswith("#"), None)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(root, without_dots(path), rest))
            .when(target.startswith("?"), F.concat(root, page, target))
            .when(~target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(root, without_dots(F.concat(folder, path)), rest))
        )

    targets = F.transform(F.concat(canonical, refresh), unescaped)
    found = F.transform(targets, resolved)
    return F.filter(found, lambda t: t.isNotNull() & (t != ""))


def alias_key(url: Column) -> Column:
    """What makes two spellings one address: host, path and query, no scheme or fragment."""
    query = F.coalesce(F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1), F.lit(""))
    return F.when(url.contains("://"), F.concat(url_host(url), url_path(url), query))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    edges: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str | None = "html",
    default: str = "allow",
) -> DataFrame:
    """The verdict on every page: ``id_col``, ``host``, ``path``, ``rule``, ``verdict``, ``via``.

    A fitting rule decides a page itself (``via`` = rule).  Other pages follow their
    component over redirect and canonical-link edges (``via`` = alias): block if some
    address in it is blocked by a rule and none is allowed by one.  The rest get
    ``default``.  Edges come from the pages' html and from ``edges`` (two columns of
    urls), and may lead through addresses that are no page.

    A null url, or one without ``://``, has empty host and path and no aliases;
    repeated rows are judged alike; an empty table gives no rows; other columns are
    ignored.  Everything is DataFrame expressions: components are iterated minima with
    a checkpoint a step, verdicts are combined before each shuffle, so a hot host or
    a hub costs no task more than its share.
    """
    url = F.col(url_col)
    seen = [F.col(id_col).alias("id"), url.alias("url")]
    links = pages.select(*seen)
    if html_col is not None:
        links = pages.select(*seen, html_links(F.col(html_col), url).alias("links"))
        found = links.select("url", F.explode("links").alias("to")).select(
            alias_key(F.col("url")).alias("a"), alias_key(F.col("to")).alias("b")
        )
    else:
        found = None
    if edges is not None:
        a, b = edges.columns
        given = edges.select(alias_key(F.col(a)).alias("a"), alias_key(F.col(b)).alias("b"))
        found = given if found is None else found.unionByName(given)
    judged = pages.select(*seen).select(
        "id",
        "url",
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
    )
    judged = judged.withColumn("hit", rule_for(F.col("host"), F.col("path"), rules))
    own = F.col("hit.verdict")
    if found is None:
        alias = judged.withColumn("alias", F.lit(None).cast("string"))
    else:
        verdicts = _component_verdicts(written(found.where("a IS NOT NULL AND b IS NOT NULL"), "links"), rules)
        alias = judged.withColumn("node", alias_key(F.col("url"))).join(verdicts, "node", "left")
    return alias.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce(own, F.col("alias"), F.lit(default)).alias("verdict"),
        F.when(own.isNotNull(), "rule").when(F.col("alias").isNotNull(), "alias").otherwise("default").alias("via"),
    )


def _component_verdicts(links: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``node``, ``alias``: the verdict that an address inherits, for addresses in components."""
    nodes = connected_components(links)
    # a node is host + path + query
    host = F.regexp_extract("node", r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract("node", r"(?s)^[^/?#]*([^?#]*)", 1)
    ruled = nodes.withColumn("own", rule_for(host, path, rules)["verdict"])
    by_component = ruled.groupBy("component").agg(
        F.max(F.col("own") == "block").alias("blocked"), F.max(F.col("own") == "allow").alias("allowed")
    )
    verdict = F.when(F.col("blocked") & ~F.coalesce("allowed", F.lit(False)), "block").when(
        F.col("allowed"), "allow"
    )
    return nodes.join(by_component, "component").select("node", verdict.alias("alias"))
