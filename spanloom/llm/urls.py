"""URL filters: host and path rules, and block decisions carried to aliases over redirect and canonical-link edges.

Everything is DataFrame expressions, joins and partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, materialize, scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


#: Parts of a reference by RFC 3986, appendix B: scheme, authority, path and query, each with its marks.
_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?"


def _parts(url: Column) -> list[Column]:
    return [F.regexp_extract(url, _PARTS, k) for k in (1, 2, 3, 4)]


def key_of(url: Column) -> Column:
    """A url as a node of the alias graph: scheme and host in lower case, a path, and no fragment."""
    scheme, site, path, query = _parts(url)
    path = F.when((site != "") & (path == ""), F.lit("/")).otherwise(path)
    return F.concat(F.translate(F.concat(scheme, site), UPPER, LOWER), path, query)


def match_rules(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null. rules: (verdict, host, path), a short list.

    A rule fits its host and all subdomains if the path starts with the rule's; of equal lengths the first by text.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]))
    chain = None
    for verdict, rule_host, rule_path in ordered:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        chain = F.when(fits, value) if chain is None else chain.when(fits, value)
    return chain if chain is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments (RFC 3986, 5.2.4); ``..`` at the root stays there."""
    parts = F.split(path, "/", -1)
    last = F.element_at(parts, -1)
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda found, p: F.when(p == ".", found)
        .when(p == "..", F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(1))))
        .otherwise(F.concat(found, F.array(p))),
    )
    closed = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.startswith("/"), F.array_join(closed, "/")).otherwise(path)


def absolute(target: Column, base: Column) -> Column:
    """The reference ``target`` resolved against the absolute url ``base`` (RFC 3986, 5.2.2), without its fragment."""
    scheme, site, path, query = _parts(target)
    own_scheme, own_site, own_path, own_query = _parts(base)
    folder = F.regexp_extract(own_path, r"^(?s)(.*/)", 1)
    folder = F.when((own_site != "") & (own_path == ""), F.lit("/")).otherwise(folder)
    here = site == ""
    merged = (
        F.when(path == "", own_path)
        .when(path.startswith("/"), _without_dots(path))
        .otherwise(_without_dots(F.concat(folder, path)))
    )
    return (
        F.when(scheme != "", F.concat(scheme, site, _without_dots(path), query))
        .when(~here, F.concat(own_scheme, site, _without_dots(path), query))
        .otherwise(
            F.concat(own_scheme, own_site, merged, F.when((path == "") & (query == ""), own_query).otherwise(query))
        )
    )


#: The named character references of HTML that urls hold.
_MARKS = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&", "&colon;": ":", "&sol;": "/", "&num;": "#", "&quest;": "?", "&equals;": "="}
#: Where no tag is a tag: comments, and elements whose content is text. Ended by the end of the page if by nothing else.
_TAG_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_TEXT_ONLY = rf"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title|template|noembed|iframe|xmp)\b{_TAG_REST}.*?(?:</\1\s*>|\z)"
#: An attribute of a tag: a name, and perhaps a value in quotes or bare.
_ATTRIBUTE = r"""[^\s=/>"']+(?:\s*=\s*(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?"""


def _decoded(text: Column) -> Column:
    """A text with its character references read, numeric ones of any code point; each once, so ``&amp;lt;`` is ``&lt;``."""
    parts = F.regexp_extract_all(text, F.lit(r"(?i)&#x[0-9a-f]+;?|&#[0-9]+;?|&[a-z]+;|[^&]+|&"), F.lit(0))

    def one(p: Column) -> Column:
        digits = F.regexp_extract(p, r"(?i)^&#x?([0-9a-f]+)", 1)
        hexed = F.when(p.rlike("(?i)^&#x"), digits).otherwise(F.conv(digits, 10, 16))
        code = F.ltrim(hexed, F.lit("0"))
        point = F.when((F.length(code) > 0) & (F.length(code) <= 6), F.lpad(code, 8, "0"))
        valid = F.conv(point, 16, 10).cast("long")
        point = F.when((valid < 0xD800) | ((valid > 0xDFFF) & (valid <= 0x10FFFF)), point)
        named = F.try_element_at(F.create_map(*(F.lit(x) for kv in _MARKS.items() for x in kv)), F.lower(p))
        return F.when(p.startswith("&#"), F.coalesce(F.decode(F.unhex(point), "UTF-32"), p)).otherwise(F.coalesce(named, p))

    return F.when(F.instr(text, "&") > 0, F.array_join(F.transform(parts, one), "")).otherwise(text)


def _tags(html: Column, name: str) -> Column:
    """The attributes of each tag of a name, as lists of texts ``name=value``."""
    tags = F.regexp_extract_all(html, F.lit(rf"(?is)<{name}\b{_TAG_REST}"), F.lit(0))
    return F.transform(tags, lambda t: F.regexp_extract_all(F.substring(t, F.lit(len(name) + 2), F.length(t)), F.lit(_ATTRIBUTE), F.lit(0)))


def _attribute(attributes: Column, name: str) -> Column:
    """The value of the first attribute of a name, without its quotes; null without one."""
    found = F.try_element_at(F.filter(attributes, lambda a: a.rlike(rf"(?i)^{name}\s*(?:=|$)")), F.lit(1))
    return _decoded(F.regexp_extract(found, r"""(?s)^[^=]*=\s*["']?(.*?)["']?\s*$""", 1))


def page_edges(pages: DataFrame) -> DataFrame:
    """Edges (a, b) from pages' html: the first canonical link and the first meta refresh to another url.

    Tags in comments, scripts and other elements of text don't count. A page whose url has no ``://`` has no edges.
    """
    bare = F.regexp_replace("html", _TEXT_ONLY, "")
    links = F.filter(_tags(bare, "link"), lambda t: F.array_contains(F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical"))
    metas = F.filter(_tags(bare, "meta"), lambda t: F.lower(F.trim(_attribute(t, "http-equiv"))) == "refresh")
    href = F.trim(_attribute(F.try_element_at(links, F.lit(1)), "href"))
    content = _attribute(F.try_element_at(metas, F.lit(1)), "content")
    moved = F.regexp_extract(content, r"""(?is)^[\s\d.]*[;,]?\s*url\s*=\s*["']?([^"'\s]+)""", 1)
    return (
        pages.where("html is not null and instr(url, '://') > 0")
        .select("url", F.explode(F.array(href, moved)).alias("to"))
        .where("to <> ''")
        .select(key_of(F.col("url")).alias("a"), key_of(absolute(F.col("to"), F.col("url"))).alias("b"))
        .where("a <> b")
    )


def judge(
    pages: DataFrame, rules: list[tuple[str, str, str]], redirects: DataFrame | None = None, default: str = "allow"
) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages (page_id, url, html; others are ignored).

    A page with a fitting rule gets that rule's verdict. Any other page takes the decision of its alias group, the
    connected component over redirect edges (``redirects``: a, b) and the canonical and refresh links in html: allow if a
    rule allows any url of the group (explicit allow goes before block), else block if a rule blocks one, else the
    default. A null url, or one without ``://``, has an empty host and path and no aliases. Rows that repeat are judged
    each; urls of any length are judged whole; no rows give no rows.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn(
        "own", match_rules(F.col("host"), F.col("path"), rules)
    )
    with scratch() as here:
        edges = page_edges(pages)
        if redirects is not None:
            edges = edges.union(redirects.select(key_of(F.col("a")), key_of(F.col("b"))))
        edges = materialize(edges.where("a is not null and b is not null and a <> b").distinct(), "url-edges")
        nodes = components(edges)
        ruled = match_rules(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"]
        said = (
            nodes.withColumn("v", ruled)
            .groupBy("root")
            .agg(F.max(F.col("v") == "allow").alias("allowed"), F.max(F.col("v") == "block").alias("blocked"))
            .select("root", F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").alias("group_verdict"))
            .where("group_verdict is not null")
        )
        decided = here.keep(nodes.join(said, "root").select(F.col("node").alias("key"), "group_verdict"), "url-verdicts")
    # a page without a url meets nobody, and goes to a place of its own
    none = F.concat(F.lit("\n"), F.monotonically_increasing_id().cast("string"))
    return (
        judged.withColumn("key", F.when(F.instr("url", "://") > 0, key_of(F.col("url"))).otherwise(none))
        .join(decided, "key", "left")
        .select(
            "page_id", "host", "path", F.col("own.rule").alias("rule"),
            F.coalesce("own.verdict", "group_verdict", F.lit(default)).alias("verdict"),
        )
    )
