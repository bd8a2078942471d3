"""URL filters with redirect equivalence.

Rules judge a URL by host and path. Pages also say which URLs are one resource: a canonical link, or a refresh that
redirects. The URLs joined by such edges, however long the chain, form components (distributed, see components.py); a
URL that no rule fits is blocked when a rule blocks any URL of its component. A rule that fits the URL itself always
decides, so an explicit allow stands against a block that an alias would pass on. All else is allowed.

Everything is column expressions and joins; rules are a literal of the plan, so they are meant to be thousands at most.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_name, stored
from tessera.operators.components import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str  # from its first slash on

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    """A rule from `host/path`."""
    host, slash, path = text.partition("/")
    return Rule(verdict, host.translate(str.maketrans(_UPPER, _LOWER)), slash + path)


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path: what stands after the first `://` up to / ? # or the end, A-Z lower-cased; then up to ? # or the end."""
    has = F.coalesce(url.contains("://"), F.lit(False))
    rest = _after(url)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit(""))


def _after(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)


def fitting(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct<n, allow, name> of the longest rule that fits, or null; of equal lengths an allow wins."""
    if not rules:
        return F.lit(None).cast("struct<n:int,allow:boolean,name:string>")
    known = F.array(*[F.struct(F.lit(len(r.name)).alias("n"), F.lit(r.verdict == "allow").alias("allow"), F.lit(r.name).alias("name"), F.lit(r.host).alias("host"), F.lit(r.path).alias("path")) for r in rules])
    fits = F.filter(known, lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))) & path.startswith(r["path"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(r["n"], r["allow"], r["name"])))


def _without_dots(path: Column) -> Column:
    """A path from its first slash on without `.` and `..` segments (RFC 3986, 5.2.4)."""
    parts = F.split(F.substring(path, 2, F.length(path)), "/")
    empty = F.array().cast("array<string>")
    kept = F.aggregate(parts, empty, lambda done, x: F.when(x == ".", done).when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(x))))
    # A path that ends in a dot segment ends in a slash.
    last = F.element_at(parts, -1)
    kept = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.contains("/."), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def node(url: Column) -> Column:
    """A URL as a node: without scheme and fragment, host lower-cased, path without dot segments, an empty one as /; null
    without a host."""
    rest = _after(url)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"(?s)^[^?#]*(\?[^#]*)", 1)
    return F.when(host != "", F.concat(host, F.when(path == "", F.lit("/")).otherwise(_without_dots(path)), query))


def absolute(target: Column, base: Column) -> Column:
    """A link's target as a URL, relative ones against the URL of the page, as RFC 3986 resolves them."""
    scheme = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
    root = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    asked = F.regexp_extract(base, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    own = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    rest = F.substring(target, F.length(own) + 1, F.length(target))
    merged = F.when(own.startswith("/"), own).otherwise(F.concat(folder, own))
    whole = F.when(target.rlike(scheme + "//"), target).when(target.startswith("//"), F.concat(F.regexp_extract(base, r"(?s)^(.*?:)//", 1), target))
    head = F.regexp_extract(whole, r"(?s)^(.*?://[^/?#]*)", 1)
    tail = F.regexp_extract(whole, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    more = F.substring(whole, F.length(head) + F.length(tail) + 1, F.length(whole))
    return (
        F.when(whole.isNotNull(), F.concat(head, _without_dots(tail), more))
        .when(target.rlike(scheme) | (target == ""), F.lit(None).cast("string"))  # mailto: and the like name no page
        .when(own != "", F.concat(root, _without_dots(merged), rest))
        .when(target.startswith("?"), F.concat(root, path, target))
        .otherwise(F.concat(root, path, asked, target))
    )


#: An attribute's value: in either kind of quotes, to the next white space or > else.
_VALUE = r"""\b{0}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^"'\s>][^\s>]*))"""
_TAG = r"""(?:[^>"']|"[^"]*"|'[^']*')*"""


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a tag; empty if it has none."""
    pattern = "(?is)" + (r"""^<\w+(?:\s+[^\s=>"'/]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^"'\s>][^\s>]*))?|\s|/)*?\s""" + _VALUE.format(name)[2:])
    return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])


def _references(value: Column) -> Column:
    return F.trim(F.replace(value, F.lit("&amp;"), F.lit("&")))


def targets(html: Column) -> Column:
    """The targets of a page's first canonical link and first refresh outside of comments and scripts (empty strings where
    there is none): `rel` is a list of words, quoted values are read whole."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\b|\z)", "")
    links = F.regexp_extract_all(bare, F.lit(rf"(?is)(<link\b{_TAG}>)"), 1)
    metas = F.regexp_extract_all(bare, F.lit(rf"(?is)(<meta\b{_TAG}>)"), 1)
    link = F.get(F.filter(links, lambda x: F.array_contains(F.split(F.lower(_attribute(x, "rel")), r"\s+"), "canonical")), F.lit(0))
    meta = F.get(F.filter(metas, lambda x: F.lower(F.trim(_attribute(x, "http-equiv"))) == "refresh"), F.lit(0))
    to = F.regexp_extract(_attribute(meta, "content"), r"""(?is)^[\s\d.]*[;,\s]\s*url\s*=\s*["']?\s*([^"']*)""", 1)
    has = lambda tag: F.contains(F.lower(html), F.lit(tag))  # noqa: E731 - most pages have neither
    return F.array(F.when(has("canonical"), _references(F.coalesce(_attribute(link, "href"), F.lit("")))).otherwise(F.lit("")), F.when(has("refresh"), _references(F.coalesce(to, F.lit("")))).otherwise(F.lit("")))


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", html: str = "html") -> DataFrame:
    """pages with host, path, rule (the name of the rule that fits, else null) and verdict (allow or block).

    One row per row of pages, repeated ones included; columns of these four names are replaced. A url that is null or
    without `://` has empty host and path, no rule and no alias, so it is allowed. A null html has no edges.
    """
    host, path = parts(F.col(url))
    best, own, passed = (free_name(pages, x) for x in ("best", "own_node", "passed_on"))
    named = pages.withColumns({"host": host, "path": path}).withColumns({best: fitting(F.col("host"), F.col("path"), rules), own: node(F.col(url))})
    links = pages.select(F.col(url).alias("url"), F.explode(targets(F.col(html))).alias("target")).filter("target <> ''")
    # Step by step: as one expression it is more code than the JVM takes for a method.
    edges = links.withColumn("to", absolute(F.col("target"), F.col("url"))).withColumn("a", node(F.col("url"))).withColumn("b", node(F.col("to"))).select("a", "b").filter("a <> b").distinct()
    edges = stored(edges)
    roots = components(edges)
    h = F.regexp_extract("node", r"(?s)^([^/]*)", 1)
    p = F.regexp_extract("node", r"(?s)^[^/]*([^?]*)", 1)
    blocked = roots.withColumn("fit", fitting(h, p, rules)).groupBy("root").agg(F.bool_or(~F.col("fit.allow")).alias("bad")).filter("bad").select("root")
    bad = stored(roots.join(blocked, "root", "left_semi").select(F.col("node").alias(own)).distinct().withColumn(passed, F.lit(True)))
    # Rows without a host have no node; they are dealt by their path, not all to the task of a null.
    salted = F.coalesce(F.col(own), F.concat(F.lit("\x00"), F.xxhash64(url).cast("string")))
    judged = named.withColumn(own, salted).join(bad, own, "left")
    by_rule = F.when(F.col(f"{best}.allow"), "allow").otherwise("block")
    verdict = F.when(F.col(best).isNotNull(), by_rule).when(F.col(passed), "block").otherwise("allow")
    return judged.withColumns({"rule": F.col(f"{best}.name"), "verdict": verdict}).drop(best, own, passed)
