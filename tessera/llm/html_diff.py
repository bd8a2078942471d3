"""Main text of web pages by nearest-URL page differencing.

1. A page is cut into lines of text, one for each block element, by a tokenizer that follows the open elements. Each line
   says whether it stands inside article or main, and whether an element, class or role names it as furniture.
2. Pages of a host are sorted by URL path (a range partition of small rows: hashes of lines, no text). A page's partner is
   the neighbour whose path has the longer common prefix; the lines of both, all of them, are aligned by longest common
   subsequence. A neighbour that has COPY of a page's characters is a copy of it and says nothing of the template: the next
   page beyond it is the partner then. Exact copies are compared as one page.
3. Lines that the partner shares are template and are deleted. Lines inside article or main stay even if the partner shares
   them, as two pages may carry the same article or quote the same passage, and the article is wanted whole.
4. What differencing leaves, as of a page without a partner or of menus that differ, goes by its name: lines in elements
   that are named, classed or given the role of page furniture (menus, headers, footers, sidebars, notices, adverts, forms,
   comments). Inside article or main only elements for that, and whole names of adverts, forms, notices and comments, count.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import MOST_PARTITIONS, batched, scoped, stored, text_batches

# Fixed values of HTML: element names by role.
HIDDEN = frozenset({"script", "style", "noscript", "template", "svg", "iframe", "select", "textarea", "datalist", "title"})
RAW = frozenset({"script", "style", "textarea", "title"})
FURNITURE = frozenset({"nav", "footer", "aside", "menu", "dialog", "search"})
OWN = frozenset({"article", "main"})
BLOCKS = frozenset({
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre",
    "search", "section", "summary", "table", "tbody", "tfoot", "thead", "title", "tr", "ul",
})
VOID = frozenset({"area", "base", "basefont", "br", "col", "embed", "frame", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"})
ROLES = frozenset({"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar", "toolbar"})
#: Elements that another of the same kind, or the end of what holds them, closes.
_SELF_CLOSED = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}
#: Words of class and id that name page furniture outside article and main.
MARKS = frozenset({
    "ad", "ads", "advert", "adverts", "advertisement", "adsense", "banner", "banners", "sponsor", "sponsored", "promo", "promotion", "nav", "navbar", "navigation", "menu", "menus",
    "topbar", "toolbar", "breadcrumb", "breadcrumbs", "sidebar", "sidebars", "footer", "header", "masthead", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification",
    "alert", "respond", "reply", "replies", "newsletter", "subscribe", "subscription", "signup", "login", "popup", "modal", "overlay", "share", "adbox", "adslot", "adunit", "adbanner",
    "advertising", "cookiebar", "cookiebanner", "sitenav", "mainnav", "topnav", "subnav", "siteheader", "sitefooter", "pagefooter", "mainmenu", "topmenu", "sharing", "social", "related",
    "recommended", "recommendations", "widget", "widgets", "pagination", "pager", "skip", "copyright", "legal", "disclaimer", "paywall",
})
#: Words of class and id that name comments of readers, wherever they stand.
COMMENTS = frozenset({"comment", "comments", "disqus", "commentlist", "commentform", "commentbox", "commentarea"})
#: Whole names of class and id that count inside article and main too.
INNER = COMMENTS | frozenset({
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsored", "notice", "notices", "cookie-notice", "cookie-banner", "newsletter", "newsletter-form",
    "signup-form", "login-form", "comment-list", "comment-form", "comments-area",
})
#: A class such as with-sidebar says what stands beside its element.
NEGATED = frozenset({"has", "with", "no", "without"})

_COMMENT = r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
_TOKEN = re.compile(_COMMENT + r"|<(/?)([a-zA-Z][^\s/>]*)(?:((?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+))>|([^>]*)(?:>|\Z))", re.S)
#: The same for the rest of a page in which a quote never ends: there a tag ends at the next >.
_PLAIN = re.compile(_COMMENT + r"|<(/?)([a-zA-Z][^\s/>]*)(?:([^>]*)>|([^>]*)\Z)", re.S)
_ENDS = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in HIDDEN}
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))|([^\s=/>"']+)""")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPLIT, _CAMEL = re.compile(r"[^a-z0-9]+"), re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
#: Share of a page's characters from which on a neighbour that has them is a copy.
COPY = 0.9
#: What a line says of itself: it stands inside article or main; its name says furniture; it does wherever it stands.
INSIDE, SOFT, HARD = 1, 2, 4
#: Rows of the alignment's table that are kept for the way back, in bytes; beyond that, parts of it are made anew.
TABLE_BYTES = 16 << 20
#: Pages of a partition of sorted pages, about. Copies of a page on both sides of a cut between two hide what is beyond them.
PART_ROWS = 10_000


def _named(name: str, attributes: str, inside: bool) -> int:
    """Whether an element is furniture: HARD wherever it stands, SOFT unless an article in it says otherwise, else 0."""
    if name in FURNITURE or (name == "form" and inside):
        return HARD
    out = SOFT if name == "form" or (name == "header" and not inside) else 0
    if not attributes or attributes.isspace() or name in ("html", "body"):
        return out
    for key, a, b, c, lone in _ATTRIBUTE.findall(attributes):
        key, value = (key or lone).lower(), a or b or c
        if key in ("class", "id"):
            for token in value.split():
                if (inside or name in OWN) and token.lower() in INNER:
                    return HARD
                if inside or name in OWN:
                    continue
                words = set(_SPLIT.split(_CAMEL.sub("-", token).lower()))
                if words & NEGATED:
                    continue
                if words & COMMENTS:
                    return HARD
                if words & MARKS:
                    out = SOFT
        elif key == "hidden" or (key == "role" and value.lower() in ROLES) or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _UNSEEN.search(value)):
            return HARD
    return out


def lines(page: str | None) -> tuple[list[tuple[str, int]], bool]:
    """((text, what it says of itself) of each block in page order, whether the page has article or main)."""
    page = page or ""
    out, text, stack, missing = [], [], [], set()
    own = soft = hard = 0  # open elements of each kind
    seen, at, token = False, 0, _TOKEN

    def flush() -> None:
        if text:
            raw = "".join(text)
            line = _SPACE.sub(" ", _html.unescape(raw) if "&" in raw else raw).strip()
            if line:
                out.append((line, INSIDE * bool(own) | (SOFT if soft and not own else 0) | HARD * bool(hard)))
            text.clear()

    def pop(to: int) -> None:
        nonlocal own, soft, hard
        while len(stack) > to:
            name, kind = stack.pop()
            own -= name in OWN
            soft -= kind == SOFT
            hard -= kind == HARD

    while m := token.search(page, at):
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        if m[4] is not None:  # a quote without an end: from here on tags end at the next >
            token = _PLAIN
            if not m[0].endswith(">"):
                break
        name = m[2].lower()
        block = name in BLOCKS
        if block:
            flush()
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    flush()
                    pop(i)
                    break
                if name in _SELF_CLOSED and stack[i][0] not in _SELF_CLOSED:
                    break
            continue
        if name in VOID:
            if name == "br":
                text.append(" ")
            continue
        if name in HIDDEN:
            end = None if name in missing else _ENDS[name].search(page, at)
            if end:
                at = end.end()
            elif name in RAW:
                at = len(page)
            else:
                missing.add(name)  # it has no end: what follows is read on, and no later one looks for an end again
            continue
        if name in ("td", "th"):
            text.append(" ")
        if stack and stack[-1][0] in _SELF_CLOSED and name in _SELF_CLOSED[stack[-1][0]]:
            pop(len(stack) - 1)
        if name == "body":  # what the head left open ends here
            pop(0)
        kind = _named(name, m[3] if m[3] is not None else m[4] or "", bool(own))
        if block or kind:
            flush()
            stack.append((name, kind))
            own += name in OWN
            seen = seen or name in OWN
            soft += kind == SOFT
            hard += kind == HARD
    else:
        text.append(page[at:])
    flush()
    return out, seen


def shared(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """The positions in a and in b of a longest common subsequence, by the bit-parallel table of its lengths: a bit for each
    member of b, a row for each of a. Members that the other has not are left out first, equal ends are set aside. Time is
    in proportion to the product of the lengths by the bits of a machine word, whatever repeats."""
    in_a, in_b = set(a), set(b)
    i_of, j_of = [i for i, x in enumerate(a) if x in in_b], [j for j, x in enumerate(b) if x in in_a]
    a, b = [a[i] for i in i_of], [b[j] for j in j_of]
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    mid = _aligned(a[head : len(a) - tail], b[head : len(b) - tail])
    pairs = [(i, i) for i in range(head)] + [(i + head, j + head) for i, j in mid] + [(len(a) - tail + i, len(b) - tail + i) for i in range(tail)]
    return [i_of[i] for i, _ in pairs], [j_of[j] for _, j in pairs]


def _aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    n, m = len(a), len(b)
    if not n or not m:
        return []
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    often: dict[int, int] = {}

    def bits(x: int) -> int:
        if x in often:
            return often[x]
        out = 0
        for j in places.get(x, ()):
            out |= 1 << j
        if len(places.get(x, ())) >= 64:
            often[x] = out
        return out

    full = (1 << m) - 1

    def rows(v: int, start: int, stop: int) -> list[int]:
        """The table's rows after the members start to stop - 1, from the row v before them."""
        out = [v]
        for x in a[start:stop]:
            u = v & bits(x)
            v = ((v + u) | (v - u)) & full
            out.append(v)
        return out

    # Only every step-th row is kept at once; the rows between are made anew on the way back.
    step = n if n * m <= 8 * TABLE_BYTES else max(1, int(n**0.5))
    marks, v = [], full
    for start in range(0, n, step):
        marks.append(v)
        v = rows(v, start, min(start + step, n))[-1] if start + step < n else v
    pairs, j = [], m
    for block in range(len(marks) - 1, -1, -1):
        start = block * step
        table = rows(marks[block], start, min(start + step, n))
        i = min(start + step, n)
        while i > start and j > 0:
            if a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
                pairs.append((i, j))
            elif table[i - start] >> (j - 1) & 1:  # the length does not grow with b's member
                j -= 1
            else:
                i -= 1
    return pairs[::-1]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for key, url, page in zip(*b.columns, strict=True):
            found, seen = lines(page.as_py())
            yield key.as_py(), url.as_py(), seen, [x for x, _ in found], [f for _, f in found]


def _prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


# Rows of a page to compare: content, host, path, hashes and sizes and kinds of its lines.
_ID, _HOST, _PATH, _HASHES, _SIZES, _KINDS = range(6)


def _compared(a: tuple, b: tuple) -> tuple[tuple | None, tuple | None]:
    """For either row (content, closeness of the paths, which lines the other shares, the other's content), or None if the
    other is a copy of it."""
    near, found = _prefix(a[_PATH], b[_PATH]), shared(a[_HASHES], b[_HASHES])
    out = []
    for row, other, at in ((a, b, found[0]), (b, a, found[1])):
        if sum(row[_SIZES][x] for x in at) >= COPY * sum(row[_SIZES]):
            out.append(None)
            continue
        gone = [False] * len(row[_HASHES])
        for x in at:
            gone[x] = not row[_KINDS][x] & INSIDE
        out.append((row[_ID], near, gone, other[_ID]))
    return out[0], out[1]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Compares the rows of a sorted partition one after the other; gives its first and last row on, as edges.

    A row is compared with the one before it, or, if that is a copy of it, with the partner of that one. Rows of a run of copies
    that found none so (at the start of a host or partition) wait for the first row after the run.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    first = last = left = None
    waiting: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            partner = None
            if last is None or last[_HOST] != row[_HOST]:
                waiting = []
            else:
                back, own = _compared(last, row)
                if own:
                    yield (*own, None, None, *[None] * 5)
                    partner = last
                elif left is not None and (own := _compared(left, row)[1]):
                    yield (*own, None, None, *[None] * 5)
                    partner = left
                if back:
                    yield (*back, None, None, *[None] * 5)
                if own and partner is last:
                    for r in waiting:
                        if r is not last and (late := _compared(r, row)[0]):
                            yield (*late, None, None, *[None] * 5)
                    waiting = []
            if partner is None:
                waiting.append(row)
            first, last, left = first or row, row, partner
    for row, end in ((first, 0), (last, 1)):
        if row is not None:
            yield row[_ID], None, None, None, part, end, *row[1:6]


_ROW = "content binary, host string, path string, hashes array<long>, sizes array<int>, kinds array<int>"


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The last row of a partition against the first of the next."""
    for b in batches:
        for a, c in zip(*(x.to_pylist() for x in b.columns), strict=True):
            a, c = tuple(a.values()), tuple(c.values())
            if a[_HOST] == c[_HOST]:
                yield from (x for x in _compared(a, c) if x)


def template_lines(rows: DataFrame) -> DataFrame:
    """content, gone (for each line whether it is deleted) for rows of content, host, path, hashes, sizes, kinds.

    Of two neighbours with equally long common prefixes of the path, the one that shares more lines is the partner, then the
    one of greater content. Rows that are copies of all their neighbours, and alone on their host, are not in the result.
    """
    spark = rows.sparkSession
    found = "content binary, near int, gone array<boolean>, partner binary"
    lists = {"hashes": pa.int64(), "sizes": pa.int32(), "kinds": pa.int32()}
    schema = pa.schema([("content", pa.binary()), ("near", pa.int32()), ("gone", pa.list_(pa.bool_())), ("partner", pa.binary())])
    wide = pa.schema([*schema, ("part", pa.int32()), ("last", pa.int32()), ("host", pa.string()), ("path", pa.string()), *((k, pa.list_(t)) for k, t in lists.items())])
    rows = stored(rows)
    done = rows.repartitionByRange(max(1, min(-(-rows.count() // PART_ROWS), MOST_PARTITIONS)), "host", "path", "content").sortWithinPartitions("host", "path", "content").mapInArrow(batched(_neighbours, wide), found + ", part int, last int, " + _ROW.split(", ", 1)[1])
    done = stored(done)
    # Neighbours across partitions: only the numbers of the partitions that have rows come to the driver.
    parts = sorted(r["part"] for r in done.filter("last = 1").select("part").collect())
    after = spark.createDataFrame(list(zip(parts, parts[1:], strict=False)), "part int, after int")
    row = F.struct(*[F.col(c.split()[0]) for c in _ROW.split(", ")])
    lasts, firsts = (done.filter(F.col("last") == end).select("part", row.alias(name)) for end, name in ((1, "a"), (0, "b")))
    edges = lasts.join(F.broadcast(after), "part").join(firsts.withColumnRenamed("part", "after"), "after").select("a", "b")
    pairs = done.filter("part is null").select("content", "near", "gone", "partner").unionByName(edges.mapInArrow(batched(_across, schema), found))
    return pairs.groupBy("content").agg(F.max_by("gone", F.struct("near", F.size(F.filter("gone", lambda x: x)), "partner")).alias("gone"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, url, text (the main text of every page, blocks joined by an empty line), n_template and n_named: how many lines
    differencing deleted, and how many of the others their names.

    One row per row of pages, repeated ones included; other columns are not read. A null or empty html, or one without text
    outside furniture, gives "". A page without a partner (alone on its host, between copies of itself, or with a null url,
    whose host and path are empty) loses furniture by name only. Of a page without article or main in which names would leave
    nothing, only names that hold wherever they stand are heeded.
    """
    spark = pages.sparkSession
    text_batches(spark)
    kind = pages.schema[key].dataType
    schema = pa.schema([("key", to_arrow_type(kind)), ("url", pa.string()), ("own", pa.bool_()), ("lines", pa.list_(pa.string())), ("kinds", pa.list_(pa.int32()))])
    types = T.StructType([T.StructField("key", kind), *T._parse_datatype_string("url string, own boolean, lines array<string>, kinds array<int>").fields])
    parsed = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html")).mapInArrow(batched(_parsed, schema), types)
    after = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://(.*)$", 1)
    parsed = parsed.withColumns({"host": F.lower(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)), "path": F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)})
    # Pages of one host with the same lines are one to compare: that with the smallest path.
    whole = F.unhex(F.md5(F.concat_ws("\x01", "host", F.array_join("lines", "\x02"), F.array_join(F.col("kinds").cast("array<string>"), "")).cast("binary")))
    parsed = stored(parsed.withColumn("content", whole))
    with scoped(spark) as scope:
        rows = parsed.filter("host <> '' and size(lines) > 0").select("content", "host", "path", F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"), F.transform("lines", lambda x: F.length(x)).alias("sizes"), "kinds")
        once = rows.groupBy("content").agg(F.min(F.struct("path", "host", "hashes", "sizes", "kinds")).alias("page"))
        gone = template_lines(once.select("content", "page.host", "page.path", "page.hashes", "page.sizes", "page.kinds"))
        gone = scope.keep(gone.filter(F.exists("gone", lambda x: x)))
    joined = parsed.join(gone, "content", "left")
    kept = lambda names: F.filter("lines", lambda x, i: ~F.coalesce(F.get("gone", i), F.lit(False)) & (F.get("kinds", i).bitwiseAND(F.lit(names)) == 0))
    joined = joined.withColumn("main", kept(SOFT | HARD))
    joined = joined.withColumn("main", F.when((F.size("main") == 0) & ~F.col("own"), kept(HARD)).otherwise(F.col("main")))
    template = F.coalesce(F.size(F.filter("gone", lambda x: x)), F.lit(0))
    out = joined.select("key", "url", F.array_join("main", "\n\n").alias("text"), F.greatest(template, F.lit(0)).alias("n_template"), (F.size("lines") - F.size("main") - F.greatest(template, F.lit(0))).alias("n_named"))
    return out.withColumnRenamed("key", key)
