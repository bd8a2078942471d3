import itertools
import random
import re
import time

import pytest

from tessera.llm import html_diff, queries


def text(page):
    """What names leave of a page that has no partner."""
    found, own = html_diff.lines(page)
    kept = [x for x, kind in found if not kind & (html_diff.SOFT | html_diff.HARD)]
    return "\n\n".join(kept or ([] if own else [x for x, kind in found if not kind & html_diff.HARD]))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b<br>c&nbsp;d", "a\n\nb c d"),
        ("<html><head><meta charset=x><title>t</title><style>p{}</style></head><body><nav>menu</nav><article><h1>T</h1><p>one<b> two</b></p></article><footer>f</footer>", "T\n\none two"),
        ("<script>var a = '<p>no</p>';</script><p>yes</p>", "yes"),
        ("<!-- <p>no --><p>x &lt;b&gt; &#233; &#x41;</p><!-- open", "x <b> é A"),
        ('<div class="ad">no</div><div class="lead">yes</div><p class="cookie-notice">no<p>too', "yes\n\ntoo"),
        ('<div id="comments"><p>no<p>no</div><div role="navigation">no</div><form><label>no</label></form><p>yes', "yes"),
        ("<header>site</header><main><header><h1>kept</h1></header>x</main><aside>no</aside>", "kept\n\nx"),
        ("<nav><ul><li>open<article>in nav</article></nav><p>out", "out"),
        ("<article><p>cut <b", "cut"),
        ("<article>1 < 2 and <3</article>", "1 < 2 and <3"),
        ('<a title="a>b">link</a> text', "link text"),
        ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</table>", "a b\n\nc"),
        ("<ul><li>a<li>b</ul><pre> x\n\ty </pre>", "a\n\nb\n\nx y"),
        ("<textarea>no</textarea><noscript>no</noscript><p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
        ('<div class="page with-sidebar"><p>yes</p><div class="leftSidebar">no</div></div>', "yes"),
        ("a<p class=share-buttons>no</p></div></span>b", "a\n\nb"),
        # Inside an article names of other things say nothing, whole names of adverts, forms, notices and comments do.
        ('<article><div class="legal-history">a</div><p id="social-contract">b<p class="menu">c<p class="alert related banner">d</article>', "a\n\nb\n\nc\n\nd"),
        ('<article><p>a<math><mi>x</mi></math><button>go</button> <canvas>c</canvas><object>o</object></article>', "axgo co"),
        ('<article>a<div class="ad">no</div><div id=comments>no</div><form>no</form><p class="notice">no</p><aside>no</aside><footer>no</footer>b</article>', "a\n\nb"),
        # A name on a wrapper does not take the article in it along, unless it is one that holds everywhere.
        ('<div class="layout sidebar-right">no<article>yes</article>no</div><form><main>too</main></form>', "yes\n\ntoo"),
        ('<div class="comments"><article>no</article></div><article class="comment">no</article><main>yes</main>', "yes"),
        ('<div class="sidebar-layout"><p>all there is</p></div><nav>no</nav>', "all there is"),
        ('<div class="sidebar-layout"><p>named</p></div><article></article>', ""),
        ("<head><title>t</title><p>no head holds this</p>", "no head holds this"),
        ("<p>a</p><p title='b>c</p><p>d", "a\n\nc\n\nd"),
        ("<svg><p>read on</p><svg><p>and on", "read on\n\nand on"),
    ],
)
def test_lines(page, want):
    assert text(page) == want


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@pytest.mark.parametrize("seed", range(20))
def test_longest_common_subsequence(seed):
    r = random.Random(seed)
    a, b = ([r.randint(0, 6) for _ in range(r.randint(0, 25))] for _ in range(2))
    i, j = html_diff.shared(a, b)
    assert [a[x] for x in i] == [b[x] for x in j] and len(i) == lcs(a, b)
    assert i == sorted(set(i)) and j == sorted(set(j))


def test_template_goes_by_difference(spark):
    page = "<div>Shop of things</div><div>Welcome back</div><div>{}</div><div>{}</div><div>Call us any time</div>"
    rows = [(i, f"https://a.example/p/{i:02}", page.format(f"Item {i} is fine", f"It has size {i * 7}"), "x") for i in range(12)]
    rows += [(50, None, page.format("a", "b"), "x"), (51, "https://alone.example/x", "<div>Only page</div>", "x"), (52, "https://a.example/p/03", None, "x"), (53, "no url", "", "x"), (0, *rows[0][1:])]
    got = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(3)
    done = html_diff.extract(got).collect()
    assert {r.page_id: r.n_template for r in done} == {**dict.fromkeys(range(12), 3), 50: 0, 51: 0, 52: 0, 53: 0}
    out = [(r.page_id, r.text) for r in done]
    want = [(i, f"Item {i} is fine\n\nIt has size {i * 7}") for i in range(12)]
    want += [(50, "Shop of things\n\nWelcome back\n\na\n\nb\n\nCall us any time"), (51, "Only page"), (52, ""), (53, ""), want[0]]
    assert sorted(out) == sorted(want)


def test_shared_article_stays(spark):
    page = "<nav>m</nav><article><p>{}</p><p>quoted by all</p></article><div>same foot</div>"
    rows = [(i, f"http://h.example/{i}", page.format("same text")) for i in range(4)] + [(4, "http://h.example/4", page.format("and quite another text of its own"))]
    out = html_diff.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text) for r in out) == [*((i, "same text\n\nquoted by all") for i in range(4)), (4, "and quite another text of its own\n\nquoted by all")]


def test_differencing_decides_named_and_unnamed_lines(spark):
    """Menus that neighbours share go by difference, those that differ by name; a mirror of a page is not its partner."""
    page = "<nav><ul><li>Home<li>{}</ul></nav><div>Shop of things and more</div><article><p>{}</p></article><div>Call us</div>"
    tale = "A tale of the sea, long enough to be most of its page, and told under two addresses to the very end of it."
    rows = [(0, "http://h.example/a/1", page.format("One", tale)), (1, "http://h.example/a/2", page.format("Two", tale)), (2, "http://h.example/a/3", page.format("Three", "Something else"))]
    rows += [(3, "http://h.example/b", page.format("Four", "Quite another"))]
    got = {r.page_id: (r.text, r.n_template, r.n_named) for r in html_diff.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: (tale, 3, 1), 1: (tale, 3, 1), 2: ("Something else", 3, 1), 3: ("Quite another", 3, 1)}


def test_neighbours_across_partitions(spark, monkeypatch):
    """The last page of a partition and the first of the next are neighbours, however few pages a partition has."""
    rows = [(i, f"http://h.example/{i:03}", f"<div>Template line of the host</div><div>Own words of page {i}, enough of them</div>") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    monkeypatch.setattr(html_diff, "PART_ROWS", 3)
    got = {r.page_id: (r.text, r.n_template) for r in html_diff.extract(df).collect()}
    assert got == {i: (f"Own words of page {i}, enough of them", 1) for i in range(40)}


def brute(rows):
    """Which lines of sorted pages of one host go: of all pairs of neighbours by the rule, with no partition between."""
    out = {}
    left = {}
    for n, cur in enumerate(rows):
        for other in ([rows[n - 1], left.get(rows[n - 1][0])] if n else []):
            if other and (got := html_diff._compared(other, cur)[1]):
                out.setdefault(cur[0], []).append(got[1:])
                left[cur[0]] = other
                break
    for n, cur in enumerate(rows[:-1]):
        if got := html_diff._compared(cur, rows[n + 1])[0]:
            out.setdefault(cur[0], []).append(got[1:])
        elif cur[0] not in left:
            after = next((r for m, r in enumerate(rows[n + 1 :], n + 1) if not html_diff._compared(r, rows[m - 1])[0] is None), None)
            if after and (got := html_diff._compared(cur, after)[0]):
                out.setdefault(cur[0], []).append(got[1:])
    return {k: max(v, key=lambda x: (x[0], sum(x[1]), x[2]))[1] for k, v in out.items()}


@pytest.mark.parametrize("seed", range(4))
def test_partners_against_brute_force(spark, seed):
    """One partition of random pages with many ties and copies, against the rule read plainly."""
    r = random.Random(seed)
    rows = sorted(((bytes([i]), "h", f"/{r.randint(0, 3)}{r.randint(0, 9)}", [r.randint(0, 8) for _ in range(r.randint(1, 6))]) for i in range(40)), key=lambda x: (x[2].encode(), x[0]))
    rows = [(*x, [5] * len(x[3]), [0] * len(x[3])) for x in rows]
    df = spark.createDataFrame(rows, html_diff._ROW).coalesce(1)
    found = df.sortWithinPartitions("host", "path", "content").mapInArrow(html_diff.batched(html_diff._neighbours, html_diff.pa.schema([("content", html_diff.pa.binary()), ("near", html_diff.pa.int32()), ("gone", html_diff.pa.list_(html_diff.pa.bool_())), ("partner", html_diff.pa.binary()), ("part", html_diff.pa.int32()), ("last", html_diff.pa.int32()), ("host", html_diff.pa.string()), ("path", html_diff.pa.string()), *((k, html_diff.pa.list_(t)) for k, t in (("hashes", html_diff.pa.int64()), ("sizes", html_diff.pa.int32()), ("kinds", html_diff.pa.int32())))])), "content binary, near int, gone array<boolean>, partner binary, part int, last int, " + html_diff._ROW.split(", ", 1)[1])
    got = {}
    for x in found.filter("part is null").collect():
        got.setdefault(bytes(x.content), []).append((x.near, sum(x.gone), bytes(x.partner), x.gone))
    want = brute(rows)
    assert {k: max(v)[3] for k, v in got.items()} == want


def test_long_pages_in_linear_time():
    began = time.perf_counter()
    a, b = [0, 1] * 1500, [1, 0, 0] * 1000
    assert len(html_diff.shared(a, b)[0]) >= 1990
    r = random.Random(1)
    x = [r.randint(0, 10**9) for _ in range(6000)]
    moved = x[3000:] + x[:3000]
    assert html_diff.shared(x, moved)[0] in (list(range(3000)), list(range(3000, 6000)))
    for unclosed in ("<svg>", "<a title='", "<noscript><p>x", "<textarea"):
        html_diff.lines("<p>some text</p>" + unclosed * 6000)
    assert len(html_diff.lines("<p>a line of text" * 100_000)[0]) == 100_000
    assert time.perf_counter() - began < 20


@pytest.mark.parametrize("limit", [1, 1 << 20])
def test_alignment_from_parts_of_its_table(monkeypatch, limit):
    monkeypatch.setattr(html_diff, "TABLE_BYTES", limit)
    for seed in range(30):
        r = random.Random(seed)
        a, b = ([r.randint(0, 4) for _ in range(r.randint(0, 40))] for _ in range(2))
        i, j = html_diff.shared(a, b)
        assert [a[x] for x in i] == [b[x] for x in j] and len(i) == lcs(a, b) and i == sorted(set(i)) and j == sorted(set(j))


def test_copies_keep_their_lines(spark):
    """Pages without article that are copies under neighbouring URLs lose what they share with other pages only."""
    page = "<div>Shop of things</div><div>{}</div><div>{}</div>"
    long = "A long tale of the sea and of those who went down to it in ships, told to the end."
    rows = [(i, f"http://a.example/p?v={i}", page.format("One and the same", "text of some length")) for i in range(4)]
    rows += [(4, "http://a.example/q", page.format("Something else", "and its own text")), (5, "http://b.example/x", page.format("Mirror", "me"))]
    rows += [(6, "http://b.example/y", page.format("Mirror", "me")), (7, "http://c.example/1", page.format(long, "Read 1")), (8, "http://c.example/2", page.format(long, "Read 2"))]
    out = {r.page_id: r.text for r in html_diff.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    want = dict.fromkeys(range(4), "One and the same\n\ntext of some length") | {4: "Something else\n\nand its own text"}
    want |= dict.fromkeys((5, 6), "Shop of things\n\nMirror\n\nme") | {6 + i: f"Shop of things\n\n{long}\n\nRead {i}" for i in (1, 2)}
    assert out == want


def test_empty(spark):
    assert html_diff.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_query(spark, sf):
    """The pages of the tables have one article; a plain reading of that element gives the same text."""
    import html

    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.op3_html(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.sub(r"<[^>]*$", "", re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1])
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x).replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        want = "\n\n".join(x for x in blocks if x)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))
