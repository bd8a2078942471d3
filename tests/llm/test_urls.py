import random
from urllib.parse import urljoin

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import queries, url_alias

PAGES = [
    (1, "https://Example.ORG/es/1?q#f", "", "allow"), (2, "http://x.example.org/en/12", None, "x"), (3, "http://example.org/en/2", "", "x"), (4, "http://a.com/fr/x", "", "x"),
    (5, "http://a.com/de/x", "", "x"), (6, "http://other.net/a", '<link rel="canonical" href="http://a.com/de/x">', "x"),
    (7, "http://third.net/b?x=1", '<LINK href="//other.net/a" rel=canonical>', "x"), (8, "http://a.com/fr/y", "<link rel='canonical' href='/de/x'>", "x"),
    (9, "http://free.net/", '<meta http-equiv="refresh" content="0; url=http://gone.com/de/">', "x"), (10, None, '<link rel="canonical" href="http://a.com/de/x">', "x"),
    (11, "no scheme", None, "x"), (12, "http://", "", "x"), (13, "http://notorg/", "", "x"), (14, "http://org", "", "x"), (15, "http://org?x", "", "x"),
    (16, "ftp://b.com/x/y.html", '<link rel="canonical" href="z.html">', "x"), (17, "http://b.com/x/z.html", '<meta http-equiv=refresh content="5;URL=http://b.com/de/">', "x"),
    (7, "http://third.net/b?x=1", None, "x"), (None, "http://other.net/a#frag", None, "x"), (18, "http://evil/://org/es", None, "x"), (19, "http://b.com", '<link rel="canonical" href="q">', "x"),
    (20, "http://r.net/a/b/c?id=1", "<link title='a>b' rel='nofollow canonical' href='../../de/x?k=a b'>", "x"), (21, "http://s.net/?id=1", '<!-- <link rel=canonical href="http://a.com/de/x"> -->', "x"),
    (22, "http://t.net/x?id=1", '<link rel="canonical" href="?id=2">', "x"), (23, "http://t.net/x?id=2", "<meta content='0;url=http://a.com/de/' http-equiv=refresh>", "x"),
    (24, "http://u.net/1", '<script>"<link rel=canonical href=http://a.com/de/x>"</script><link rel=canonical href="mailto:x">', "x"),
    (25, "http://a.com/x/../de/y", None, "x"), (26, "http://r.net/de/x?k=a b", "<link rel=canonical href='http://a.com/./de/x'>", "x"),
]


def run(spark):
    df = spark.createDataFrame([(*p, True) for p in PAGES], "page_id long, url string, html string, verdict string, passed_on boolean").repartition(3)
    return [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_alias.judge(df, queries.RULES).collect()]


def test_cases(spark):
    got = {r[0]: r[1:] for r in run(spark)}
    assert len(run(spark)) == len(PAGES)
    assert got[1] == ("example.org", "/es/1", "example.org/es/", "block")
    assert got[2][2:] == ("example.org/en/1", "block") and got[3][2:] == ("org/", "allow")
    assert got[4][2:] == ("com/fr/", "allow") and got[5][2:] == ("com/de/", "block")
    assert got[6][2:] == (None, "block") and got[7][2:] == (None, "block") and got[None][2:] == (None, "block")
    assert got[8][2:] == ("com/fr/", "allow"), "an explicit allow stands against its aliases"
    assert got[9][2:] == (None, "block")
    assert got[10] == got[11] == ("", "", None, "allow") == got[12]
    assert got[13][2:] == got[14][2:] == got[15][2:] == (None, "allow")
    assert got[16][3] == got[17][3] == "block"
    assert got[18] == ("evil", "/://org/es", None, "allow")
    assert got[20][3] == got[26][3] == got[22][3] == got[23][3] == "block"
    assert got[21][3] == got[24][3] == "allow"
    assert got[25] == ("a.com", "/x/../de/y", None, "allow"), "rules read the path as it stands"


def test_targets_resolve_as_in_the_library(spark):
    rng = random.Random(1)
    bases = ["", "/", "/a", "/a/b/c", "/a/b/", "/a/../b", "?q", "/x?y=1#z"]
    asked = ["", "/", "//o.net", "//o.net/a/b", "https://p.org/x/", "?id=2", "#f", "../", "..", "../../../g", "./g", "g/.", "g/..", "g;x=1/../y", "/./g", "/../g", "g.", ".g", "g..", "..g", "mailto:x@y", "a/b?c/../d", "/a//b/../c", "g#s/../x"]
    rows = [(i, f"http://h.example{rng.choice(bases)}", rng.choice(asked)) for i in range(600)]
    got = spark.createDataFrame(rows, "i int, b string, t string").select("b", "t", url_alias.absolute(F.col("t"), F.col("b")).alias("u")).collect()
    for r in got:
        assert r.u == (None if r.t in ("", "mailto:x@y") else urljoin(r.b, r.t)), r


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<link rel="nofollow canonical" href="/a b.html">', ["/a b.html", ""]), ("<LINK HREF='x?a=1&amp;b=2' REL=Canonical>", ["x?a=1&b=2", ""]),
        ("<!-- <link rel=canonical href=/no> --><link rel=canonical href=/yes>", ["/yes", ""]), ('<script>var x="<link rel=canonical href=/no>"</script>', ["", ""]),
        ('<link rel="canonical-x" href="/no">', ["", ""]), ('<link data-rel="canonical" href="/no">', ["", ""]), ('<link title="a>b" rel=canonical href=" /y ">', ["/y", ""]),
        ("<meta http-equiv=refresh content=\"5;URL='http://b.com/de/'\">", ["", "http://b.com/de/"]), ("<meta content=3 http-equiv=refresh>", ["", ""]), (None, ["", ""]), ("", ["", ""]),
        ('<link rel="canonical" data-href="/no" href="/yes">', ["/yes", ""]), ('<meta name=refresh content="0;url=/no">', ["", ""]), ("x" * 2_000_000 + "<link rel=canonical href=/far>", ["/far", ""]),
    ],
)
def test_link_targets(spark, html, want):
    assert spark.createDataFrame([(html,)], "h string").select(url_alias.targets(F.col("h")).alias("t")).first().t == want


def test_sql_says_the_same(spark):
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar, html varchar, verdict varchar)")
    con.executemany("insert into pages values (?, ?, ?, ?)", PAGES)
    want = con.execute(queries.OP7_SQL).fetchall()
    assert sorted(run(spark), key=repr) == sorted(want, key=repr)


def test_no_rules_and_empty(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string, verdict string")
    assert {r.verdict for r in url_alias.judge(df, []).collect()} == {"allow"}
    assert url_alias.judge(df.limit(0), queries.RULES).collect() == []
