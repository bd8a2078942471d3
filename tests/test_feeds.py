"""Payloads of every source, read into typed rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tessera.sources import feeds, landed


def payload(spark, body, **more):
    return spark.createDataFrame([(body if isinstance(body, str) else json.dumps(body),)], "payload string")


def rows(df):
    return [r.asDict() for r in df.orderBy("ord").collect()]


def test_generic_jobs(spark):
    items = [
        {"company_name": " Acme ", "title": "Backend Engineer", "url": "https://a/1", "created_at": 1786708800, "remote": True, "location": "Berlin", "description": "<p>Nice  <b>job</b></p>"},
        {"company": "B", "position": "Clerk", "link": "https://a/2", "date": "2026-08-15T14:00:00Z", "remote": "no"},
        {"company_title": "C", "role": "QA", "job_url": "https://a/3", "published_at": "bad", "location": "Remote - US"},
        {"company_name": "", "title": "none", "url": "https://a/4"}, {"company_name": "D", "title": "t", "url": "ftp://x"}, "text", None,
    ]
    got = rows(feeds.jobs_generic(payload(spark, {"data": items})))
    assert [(r["company"], r["title"], r["is_remote"], r["role_family"]) for r in got] == [("Acme", "Backend Engineer", True, "Engineering"), ("B", "Clerk", False, None), ("C", "QA", True, "Quality Assurance")]
    assert got[0]["description"] == "Nice job" and got[2]["date"] is None and got[2]["date_raw"] == "bad"


@pytest.mark.parametrize("body", ["", "not json", "{}", '{"data": 3}', "[]", None])
def test_unreadable_json(spark, body):
    df = spark.createDataFrame([(body,)], "payload string")
    for parser in (feeds.jobs_generic, feeds.jobs_remoteok, feeds.jobs_jobicy, feeds.jobs_himalayas, feeds.news_hackernews, feeds.news_devto, feeds.startups, feeds.products):
        assert parser(df).collect() == []


@pytest.mark.parametrize("body", ["", "<rss><channel>", "<x/>", None])
def test_unreadable_xml(spark, body):
    df = spark.createDataFrame([(body,)], "payload string")
    for parser in (feeds.jobs_wwr, feeds.news_rss, feeds.news_atom, feeds.news_arxiv, feeds.papers):
        assert parser(df).collect() == []


def test_boards(spark):
    got = rows(feeds.jobs_remoteok(payload(spark, [{"legal": "x"}, {"id": "1", "position": "Dev", "url": "https://r/1", "date": "2026-08-15T10:00:00+00:00"}, {"position": "Ops", "company": "C", "url": "https://r/2"}])))
    assert [(r["company"], r["title"], r["is_remote"]) for r in got] == [("Unknown Company", "Dev", True), ("C", "Ops", True)]
    got = rows(feeds.jobs_jobicy(payload(spark, {"jobs": [{"companyName": "J", "jobTitle": "T", "url": "https://j/1", "pubDate": "2026-08-16 10:00:00", "jobDescription": "d"}]})))
    assert got[0]["date"] == dt.datetime(2026, 8, 16, 10) and got[0]["company"] == "J"
    got = rows(feeds.jobs_himalayas(payload(spark, {"jobs": [{"title": "T", "companyName": "H", "pubDate": 1786708800, "slug": "s", "excerpt": "e"}, {"title": "U", "companyName": "H", "applicationLink": "x"}]})))
    assert [(r["url"], r["description"]) for r in got] == [("https://himalayas.app/jobs/s", "e"), ("x", "U")]
    rss = "<rss><channel><item><title>Acme: Dev: Lead</title><link>https://w/1</link><pubDate>Wed, 15 Aug 2026 12:00:00 +0000</pubDate></item><item><title>No colon</title><link>https://w/2</link></item><item><title>x</title></item></channel></rss>"
    got = rows(feeds.jobs_wwr(payload(spark, rss)))
    assert [(r["company"], r["title"]) for r in got] == [("Acme", "Dev: Lead"), ("We Work Remotely Company", "No colon")]


def test_news(spark):
    rss = """<rss xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>Feed</title><link>https://f</link>
      <item><title>A</title><link>https://n/1</link><pubDate>Wed, 15 Aug 2026 12:00:00 +0000</pubDate><description>&lt;p&gt;A description that is long enough to keep.&lt;/p&gt;</description></item>
      <item><title>B</title><link>https://n/2</link><description>no</description><content:encoded><![CDATA[<p>The encoded content is preferred, when there is some.</p>]]></content:encoded></item>
      <item><title>C</title></item></channel></rss>"""
    got = rows(feeds.news_rss(payload(spark, rss)))
    assert [(r["title"], r["full_text"], r["source_name"], r["source_url"]) for r in got] == [("A", "A description that is long enough to keep.", "Feed", "https://f"), ("B", "The encoded content is preferred, when there is some.", "Feed", "https://f")]
    assert got[0]["published_date"] == dt.datetime(2026, 8, 15, 12)
    assert rows(feeds.news_rss(payload(spark, rss), "N", "https://h"))[0]["source_name"] == "N"
    atom = """<feed xmlns="http://www.w3.org/2005/Atom"><title>At</title><entry><title>E</title><link rel="self" href="https://s"/><link href="https://alt"/><updated>2026-08-15T00:00:00Z</updated>
      <summary>A summary of the entry that is long enough to keep.</summary></entry><entry><title>F</title><link rel="self" href="https://only"/><published>2026-08-14T00:00:00Z</published></entry></feed>"""
    got = rows(feeds.news_atom(payload(spark, atom)))
    assert [(r["title"], r["url"], r["published_date"].day) for r in got] == [("E", "https://alt", 15), ("F", "https://only", 14)]
    got = rows(feeds.news_hackernews(payload(spark, {"hits": [{"objectID": "7", "title": "T", "created_at": "2026-08-15T00:00:00Z"}, {"title": "", "url": "x"}]})))
    assert [(r["url"], r["full_text"]) for r in got] == [("https://news.ycombinator.com/item?id=7", "T")]
    got = rows(feeds.news_devto(payload(spark, [{"id": 1, "title": "T", "canonical_url": "https://d", "created_at": "2026-08-15T00:00:00Z", "description": "words " * 9}])))
    assert got[0]["url"] == "https://d" and got[0]["full_text"].startswith("words words")


def test_feeds_of_any_namespace(spark):
    atom = """<atom:feed xmlns:atom="http://www.w3.org/2005/Atom"><atom:title>At</atom:title><atom:entry><atom:id>http://arxiv.org/abs/1.2v3</atom:id><atom:title>E</atom:title>
      <atom:link href="https://alt"/><atom:published>2026-08-15T00:00:00Z</atom:published><atom:summary>A summary of the entry that is long enough to keep.</atom:summary></atom:entry></atom:feed>"""
    got = rows(feeds.news_atom(payload(spark, atom)))
    assert [(r["title"], r["url"], r["full_text"]) for r in got] == [("E", "https://alt", "A summary of the entry that is long enough to keep.")]
    assert rows(feeds.papers(payload(spark, atom)))[0]["paper_url"] == "https://arxiv.org/abs/1.2"
    rss = """<rss xmlns:a="http://www.w3.org/2005/Atom" xmlns:m="x"><channel><title>Feed</title><a:link href="https://self" rel="self"/><link>https://f</link>
      <item><title>A</title><m:title>not this</m:title><a:link href="https://no"/><link>https://n/1</link><e:encoded xmlns:e="y"><![CDATA[<p>Any child whose name ends so is the text of it.</p>]]></e:encoded></item></channel></rss>"""
    got = rows(feeds.news_rss(payload(spark, rss)))
    assert [(r["title"], r["url"], r["full_text"], r["source_url"]) for r in got] == [("A", "https://n/1", "Any child whose name ends so is the text of it.", "https://f")]


def test_unreadable(spark):
    bodies = ["{}", "[1]", "<rss><channel></channel></rss>", "<rss><channel>", "not json", "", None, '{"a"']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, payload string")
    assert [r.u for r in df.select("i", feeds.unreadable(F.col("payload")).alias("u")).orderBy("i").collect()] == [False, False, False, True, True, True, True, True]


PAPERS = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/2103.14030v1</id><published>2021-03-25T17:59:31Z</published><title>Swin
  Transformer</title><summary>Code at https://github.com/microsoft/Swin-Transformer.git.</summary><author><name>Ze Liu</name></author><author><name>Yutong Lin</name></author></entry>
  <entry><id></id><title>no id</title></entry></feed>"""


def test_papers(spark):
    got = rows(feeds.papers(payload(spark, PAPERS)))
    assert len(got) == 1
    assert (got[0]["title"], got[0]["authors"], got[0]["paper_url"], got[0]["github_url"]) == ("Swin Transformer", ["Ze Liu", "Yutong Lin"], "https://arxiv.org/abs/2103.14030", "https://github.com/microsoft/Swin-Transformer")
    assert rows(feeds.news_arxiv(payload(spark, PAPERS)))[0]["title"] == "Swin   Transformer"
    stats = spark.createDataFrame([("https://github.com/microsoft/Swin-Transformer", 200, 12)], "url string, status int, stars int")
    assert feeds.with_stars(feeds.papers(payload(spark, PAPERS)), stats).first().github_stars == 12


def test_repositories(spark):
    orgs = {"items": [{"login": "acme", "name": "Acme Inc", "html_url": "https://github.com/acme", "description": "AI company, 50 employees"}, {"login": "x"}, {"name": None}, {"login": "y", "html_url": "bad"}]}
    got = rows(feeds.startups(payload(spark, orgs)))
    assert [(r["entity_name"], r["source_url"], r["employee_count"], r["is_qualified"]) for r in got] == [("Acme Inc", "https://github.com/acme", 50, True), ("x", "https://github.com/x", None, False)]
    repos = {"items": [{"name": "p", "owner": {"login": "o"}, "html_url": "https://github.com/o/p", "description": "free tier cli", "topics": ["Engine"], "license": {"key": "mit", "name": "MIT License"}}, {"name": "q", "html_url": "https://x"}]}
    got = rows(feeds.products(payload(spark, repos)))
    assert [(r["product_name"], r["startup_name"], r["pricing_model"], r["license"], r["qualification_category"]) for r in got] == [("p", "o", "FREEMIUM", "MIT License", "APPLICATION_TOOL")]


def test_registry_and_positions():
    assert list(feeds.enabled("jobs", "Jobicy, nope,remoteok")) == ["jobicy", "remoteok"]
    assert list(feeds.enabled("news", "nope")) == list(feeds.PARSERS["news"])
    assert landed.organisation_segment(0) == (0, 1, 0) and landed.organisation_segment(560) == (1, 2, 10)
    assert landed.repository_segment(3, 2, 50) == (3, 3, False) and landed.repository_segment(3, 2, 7) == (4, 1, False)
    assert landed.repository_segment(19, 10, 50) == (0, 1, True)
    assert "sortBy=submittedDate" in landed.paper_query(start=50)


def test_full_text(spark):
    pages = spark.createDataFrame([("u1", "<p>" + "long text of a page " * 4 + "</p>"), ("u2", "")], "url string, html string")
    arts = spark.createDataFrame([("u1", None), ("u1", "x" * 60), ("u2", "short"), ("u3", None)], "url string, full_text string")
    got = sorted((r.url, (r.full_text or "")[:9]) for r in feeds.full_text(arts, pages).collect())
    assert got == [("u1", "long text"), ("u1", "xxxxxxxxx"), ("u2", "short"), ("u3", "")]
