"""Fetching the pages of every source on executors and landing their payloads, page by page, with a position to go on from.

A source is a list of segments (queries), each of numbered pages. Pages are fetched in waves, side by side, by crawl.fetch;
what a wave brings is taken in order, up to the first page that fails or has no rows: that ends a segment, and the source if
it has no other. Payloads land as a file each below <landed>/<vertical>/<source>/<run>/<segment-page>, so paths sort in the
order in which pages were asked for, which is the order of rows that ingest goes by.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.state import Checkpoints, scoped, staged
from tessera.sources.crawl import CrawlPolicy, fetch
from tessera.sources.feeds import PARSERS, enabled
from tessera.sources.landed import organisation_segment, paper_query

# The queries of the segmented searches, in the order in which they are gone through.
ORGANISATIONS = [
    "type:org created:>2024-01-01", "type:org created:2023-01-01..2023-12-31", "type:org created:2022-01-01..2022-12-31", "type:org created:2020-01-01..2021-12-31",
    "type:org created:2018-01-01..2019-12-31", "type:org created:2015-01-01..2017-12-31", "type:org location:california", "type:org location:london", "type:org location:berlin",
    "type:org location:sanfrancisco",
]
TOPICS = [
    "topic:ai-tool sort:stars", "topic:ai sort:stars", "topic:llm sort:stars", "topic:machine-learning sort:stars", "topic:agents sort:stars", "topic:rag sort:stars",
    "topic:developer-tools sort:stars", "topic:cli-tool sort:stars", "topic:saas sort:stars", "topic:deep-learning sort:stars", "topic:workflow-automation sort:stars",
    "topic:analytics sort:stars", "topic:generative-ai sort:stars", "topic:gpt sort:stars", "topic:copilot sort:stars", "topic:artificial-intelligence sort:stars", "topic:nlp sort:stars",
    "topic:computer-vision sort:stars", "topic:database sort:stars", "topic:web-framework sort:stars",
]


@dataclass(frozen=True)
class Paged:
    """How a source is asked: the URL of a page (counted from 1) of a query, rows a page, pages a query, queries."""

    url: Callable[[str, int], str]
    size: int = 50
    pages: int | None = 1  # None: as many as there are
    queries: list[str] = field(default_factory=lambda: [""])


def _search(kind: str) -> Callable[[str, int], str]:
    return lambda q, page: f"https://api.github.com/search/{kind}?q={quote(q, safe=':.')}&per_page=50&page={page}"


def _feed(url: str) -> Paged:
    return Paged(lambda q, page: url)


SOURCES: dict[str, dict[str, Paged]] = {
    "jobs": {
        "arbeitnow": Paged(lambda q, page: f"https://www.arbeitnow.com/api/job-board-api?page={page}", 15, None),
        "remoteok": _feed("https://remoteok.com/api"),
        "jobicy": _feed("https://jobicy.com/api/v2/remote-jobs?count=50"),
        "weworkremotely": _feed("https://weworkremotely.com/categories/remote-programming-jobs.rss"),
        "himalayas": Paged(lambda q, page: f"https://himalayas.app/jobs/api?limit=50&offset={50 * (page - 1)}", 50, None),
    },
    "news": {
        "techcrunch": _feed("https://techcrunch.com/category/artificial-intelligence/feed/"),
        "venturebeat": _feed("https://venturebeat.com/category/ai/feed/"),
        "mit_tech_review": _feed("https://www.technologyreview.com/topic/artificial-intelligence/feed/"),
        "kdnuggets": _feed("https://www.kdnuggets.com/feed"),
        "huggingface": _feed("https://huggingface.co/blog/feed.xml"),
        "hackernews": Paged(lambda q, page: f"https://hn.algolia.com/api/v1/search?query=AI&tags=story&page={page - 1}&hitsPerPage=50", 50, None),
        "devto": Paged(lambda q, page: f"https://dev.to/api/articles?tag=ai&per_page=50&page={page}", 50, None),
        "arxiv": Paged(lambda q, page: paper_query("cat:cs.AI OR cat:cs.CL OR cat:cs.CV", 50 * (page - 1)), 50, None),
    },
    "research": {"arxiv": Paged(lambda q, page: paper_query("cat:cs.AI OR cat:cs.CL OR cat:cs.CV OR cat:cs.LG", 50 * (page - 1)), 50, None)},
    "startups": {"github": Paged(_search("users"), 50, 10, ORGANISATIONS)},
    "products": {"github": Paged(_search("repositories"), 50, 10, TOPICS)},
}


@dataclass
class Landed:
    """What a run of one source did, and where the next one goes on: segment (from 0) and page (from 1)."""

    source: str
    segment: int = 0
    page: int = 1
    pages: int = 0
    rows: int = 0
    failed: int = 0
    status: str = "running"  # completed: the limit is reached; exhausted: no segment is left; failed: see error
    error: str = ""


def _wave(spark: SparkSession, source: Paged, segment: int, page: int, size: int, policy: CrawlPolicy, transport: Callable | None) -> DataFrame:
    """The answers of some pages from one on: ord, payload, success."""
    last = page + size - 1 if source.pages is None else min(page + size - 1, source.pages)
    asked = [(p, source.url(source.queries[segment], p)) for p in range(page, last + 1)]
    got = fetch(spark.createDataFrame(asked, "ord long, url string"), policy, transport)
    return staged(got.select("ord", F.col("content").alias("payload"), "success"))


def land_source(spark: SparkSession, vertical: str, name: str, folder: str, limit: int, policy: CrawlPolicy | None = None, transport: Callable | None = None, start: Landed | None = None, wave: int = 4) -> Landed:
    """Fetches and lands pages of one source from a position on, until `limit` rows have landed or nothing is left."""
    source, parser, policy = SOURCES[vertical][name], PARSERS[vertical][name], policy or CrawlPolicy()
    at, run = start or Landed(name), f"run={time.time_ns()}"
    while at.rows < limit and at.segment < len(source.queries):
        with scoped(spark):
            size = min(wave, -(-(limit - at.rows) // source.size))
            answers = _wave(spark, source, at.segment, at.page, max(1, size), policy, transport)
            good = answers.filter("success and payload is not null")
            counted = parser(good.select(F.col("ord").cast("string").alias("path"), "payload")).groupBy(F.col("ord.path").cast("long").alias("page")).agg(F.count("*").alias("n"))
            rows = {r["page"]: r["n"] for r in counted.collect()}  # a few pages
            fetched = {r["ord"]: r["success"] for r in answers.select("ord", "success").collect()}
            kept, ended = [], False
            for page in sorted(fetched):
                if not rows.get(page):
                    at.failed += not fetched[page]
                    ended = True
                    break
                kept.append(page)
                at.rows += rows[page]
                at.pages += 1
                at.page = page + 1
                if at.rows >= limit:
                    break
            if kept:
                place = F.concat(F.lpad(F.lit(at.segment).cast("string"), 4, "0"), F.lit("-"), F.lpad(F.col("ord").cast("string"), 6, "0"))
                files = answers.filter(F.col("ord").isin(kept)).select(F.col("payload").alias("value"), place.alias("page"))
                files.repartition(len(kept), "page").write.mode("append").partitionBy("page").option("maxRecordsPerFile", 1).text(f"{folder}/{vertical}/{name}/{run}")
        if ended or (source.pages is not None and at.page > source.pages):
            at.segment, at.page = at.segment + 1, 1
    at.status = "exhausted" if at.segment >= len(source.queries) else "completed"
    return at


def land(spark: SparkSession, vertical: str, folder: str, limit: int = 50, sources: str | None = None, marks: Checkpoints | None = None, policy: CrawlPolicy | None = None, transport: Callable | None = None, resume: bool = True, offset: int = 0, wave: int = 4) -> list[Landed]:
    """`land_source` for every enabled source of a vertical, each with its share of the limit; a source that fails does not
    stop the others. With checkpoints, a source goes on at the segment and page where its last run stopped, after the last
    segment at the first one again. offset: rows of a segmented search to pass over where nothing is resumed."""
    names = list(enabled(vertical, sources))
    each, out = max(1, -(-limit // len(names))), []
    for name in names:
        held = marks.get(vertical, f"fetch:{name}") if marks is not None and resume else None
        segment, page = (held["segment"], held["page"]) if held is not None else organisation_segment(offset, len(SOURCES[vertical][name].queries))[:2] if offset else (0, 1)
        start = Landed(name, segment if segment < len(SOURCES[vertical][name].queries) else 0, page)
        try:
            done = land_source(spark, vertical, name, folder, each, policy, transport, start, wave)
        except Exception as e:  # noqa: BLE001 - each source stands alone
            done = start
            done.status, done.error = "failed", str(e)[:200]
        if marks is not None:
            marks.save(vertical, f"fetch:{name}", segment=done.segment, page=done.page, cursor=str(done.pages), processed=done.rows, failed=done.failed, status="running" if done.status == "completed" else done.status)
        out.append(done)
    return out
