"""Queries that run whole operations (ingest, fetching, streams, resolution, export) over the driver's tables and return what
they left, with their SQL. What they land or store is in the shared folder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera import config
from tessera.functions import classify, dates, text
from tessera.operators import export, fanin, resolve, state
from tessera.plans import services
from tessera.plans.catalog import _ITEMS, _NORM_URL, _TITLE, _any_sql, _canned, query
from tessera.providers import chain, http, models
from tessera.sources import crawl, feeds, fetching, landed, pages
from tessera.streaming import ingest as streaming

_NOW = "2024-01-31 00:00:00"


def _landed(payloads: DataFrame, folder: str, vertical: str, source: str) -> None:
    """Writes payloads (page, payload) as a file each where ingest looks for them."""
    rows = payloads.select(F.col("payload").alias("value"), F.lpad(F.col("page").cast("string"), 9, "0").alias("page"))
    # A number, as Spark joins partitions of few bytes else, and one task writes all the files.
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "page")
    rows.write.mode("append").partitionBy("page").option("maxRecordsPerFile", 1).text(f"{folder}/{vertical}/{source}")


def _paged(rows: DataFrame, key: str, item, place=None) -> DataFrame:
    """page, items: up to _ITEMS keys of a table as an array in order of key and place."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), (place if place is not None else F.lit(0)).alias("at"), item.alias("item"))))
    return rows.groupBy(F.floor(F.col(key) / _ITEMS).alias("page")).agg(F.transform(ordered, lambda x: x["item"]).alias("items"))


def _organisations(read) -> DataFrame:
    """Suppliers as organisations; every third comes twice, under another URL."""
    rows = read("supplier").withColumn("again", F.explode(F.when(F.col("s_suppkey") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    url = F.concat(F.lit("https://github.com/org"), "s_suppkey", F.when(F.col("again") == 1, "-again").otherwise(""))
    item = F.struct(F.col("s_name").alias("name"), F.concat(F.lit("org"), "s_suppkey").alias("login"), url.alias("html_url"))
    return _paged(rows, "s_suppkey", item, F.col("again")).select("page", F.to_json(F.struct("items")).alias("payload"))


# ---- ingest -----------------------------------------------------------------------------------------------------------


@query("select s_name as entity_name, 'https://github.com/org' || s_suppkey as source_url, false as is_qualified from supplier")
def ingest_startups(read, spark):
    """Suppliers land as organisations, every third twice, and are ingested as a stream; a second run adds nothing."""
    folder = state.scratch(spark)
    _landed(_organisations(read), f"{folder}/landed", "startups", "github")
    for _ in range(2):
        streaming.ingest(spark, f"{folder}/landed", "startups", f"{folder}/out", now=_NOW)
    return spark.read.parquet(f"{folder}/out/startups").select("entity_name", "source_url", "is_qualified")


@query("select count(*) + count(*) filter (s_suppkey % 3 = 0) as processed, count(*) + count(*) filter (s_suppkey % 3 = 0) as valid, count(*) as inserted, count(*) filter (s_suppkey % 3 = 0) as duplicates, 0::bigint as invalid, 2::bigint as failed, 0::bigint as dry_rows from supplier")
def ingest_counts(read, spark):
    """The counters of that run, with two payloads that can't be read; a dry run before it writes nothing."""
    folder = state.scratch(spark)
    _landed(_organisations(read).unionByName(spark.createDataFrame([(10**8, "{broken"), (10**8 + 1, "<x><y>")], "page long, payload string")), f"{folder}/landed", "startups", "github")
    streaming.ingest(spark, f"{folder}/landed", "startups", f"{folder}/out", now=_NOW, dry_run=True)
    left = state.read_or_none(spark, f"{folder}/out/startups")
    c = streaming.ingest(spark, f"{folder}/landed", "startups", f"{folder}/out", now=_NOW)
    return spark.createDataFrame([(c.processed, c.valid, c.inserted, c.duplicates, c.invalid, c.failed, 0 if left is None else left.count())], "processed long, valid long, inserted long, duplicates long, invalid long, failed long, dry_rows long")


def _two_boards(read, spark) -> str:
    """Suppliers as postings of two boards, even and odd, taken four rows at a time: twice, the second time from row 2 on."""
    folder = state.scratch(spark)
    one = F.struct(F.col("s_name").alias("company_name"), F.lit("Clerk").alias("title"), F.concat(F.lit("https://a/"), "s_suppkey").alias("url"), F.lit("2024-01-30").alias("created_at"))
    two = F.struct(F.col("s_name").alias("companyName"), F.lit("Clerk").alias("jobTitle"), F.concat(F.lit("https://b/"), "s_suppkey").alias("url"), F.lit("2024-01-30").alias("pubDate"))
    _landed(_paged(read("supplier").filter("s_suppkey % 2 = 0"), "s_suppkey", one).select("page", F.to_json(F.struct(F.col("items").alias("data"))).alias("payload")), f"{folder}/landed", "jobs", "arbeitnow")
    _landed(_paged(read("supplier").filter("s_suppkey % 2 = 1"), "s_suppkey", two).select("page", F.to_json(F.struct(F.col("items").alias("jobs"))).alias("payload")), f"{folder}/landed", "jobs", "jobicy")
    for more in ({}, {"offset": 2, "resume": False}):
        streaming.ingest(spark, f"{folder}/landed", "jobs", f"{folder}/out", sources="arbeitnow,jobicy", now=_NOW, limit=4, batch_rows=3, **more)
    return f"{folder}/out"


@query("select company, url, source_key from (select s_name as company, case when s_suppkey % 2 = 0 then 'https://a/' else 'https://b/' end || s_suppkey as url, case when s_suppkey % 2 = 0 then 'arbeitnow' else 'jobicy' end as source_key, row_number() over (partition by s_suppkey % 2 order by s_suppkey) as k from supplier) where k <= 4")
def ingest_limited(read, spark):
    """Limited runs take an equal share of each source, each from its own place."""
    return spark.read.parquet(f"{_two_boards(read, spark)}/jobs").select("company", "url", "source_key")


@query("select * from (values ('jobs', 'arbeitnow', '4', 0, 0, 'completed'), ('jobs', 'jobicy', '4', 0, 0, 'completed'), ('jobs', 'arbeitnow,jobicy', '4', 4, 4, 'completed')) t(vertical, source, cursor, processed, inserted, status)")
def ingest_checkpoints(read, spark):
    """What those runs keep: how far each source is read, and the counters of the last run."""
    held = state.Checkpoints(spark, f"{_two_boards(read, spark)}/checkpoints").all()
    return held.select("vertical", "source", "cursor", F.col("processed").cast("int").alias("processed"), F.col("inserted").cast("int").alias("inserted"), "status")


@query("select 'startups' as vertical, 'success' as status, count(*) as inserted, 0::bigint as quarantined, 'PASS' as verdict, (select count(*) from supplier) as unresolved from supplier")
def pipeline_run(read, spark):
    """All verticals but one skipped: ingest, resolution and validation in one go."""
    folder = state.scratch(spark)
    _landed(_organisations(read), f"{folder}/landed", "startups", "github")
    got = services.pipeline(spark, config.Settings(data_folder=f"{folder}/out", landed_folder=f"{folder}/landed"), {"research", "products", "news", "jobs"})
    one, check = got["startups"], got["validate"]
    return spark.createDataFrame([("startups", one["status"], one["inserted"], check["quarantined"], check["status"], got["resolve"].get("unresolved", 0))], "vertical string, status string, inserted long, quarantined long, verdict string, unresolved long")


# ---- fetching ---------------------------------------------------------------------------------------------------------


def _from_folder(base: str, queries: list[str]):
    """A transport by which searches are answered from landed pages: a folder for each search and page; no folder, not found."""

    def answer(address: str, headers: dict, wait: float) -> tuple:
        from urllib.parse import parse_qs, urlsplit

        asked = parse_qs(urlsplit(address).query)
        return pages.folder_transport(f"{base}/segment={queries.index(asked['q'][0])}/page={asked['page'][0]}", headers, wait)

    return answer


_FETCHED, _FIRST_RUN = 50, 60
@query(f"""with c as (select c_custkey, c_custkey % 10 as segment, (row_number() over (partition by c_custkey % 10 order by c_custkey) - 1) // {_FETCHED} + 1 as page from customer),
p as (select segment, page, count(*) as n from c where page <= 10 and not (segment = 2 and page >= 2) group by 1, 2), r as (select segment, page, sum(n) over (order by segment, page) - n as before from p)
select c_custkey, segment::integer as segment, page::integer as page, case when before < {_FIRST_RUN} then 1 else 2 end::integer as run from c join r using (segment, page)""")
def fetch_and_land(read, spark):
    """Customers as organisations that ten searches find, fetched and landed by two runs: the first stops at its limit, the second
    goes on at that segment and page to the end. A search gives ten pages at most; of the third all but the first have got lost."""
    folder, policy = state.scratch(spark), crawl.CrawlPolicy(backoff_base=0.0, jitter=False, retries=1)
    rows = read("customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") % 10).alias("segment"))
    placed = fanin.numbered(rows, ["segment", "k"], "place")
    first = placed.groupBy("segment").agg(F.min("place").alias("first"))
    paged = placed.join(first, "segment").withColumn("page", F.floor((F.col("place") - F.col("first")) / _FETCHED) + 1)
    item = F.struct(F.concat(F.lit("Org "), "k").alias("name"), F.concat(F.lit("https://github.com/org"), "k").alias("html_url"))
    listed = paged.groupBy("segment", "page").agg(F.to_json(F.struct(F.sort_array(F.collect_list(item)).alias("items"))).alias("value"))
    kept = listed.filter("page <= 11 and not (segment = 2 and page >= 2)")
    kept.repartition("segment", "page").write.partitionBy("segment", "page").text(f"{folder}/site")
    base = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    transport, marks = _from_folder(f"{base}/site", fetching.ORGANISATIONS), state.Checkpoints(spark, f"{folder}/checkpoints")
    for limit in (_FIRST_RUN, 10**9):
        fetching.land(spark, "startups", f"{folder}/landed", limit, marks=marks, policy=policy, transport=transport, wave=10)
    files = spark.read.text(f"{folder}/landed/startups/github", wholetext=True).select(F.concat_ws("/", "run", "page").alias("path"), F.col("value").alias("payload"))
    found = feeds.startups(files).select(F.regexp_extract("source_url", r"(\d+)$", 1).cast("long").alias("c_custkey"), F.split("ord.path", "[/-]").alias("at"))
    runs = files.select(F.split("path", "/")[0].alias("ns")).distinct().select("ns", F.dense_rank().over(Window.orderBy(F.col("ns").cast("long"))).alias("run"))  # two rows
    return found.join(F.broadcast(runs), F.col("at")[0] == F.col("ns")).select("c_custkey", F.col("at")[1].cast("int").alias("segment"), F.col("at")[2].cast("int").alias("page"), "run")


_ASKED = f"n as (select page_id, url, {_NORM_URL} as f from pages), o as (select f, arg_min(url, page_id) as asked from n group by 1), x as (select page_id, asked, coalesce(try_cast(right(regexp_replace(split_part(asked, '?', 1), '[^0-9]', '', 'g'), 1) as integer), 0) % 5 as k from n join o using (f))"


@query(f"with {_ASKED} select count(*) as total, count(*) filter (k > 2) as succeeded, count(*) filter (k <= 2) as failed, sum(case when k > 2 then octet_length(encode('body of ' || asked)) end)::bigint as bytes from x")
def crawl_summary(read, spark):
    policy = crawl.CrawlPolicy(backoff_base=0.0, jitter=False)
    return crawl.summary(crawl.fetch(read("pages").select(F.col("page_id").alias("ord"), "url"), policy, _canned))


@query(f"""with n as (select page_id, url, {_NORM_URL} as f from pages), c as (select f, arg_min(url, page_id) as asked from n where page_id % 2 = 0 group by 1),
h as (select f, coalesce(try_cast(right(regexp_replace(split_part(asked, '?', 1), '[^0-9]', '', 'g'), 1) as integer), 0) % 5 > 2 as held from c)
select page_id as ord, coalesce(held, false) as success, case when coalesce(held, false) then 200 else 404 end as status_code from n left join h using (f)""")
def crawl_cached(read, spark):
    """A crawl of all pages over the answers that a crawl of every second page left: only what that lacks is asked for, in vain."""
    policy = crawl.CrawlPolicy(backoff_base=0.0, jitter=False)
    urls = read("pages").select(F.col("page_id").alias("ord"), "url")
    cache = state.staged(crawl.fetch(urls.filter("ord % 2 = 0"), policy, _canned))
    return crawl.fetch(urls, policy, lambda *a: (404, None, None, None), cache).select("ord", "success", "status_code")


@query("select o_orderkey, o_orderkey // 500 % 10 as segment, o_orderkey % 500 // 50 + 1 as page, o_orderkey % 50 as skip from orders")
def organisation_positions(read, spark):
    return read("orders").select("o_orderkey", landed.organisation_position(F.col("o_orderkey")).alias("p")).select("o_orderkey", "p.*")


@query("""with x as (select o_orderkey, o_orderkey % 20 as s, o_custkey % 10 + 1 as p, o_orderkey % 3 * 25 as n from orders)
select o_orderkey, case when n >= 50 and p < 10 then s else (s + 1) % 20 end as segment, case when n >= 50 and p < 10 then p + 1 else 1 end as page, not (n >= 50 and p < 10) and s = 19 as exhausted from x""")
def repository_positions(read, spark):
    k = F.col("o_orderkey")
    return read("orders").select("o_orderkey", landed.repository_position(k % 20, F.col("o_custkey") % 10 + 1, k % 3 * 25).alias("p")).select("o_orderkey", "p.*")


@query("select p_partkey, 'http://export.arxiv.org/api/query?search_query=cat%3Acs.AI&start=' || p_partkey || '&max_results=50&sortBy=submittedDate&sortOrder=descending' as url from part")
def paper_search_urls(read, spark):
    return read("part").select("p_partkey", landed.paper_queries(F.col("p_partkey")).alias("url"))


# ---- feeds ------------------------------------------------------------------------------------------------------------


def _key():
    """The supplier that a URL ends in."""
    return F.regexp_extract("url", r"(\d+)$", 1).cast("long").alias("id")


def _as_json(read, item, path: str | None = None) -> DataFrame:
    rows = _paged(read("supplier"), "s_suppkey", item)
    return rows.select(F.to_json(F.struct(F.col("items").alias(path)) if path else F.col("items")).alias("payload"))


def _as_xml(read, head: str, item, tail: str) -> DataFrame:
    return _paged(read("supplier"), "s_suppkey", item).select(F.concat(F.lit(head), F.array_join("items", ""), F.lit(tail)).alias("payload"))


_JOB = "select s_suppkey as id, {0} as company, {1} as title, timestamp '2024-01-30 10:00:00' as date, true as is_remote, '{2}' as source_name from supplier"


def _jobs(rows: DataFrame) -> DataFrame:
    return rows.select(_key(), "company", "title", F.col("date").cast("timestamp_ntz").alias("date"), "is_remote", "source_name")


@query(_JOB.format("case when s_suppkey % 2 = 0 then s_name else 'Unknown Company' end", "'Dev ' || s_suppkey", "RemoteOK") + " where s_suppkey % 5 <> 0")
def feed_remoteok(read, spark):
    """A fifth have no position and are left out; half name no company."""
    k = F.col("s_suppkey")
    return _jobs(feeds.jobs_remoteok(_as_json(read, F.struct(F.when(k % 2 == 0, F.col("s_name")).alias("company"), F.when(k % 5 != 0, F.concat(F.lit("Dev "), k)).alias("position"), F.concat(F.lit("https://r/"), k).alias("url"), F.lit("2024-01-30T10:00:00Z").alias("date")))))


@query(_JOB.format("s_name", "'Dev ' || s_suppkey", "Jobicy"))
def feed_jobicy(read, spark):
    return _jobs(feeds.jobs_jobicy(_as_json(read, F.struct(F.col("s_name").alias("companyName"), F.concat(F.lit("Dev "), "s_suppkey").alias("jobTitle"), F.concat(F.lit("https://j/"), "s_suppkey").alias("url"), F.lit("2024-01-30 10:00:00").alias("pubDate")), "jobs")))


@query(_JOB.format("s_name", "'Dev ' || s_suppkey", "Himalayas"))
def feed_himalayas(read, spark):
    """Links made of slugs, dates in seconds."""
    return _jobs(feeds.jobs_himalayas(_as_json(read, F.struct(F.col("s_name").alias("companyName"), F.concat(F.lit("Dev "), "s_suppkey").alias("title"), F.concat(F.lit("dev-"), "s_suppkey").alias("slug"), F.lit(1706608800).alias("pubDate"), F.lit("e").alias("excerpt")), "jobs")))


@query(_JOB.format("case when s_suppkey % 2 = 0 then s_name else 'We Work Remotely Company' end", "'Dev ' || s_suppkey", "We Work Remotely"))
def feed_weworkremotely(read, spark):
    k = F.col("s_suppkey")
    item = F.concat(F.lit("<item><title>"), F.when(k % 2 == 0, F.concat("s_name", F.lit(": "))).otherwise(""), F.lit("Dev "), k, F.lit("</title><link>https://w/"), k, F.lit("</link><pubDate>Tue, 30 Jan 2024 12:00:00 +0200</pubDate></item>"))
    return _jobs(feeds.jobs_wwr(_as_xml(read, "<rss><channel>", item, "</channel></rss>")))


_ARTICLE = "select s_suppkey as id, 'On ' || s_name as title, {0} as full_text, timestamp '2024-01-30 10:00:00' as published_date, '{1}' as source_name from supplier"
_LONG = "a text that is long enough to be kept as it is"


def _articles(rows: DataFrame) -> DataFrame:
    return rows.select(_key(), "title", "full_text", F.col("published_date").cast("timestamp_ntz").alias("published_date"), "source_name")


@query(_ARTICLE.format(f"case when s_suppkey % 2 = 0 then '{_LONG}' else 'On ' || s_name end", "Hacker News AI"))
def feed_hackernews(read, spark):
    """Stories without a link are their own page, those without a text have their title."""
    k = F.col("s_suppkey")
    item = F.struct(k.cast("string").alias("objectID"), F.concat(F.lit("On "), "s_name").alias("title"), F.when(k % 3 == 0, F.concat(F.lit("https://n/"), k)).alias("url"), F.when(k % 2 == 0, F.lit(f"<p>{_LONG}</p>")).alias("story_text"), F.lit("2024-01-30T10:00:00Z").alias("created_at"))
    return _articles(feeds.news_hackernews(_as_json(read, item, "hits")))


@query(_ARTICLE.format(f"'{_LONG}'", "DEV.to AI"))
def feed_devto(read, spark):
    item = F.struct(F.concat(F.lit("On "), "s_name").alias("title"), F.concat(F.lit("https://d/"), "s_suppkey").alias("canonical_url"), F.lit(_LONG).alias("description"), F.lit("2024-01-30T10:00:00Z").alias("published_at"))
    return _articles(feeds.news_devto(_as_json(read, item)))


@query(_ARTICLE.format("'short'", "arXiv AI News"))
def feed_arxiv_news(read, spark):
    item = F.concat(F.lit("<entry><id>http://a/"), "s_suppkey", F.lit("</id><title>On\n"), "s_name", F.lit("</title><published>2024-01-30T10:00:00Z</published><summary>short</summary></entry>"))
    return _articles(feeds.news_arxiv(_as_xml(read, '<feed xmlns="http://www.w3.org/2005/Atom">', item, "</feed>")))


@query(_ARTICLE.format(f"'{_LONG}'", "At"))
def feed_atom(read, spark):
    """A feed under a prefix; the alternate link counts, and the date of the last change where there is no other."""
    item = F.concat(F.lit("<a:entry><a:title>On "), "s_name", F.lit('</a:title><a:link rel="self" href="https://no"/><a:link href="https://n/'), "s_suppkey", F.lit(f'"/><a:updated>2024-01-30T10:00:00Z</a:updated><a:summary>&lt;p&gt;{_LONG}&lt;/p&gt;</a:summary></a:entry>'))
    return _articles(feeds.news_atom(_as_xml(read, '<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:title>At</a:title>', item, "</a:feed>")))


# ---- functions --------------------------------------------------------------------------------------------------------


@query("select p_partkey, md5('" + text.extraction_head("product").replace("'", "''") + "' || p_name) as prompt from part")
def prompt_extraction(read, spark):
    return read("part").select("p_partkey", F.md5(text.extraction_prompt("product", F.col("p_name")).cast("binary")).alias("prompt"))


@query(f"select event_id, case when event_id % 3 = 0 then date_trunc('second', ts) else timestamp '{_NOW}' end as date from events")
def date_or_now(read, spark):
    """Dates that can't be read are those of the run."""
    ts = F.col("ts").cast("timestamp")
    raw = F.when(F.col("event_id") % 3 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("event_id") % 3 == 1, "soon")
    return read("events").select("event_id", dates.or_now(dates.job_date(raw), F.lit(_NOW).cast("timestamp")).cast("timestamp_ntz").alias("date"))


@query(f"select o_orderkey, case {' '.join(f'''when {_any_sql(f'lower({_TITLE})', words)} then '{n}' ''' for n, words in classify.ROLE_FAMILIES.items())} when o_custkey % 2 = 0 then 'Security' end as family from orders")
def role_family_or_answer(read, spark):
    """A model's answer counts where no keyword does, if it is a family."""
    answer = F.when(F.col("o_custkey") % 2 == 0, "Security").otherwise("Cooking")
    return read("orders").select("o_orderkey", classify.role_family_or(F.expr(_TITLE), F.lit(""), answer).alias("family"))


# ---- streams and tables -----------------------------------------------------------------------------------------------


@query("select user_id, date_trunc('hour', ts) as window_start, count(*) as n from events group by 1, 2 having count(*) > 1")
def stream_rate(read, spark):
    """Users with more than one event an hour, counted as a stream."""
    folder = state.scratch(spark)
    held = state.staged(read("events").select("user_id", F.col("ts").cast("timestamp").alias("ts")))
    stream = spark.readStream.schema(held.schema).parquet(held._staged_at)
    over = streaming.rate_stream(stream, "user_id", "ts", 1, 3600)
    write = over.writeStream.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{folder}/rows"))
    write.option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/rows").select("user_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


@query("select event_id, event_type in ('view', 'click') as answered from events")
def cached_answers(read, spark):
    requests = read("events").select("event_id", F.sha2("event_type", 256).alias("fingerprint"))
    cache = spark.createDataFrame([("view",), ("click",), ("view",)], "t string").select(F.sha2("t", 256).alias("fingerprint"), F.lit("x").alias("answer"))
    hit, miss = streaming.answer_cache(requests, cache)
    return hit.select("event_id", F.lit(True).alias("answered")).unionByName(miss.select("event_id", F.lit(False).alias("answered")))


@query("select c_custkey, case when c_custkey % 3 = 0 then c_acctbal + 1 else c_acctbal end as balance from customer where c_custkey % 7 <> 0")
def table_versions(read, spark):
    """A keyed table: stored, a third of its rows replaced, a seventh deleted."""
    table = state.VersionedTable(spark, state.scratch(spark))
    rows = read("customer").select("c_custkey", F.col("c_acctbal").alias("balance"))
    table.upsert(rows, "c_custkey")
    table.upsert(rows.filter("c_custkey % 3 = 0").withColumn("balance", F.col("balance") + 1), "c_custkey")
    table.delete("c_custkey % 7 = 0")
    return table.read()


# ---- resolution and providers -----------------------------------------------------------------------------------------


def _makers(read, *kinds: str) -> DataFrame:
    rows = read("supplier").select("s_suppkey", F.explode(F.array(*map(F.lit, kinds))).alias("kind"))
    return rows.select(F.concat(F.lit("ent_"), "s_suppkey", F.lit("_"), "kind").alias("canonical_id"), F.concat(F.lit("Maker "), "s_suppkey", F.lit(" "), "kind").alias("canonical_name"), F.array().cast("array<string>").alias("aliases"))


@query("select 'Maker ' || s_suppkey || ' on' as raw_name, 'ent_' || s_suppkey || '_one' as canonical_id, 'fuzzy' as match_method, round(2.0 * (9 + length(s_suppkey::varchar)) / (19 + 2 * length(s_suppkey::varchar)), 2)::double as confidence from supplier")
def resolve_typos(read, spark):
    """Names that lack their last letter, by similarity among all suppliers: of n letters all but one match. A name of a four-digit
    key is 0.03 nearer to its own supplier than to that with a digit more, which in hundredths, as in the SQL, is enough."""
    names = read("supplier").select(F.concat(F.lit("Maker "), "s_suppkey", F.lit(" on")).alias("raw_name"), F.lit(None).cast("string").alias("source_url"))
    return resolve.resolve(names, _makers(read, "one", "other"), hundredths=True).select("raw_name", "canonical_id", "match_method", "confidence")


def _second(name: str, options: list[dict]) -> tuple[str, float] | None:
    """The option whose name ends in two, for even makers."""
    return next(((o["canonical_id"], 0.7) for o in options if o["canonical_name"].endswith("two")), None) if int(name.split()[1]) % 2 == 0 else None


@query("select 'Maker ' || s_suppkey as raw_name, case when s_suppkey % 2 = 0 then 'ent_' || s_suppkey || '_two' else 'unresolved_maker ' || s_suppkey end as canonical_id, case when s_suppkey % 2 = 0 then 'llm' else 'unresolved' end as match_method, case when s_suppkey % 2 = 0 then 0.7 else 0 end::double as confidence from supplier")
def resolve_chosen(read, spark):
    """Names that stand for two entities go to a chooser; where it has no answer they stay unresolved."""
    names = read("supplier").select(F.concat(F.lit("Maker "), "s_suppkey").alias("raw_name"), F.lit(None).cast("string").alias("source_url"))
    return resolve.resolve(names, _makers(read, "one", "two"), chooser=_second).select("raw_name", "canonical_id", "match_method", "confidence")


@query("select 'Maker ' || s_suppkey || ' one' as raw_name, 'ent_' || s_suppkey || case when s_suppkey % 2 = 0 then '_held' else '_one' end as canonical_id, case when s_suppkey % 2 = 0 then 'alias' else 'exact' end as match_method from supplier")
def resolve_kept(read, spark):
    """Names with a mapping keep it, an unresolved one is sought again."""
    names = read("supplier").select(F.concat(F.lit("Maker "), "s_suppkey", F.lit(" one")).alias("raw_name"), F.lit(None).cast("string").alias("source_url"), "s_suppkey")
    even = F.col("s_suppkey") % 2 == 0
    held = names.select("raw_name", F.lit("n").alias("normalized_name"), F.lit("c").alias("canonical_name"), F.concat(F.lit("ent_"), "s_suppkey", F.lit("_held")).alias("canonical_id"), F.when(even, "alias").otherwise("unresolved").alias("match_method"), F.lit(0.5).alias("confidence"), "source_url")
    return resolve.resolve(names.drop("s_suppkey"), _makers(read, "one"), state.staged(held), refresh_unresolved=True).select("raw_name", "canonical_id", "match_method")


@query("select 'ent_3_one' as canonical_id from supplier where s_suppkey = 3")
def find_by_name(read, spark):
    return resolve.find_by_name(_makers(read, "one"), "MAKER (3) one, Inc.").select("canonical_id")


@query("select s_suppkey, kind, case when s_suppkey % 3 <> 0 then 'ent_' || s_suppkey || '_' || kind end as canonical_id from supplier, (values ('one'), ('two')) t(kind) where s_suppkey % 3 <> 0 union all select s_suppkey, kind, null from supplier, (values ('one'), ('two')) t(kind) where s_suppkey % 3 = 0")
def find_by_names(read, spark):
    """Two names a supplier in another spelling, sought among all entities at once; those of every third are nobody's."""
    name = F.concat(F.when(F.col("s_suppkey") % 3 == 0, "Nobody ").otherwise("MAKER ("), "s_suppkey", F.lit(") "), "kind", F.lit(", Inc."))
    names = read("supplier").select("s_suppkey", F.explode(F.array(F.lit("one"), F.lit("two"))).alias("kind")).withColumn("asked", name)
    return resolve.find_by_names(names, _makers(read, "one", "two"), "asked").select("s_suppkey", "kind", "canonical_id")


@query("select case when s_suppkey % 3 = 0 then 'ent_' || s_suppkey || '_one' else 'unresolved_firm ' || s_suppkey end as canonical_id, array_to_string(case when s_suppkey % 3 = 0 then ['Maker  ' || s_suppkey || ' one'] else [] end, ',') as aliases from supplier where s_suppkey % 3 = 0")
def aliases_of_mappings(read, spark):
    """What is resolved to an entity becomes an alias of it."""
    k = F.col("s_suppkey")
    names = read("supplier").select(F.when(k % 3 == 0, F.concat(F.lit("Maker  "), k, F.lit(" one"))).otherwise(F.concat(F.lit("Firm "), k)).alias("raw_name"), F.lit(None).cast("string").alias("source_url"))
    makers = _makers(read, "one").withColumns({"entity_type": F.lit("STARTUP"), "source_urls": F.array().cast("array<string>")})
    grown = resolve.with_new_aliases(makers, state.staged(resolve.resolve(names, makers)))
    return grown.filter(F.size("aliases") > 0).select("canonical_id", F.array_join("aliases", ",").alias("aliases"))


def _chain() -> chain.Chain:
    """A provider that is out of its quota for every third prompt and answers nonsense to some, and one behind it."""

    def first(prompt: str) -> str:
        k = int("".join(c for c in prompt.split("\n")[0] if c.isdigit()))
        if k % 3 == 0:
            raise models.RateLimited("x")
        return "nonsense" if k % 5 == 4 else f'```json\n{{"n": {k}}}\n```'

    second = lambda prompt: json.dumps([{"n": 1000 + int("".join(c for c in prompt.split("\n")[0] if c.isdigit()))}])
    return chain.Chain([http.HttpProvider("groq", ""), http.StubProvider(first, "a"), http.StubProvider(second, "b")], retries=2, sleep=lambda s: None)


@query("select s_suppkey, case when s_suppkey % 3 = 0 then 1000 + s_suppkey when s_suppkey % 5 <> 4 then s_suppkey end::integer as n, case when s_suppkey % 3 <> 0 and s_suppkey % 5 = 4 then 'structured_output' end as error, case when s_suppkey % 3 = 0 then 3 when s_suppkey % 5 = 4 then 2 else 1 end as attempts from supplier")
def llm_extract(read, spark):
    """Structured answers of a chain over rows: unconfigured providers are passed over, passing errors tried again, then the
    next one asked; an answer that is no JSON is asked for once more."""
    rows = read("supplier").select("s_suppkey", F.concat(F.lit("supplier "), "s_suppkey").alias("prompt"))
    got = chain.extract(rows, "s_suppkey", "prompt", _chain, "n int")
    return got.select("s_suppkey", "answer.n", F.regexp_extract("error", r"^(\w+)", 1).alias("error"), "attempts").withColumn("error", F.nullif("error", F.lit("")))


# ---- export and services ----------------------------------------------------------------------------------------------


@query("select case when s_suppkey % 4 = 0 then '''=' else '' end || s_name as entity_name, s_suppkey::varchar as employee_count from supplier where s_suppkey % 3 <> 0")
def export_files(read, spark):
    """Sheets written as CSV and read back: rows without a name are left out, formulas are quoted."""
    folder, k = state.scratch(spark), F.col("s_suppkey")
    rows = read("supplier").select(F.when(k % 3 != 0, F.concat(F.when(k % 4 == 0, "=").otherwise(""), "s_name")).alias("entityName"), k.alias("employeeCount"))
    export.export({"startups": rows}, folder)
    return spark.read.option("header", True).csv(f"{folder}/startups").select("entity_name", "employee_count")


@query("select 'startups' as sheet, count(*) as queried, count(*) filter (s_suppkey % 3 <> 0) as written, count(*) filter (s_suppkey % 3 = 0) as skipped, 'written' as status from supplier union all select 'startups', count(*), 0, count(*) filter (s_suppkey % 3 = 0), 'dry_run' from supplier union all select 'startups', 0, 0, 0, 'not_configured'")
def export_results(read, spark):
    rows = read("supplier").select(F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name")).alias("entityName"))
    got = [x for folder, dry in ((state.scratch(spark), False), (None, True), (None, False)) for x in export.export({"startup": rows}, folder, dry_run=dry)]
    return spark.createDataFrame([(x.sheet, x.queried, x.written, x.skipped, x.status) for x in got], "sheet string, queried long, written long, skipped long, status string")


@query("select count(*) as records, 0::bigint as failed from supplier")
def benchmark_rows(read, spark):
    """Every supplier is written, read back and held against what was written."""
    got = services.benchmark(spark, state.scratch(spark), rows=read("supplier"))
    return spark.createDataFrame([(got["records"], got["failed"])], "records long, failed long")


@query("""select part, status, null::bigint as rows from (values ('spark', 'ok'), ('data', 'failed'), ('openrouter', 'not_configured'), ('gemini', 'configured'), ('groq', 'not_configured'), ('deepseek', 'not_configured'), ('github', 'configured'), ('sheets', 'not_configured'), ('jobs', 'failed'), ('research', 'missing'), ('mappings', 'missing')) t(part, status)
union all select 'startups', 'ok', count(*) from supplier union all select 'products', 'ok', count(*) from part union all select 'news', 'ok', count(*) from pages""")
def health_report(read, spark):
    """Health by settings, where placeholders are no keys, and of the stored tables: three are whole, one holds what is no Parquet."""
    folder = state.scratch(spark)
    for vertical, table in (("startups", "supplier"), ("products", "part"), ("news", "pages")):
        read(table).write.parquet(f"{folder}/{vertical}")
    read("nation").select(F.col("n_name").alias("value")).write.text(f"{folder}/jobs")
    env = {"DATA_FOLDER": folder, "GEMINI_API_KEY": "k", "GROQ_API_KEY": " your_api_key ", "GITHUB_TOKEN": "t", "CRAWLER_TIMEOUT": "9"}
    parts = [(k, v.split(":")[0], None) for k, v in services.health(spark, config.read(env)).items()]
    return spark.createDataFrame(parts + [(x.table, x.status, x.rows) for x in services.stored_health(spark, folder)], "part string, status string, rows long")
