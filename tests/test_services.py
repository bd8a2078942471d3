"""Providers, ingest, streams, services, commands, settings."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tessera import cli, config
from tessera.operators import state
from tessera.plans import services
from tessera.providers import chain as C
from tessera.providers import http, models
from tessera.streaming import ingest as I


class Fake:
    def __init__(self, name, *replies, ready=True):
        self.name, self.model, self.replies, self.ready, self.seen = name, "m", list(replies), ready, []

    def configured(self):
        return self.ready

    def generate(self, r):
        self.seen.append(r)
        reply = self.replies.pop(0) if self.replies else "{}"
        if isinstance(reply, Exception):
            raise reply
        return models.Answer(reply, self.name, "m", 3, 4)


def chain(*providers, **more):
    return C.Chain(list(providers), sleep=lambda s: None, **more)


def test_fallback():
    a, b = Fake("a", models.AuthError("no")), Fake("b", "yes")
    c = chain(Fake("z", ready=False), a, b)
    assert c.generate(models.Request("p")).text == "yes"
    assert [(x.provider, x.success, x.attempts) for x in c.telemetry.calls] == [("a", False, 1), ("b", True, 1)]
    assert c.health() == {"z": "not_configured", "a": "configured", "b": "configured"}
    with pytest.raises(models.AllFailed, match="z: not configured"):
        chain(Fake("z", ready=False)).generate(models.Request("p"))


def test_retries_and_shrinking():
    a = Fake("a", models.RateLimited("x"), models.TimedOut("x"), "ok")
    assert chain(a).generate(models.Request("p")).text == "ok" and len(a.seen) == 3
    big = Fake("a", models.TooLarge("x"), "ok")
    assert chain(big).generate(models.Request("line\n" * 1000)).text == "ok"
    assert len(big.seen[1].prompt) <= 2500 < len(big.seen[0].prompt)
    assert chain(Fake("a", models.TooLarge("x"), models.TooLarge("x")), Fake("b", "ok")).generate(models.Request("p" * 3000)).provider == "b"


def test_structured():
    a = Fake("a", "no json", '```json\n{"x": 1}\n```')
    assert chain(a).structured(models.Request("p")) == {"x": 1} and "not valid" in a.seen[1].prompt
    with pytest.raises(models.BadAnswer):
        chain(Fake("a", "no", "no")).structured(models.Request("p"))
    assert chain(Fake("a", '{"x": 1}', '[{"x": 2}]')).structured(models.Request("p"), lambda d: [] if d["x"] == 2 else ["x is not 2"]) == {"x": 2}


@pytest.mark.parametrize(("status", "kind"), [(401, models.AuthError), (408, models.TimedOut), (413, models.TooLarge), (429, models.RateLimited), (500, models.ProviderError)])
def test_http(status, kind):
    p = http.HttpProvider("groq", "secret", post=lambda *a: (status, {"error": "bad secret"}))
    with pytest.raises(kind) as e:
        p.generate(models.Request("p"))
    assert "secret" not in str(e.value)


def test_http_bodies():
    sent = []

    def post(url, headers, body, timeout):
        sent.append(body)
        return (400, {}) if "response_format" in body else (200, {"choices": [{"message": {"content": "hi"}}], "usage": {"prompt_tokens": 1, "completion_tokens": 2}})

    p = http.HttpProvider("openrouter", "k", post=post, cache={}, limiter=http.Limiter(2, 9, clock=lambda: 0.0))
    r = models.Request("p", "s", schema="json")
    assert p.generate(r).text == "hi" == p.generate(r).text and len(sent) == 2
    p.generate(models.Request("q"))
    with pytest.raises(models.RateLimited):
        p.generate(models.Request("z"))
    g = http.HttpProvider("gemini", "k", post=lambda *a: (200, {"candidates": [{"content": {"parts": [{"text": "g"}]}}]}))
    assert g.generate(models.Request("p")).text == "g"
    assert not http.HttpProvider("groq", "your_api_key").configured()
    with pytest.raises(ValueError):
        models.Request("", max_tokens=0)
    assert [p.name for p in C.chained([Fake("a"), Fake("b")], "B, a,b,x")] == ["b", "a"]
    now = [0.0]
    day = http.Limiter(99, 2, clock=lambda: now[0])
    day.check(), day.check()
    with pytest.raises(models.RateLimited):
        day.check()
    now[0] = 86_400.0
    day.check()


def test_extract(spark):
    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None)], "k int, p string")
    make = lambda: C.Chain([http.StubProvider(lambda p: "oops" if "bad" in p else '{"n": 5}')])
    got = {r.k: (r.answer.n if r.answer else None, (r.error or "").split(":")[0]) for r in C.extract(df, "k", "p", make, "n int").collect()}
    assert got == {1: (5, ""), 2: (None, "structured_output"), 3: (None, "invalid_request")}


def test_tasks_share_limits(spark):
    """Five tasks have a fifth of a day's budget each."""
    df = spark.range(60).select("id", F.lit("a").alias("p"))
    made = lambda: C.Chain([http.HttpProvider("openrouter", "k", post=lambda *a: (200, {"choices": [{"message": {"content": '{"n": 1}'}}]}), limiter=http.Limiter(1000, 10))], retries=1)
    got = C.extract(df, "id", "p", made, "n int", concurrency=5).collect()
    assert 5 <= sum(r.answer is not None for r in got) <= 10
    assert http.Limiter(20, 50).part(5).a_day == 10 and http.Limiter(2, 3).part(9).a_minute == 1


def test_entity_chooser(spark):
    from tessera.operators import resolve

    dim = spark.createDataFrame([("a", "alpha systems one", []), ("b", "alpha systems two", [])], "canonical_id string, canonical_name string, aliases array<string>")
    names = spark.createDataFrame([("alpha systems", "u")], "raw_name string, source_url string")
    ask = lambda reply: resolve.resolve(names, dim, chooser=C.entity_chooser(lambda: C.Chain([http.StubProvider(lambda p: reply)]))).first()
    assert ask('{"selected_canonical_id": "b", "confidence": 0.8}').canonical_id == "b"
    assert ask('{"selected_canonical_id": null}').match_method == "unresolved"


# ---- ingest -----------------------------------------------------------------------------------------------------------

NOW = dt.datetime(2026, 8, 15, 12)


def land(folder, vertical, source, name, body):
    path = folder / "landed" / vertical / source
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(body if isinstance(body, str) else json.dumps(body))


def job(i, **more):
    return {"company_name": f"C{i}", "title": f"Backend {i}", "url": f"https://j/{i}", "created_at": 1786708800 + i, "remote": True, **more}


def test_ingest(spark, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    land(tmp_path, "jobs", "arbeitnow", "1.json", {"data": [job(1), job(2), job(1), job(3, created_at=1000)]})
    land(tmp_path, "jobs", "remoteok", "1.json", [{"position": "Ops", "url": "https://r/1", "date": "2026-08-15T10:00:00Z"}])
    land(tmp_path, "jobs", "arbeitnow", "2.json", "broken")
    dry = I.ingest(spark, landed, "jobs", out, now=NOW, dry_run=True)
    assert (dry.discovered, dry.inserted, dry.duplicates) == (5, 4, 1) and not (tmp_path / "out").exists()
    first = I.ingest(spark, landed, "jobs", out, batch_files=1, now=NOW)
    assert (first.inserted, first.duplicates, first.invalid) == (4, 1, 0)
    assert I.ingest(spark, landed, "jobs", out, now=NOW).discovered == 0
    land(tmp_path, "jobs", "arbeitnow", "3.json", {"data": [job(2), job(9)]})
    more = I.ingest(spark, landed, "jobs", out, now=NOW)
    assert (more.inserted, more.duplicates) == (1, 1)
    rows = {r.company: r for r in spark.read.parquet(f"{out}/jobs").collect()}
    assert rows["C3"].freshness_status == "stale" and rows["C3"].date == dt.datetime(2026, 8, 15, 11) and rows["C1"].freshness_status == "fresh"
    assert rows["C1"].role_family == "Engineering" and len(rows) == 5


def test_counts_of_a_batch(spark, tmp_path):
    land(tmp_path, "jobs", "arbeitnow", "1.json", {"data": [job(1), job(2), job(1)]})
    land(tmp_path, "jobs", "arbeitnow", "2.json", "broken")
    land(tmp_path, "jobs", "weworkremotely", "1.xml", "<rss><channel>")
    land(tmp_path, "jobs", "unknown", "1.json", "broken too, but of no source")
    c = I.ingest(spark, str(tmp_path / "landed"), "jobs", str(tmp_path / "out"), now=NOW)
    assert (c.processed, c.valid, c.inserted, c.duplicates, c.invalid, c.failed, c.last_item) == (3, 3, 2, 1, 0, 2, "Backend 1")
    row = state.Checkpoints(spark, str(tmp_path / "out" / "checkpoints")).get("jobs", "all")
    assert (row.status, row.valid, row.failed, row.last_item, row.cursor) == ("completed", 3, 2, "Backend 1", "0")


def test_first_wins_in_order_of_path_and_place(spark, tmp_path):
    """Of startups that share a name, that of the first path stays, however large the files are."""
    org = lambda n, i, **more: {"name": n, "login": f"l{i}", "html_url": f"https://github.com/{i}", **more}
    land(tmp_path, "startups", "github", "a.json", {"items": [org("Acme", 1, description="x" * 50_000), org("Acme", 2)]})
    land(tmp_path, "startups", "github", "b.json", {"items": [org("Acme", 3), org("Bolt", 4)]})
    land(tmp_path, "startups", "github", "c.json", {"items": [org("Bolt", 1), org("Cork", 5)]})
    I.ingest(spark, str(tmp_path / "landed"), "startups", str(tmp_path / "out"), now=NOW)
    rows = spark.read.parquet(str(tmp_path / "out" / "startups")).collect()
    assert sorted((r.entity_name, r.source_url) for r in rows) == [("Acme", "https://github.com/1"), ("Bolt", "https://github.com/4"), ("Cork", "https://github.com/5")]


def test_limited_ingest_goes_on_where_it_stopped(spark, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    land(tmp_path, "jobs", "arbeitnow", "1.json", {"data": [job(i) for i in range(6)]})
    land(tmp_path, "jobs", "jobicy", "1.json", {"jobs": [{"companyName": f"J{i}", "jobTitle": "T", "url": f"https://y/{i}", "pubDate": "2026-08-15"} for i in range(6)]})
    names = lambda: sorted(r.company for r in spark.read.parquet(f"{out}/jobs").collect())
    run = lambda **more: I.ingest(spark, landed, "jobs", out, sources="arbeitnow,jobicy", now=NOW, **more)
    marks = state.Checkpoints(spark, f"{out}/checkpoints")

    dry = run(limit=4, dry_run=True)
    assert (dry.processed, dry.inserted) == (4, 4) and not (tmp_path / "out").exists()

    def stop(c):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        run(limit=8, batch_rows=3, on_batch=stop)
    assert names() == ["C0", "C1", "C2"]
    row = marks.get("jobs", "arbeitnow,jobicy")
    assert (row.status, row.processed, row.inserted, row.last_item) == ("interrupted", 3, 3, "Backend 2")
    assert (marks.get("jobs", "arbeitnow").cursor, marks.get("jobs", "jobicy").cursor) == ("3", "0")

    more = run(limit=8)
    assert (more.processed, more.inserted, more.duplicates) == (8, 8, 0)
    assert names() == ["C0", "C1", "C2", "C3", "C4", "C5", "J0", "J1"]
    assert marks.get("jobs", "arbeitnow,jobicy").status == "completed"
    again = run(limit=4)  # a completed run starts anew
    assert (again.processed, again.inserted, again.duplicates) == (4, 0, 4)
    late = run(limit=4, offset=4, resume=False)
    assert (late.inserted, late.duplicates) == (2, 2) and "J5" in names()
    rest = run(offset=2, resume=False)
    assert (rest.processed, rest.inserted) == (8, 2) and len(names()) == 12
    short = run(limit=100, resume=False)
    assert (short.processed, marks.get("jobs", "arbeitnow,jobicy").status) == (12, "running")
    land(tmp_path, "jobs", "arbeitnow", "2.json", {"data": [job(7)]})
    assert run(limit=100).processed == 13


def test_stream_keeps_its_counters(spark, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    for i in range(3):
        land(tmp_path, "jobs", "arbeitnow", f"{i}.json", {"data": [job(i)]})

    def stop(c):
        raise RuntimeError("stop")

    with pytest.raises(Exception, match="stop"):
        I.ingest(spark, landed, "jobs", out, batch_files=1, now=NOW, on_batch=stop)
    marks = state.Checkpoints(spark, f"{out}/checkpoints")
    assert (marks.get("jobs", "all").status, marks.get("jobs", "all").processed) == ("interrupted", 1)
    done = I.ingest(spark, landed, "jobs", out, batch_files=1, now=NOW)
    # The batch that was not finished is taken again and counted once.
    assert (done.processed, done.inserted, spark.read.parquet(f"{out}/jobs").count()) == (3, 3, 3)
    over = I.ingest(spark, landed, "jobs", out, now=NOW, resume=False)
    assert (over.processed, over.inserted, over.duplicates) == (3, 0, 3)


# ---- fetching ---------------------------------------------------------------------------------------------------------


def _answers(url, headers, timeout):
    """Canned pages: two pages of jobs, then none; repositories by topic, the second topic empty, the third failing."""
    from urllib.parse import parse_qs, urlsplit

    q = {k: v[0] for k, v in parse_qs(urlsplit(url).query).items()}
    page = int(q.get("page", 1))
    if "arbeitnow" in url:
        return 200, json.dumps({"data": [job(100 * page + i) for i in range(15 if page == 1 else 4 if page == 2 else 0)]}), "application/json", None
    if "remoteok" in url:
        return 503, None, None, 0.0
    if "search/repositories" in url:
        topic = q["q"].split()[0].removeprefix("topic:")
        n = {"ai-tool": 50 if page < 3 else 0, "llm": 50, "ai": 0}.get(topic)
        if n is None:
            return 404, None, None, None
        return 200, json.dumps({"items": [{"name": f"r{page}-{i}", "owner": {"login": topic}, "html_url": f"https://github.com/{topic}/r{page}-{i}"} for i in range(n)]}), "application/json", None
    return 404, None, None, None


def test_fetch_and_land(spark, tmp_path):
    from tessera.sources import crawl, fetching

    landed, marks = str(tmp_path / "landed"), state.Checkpoints(spark, str(tmp_path / "out" / "checkpoints"))
    policy = crawl.CrawlPolicy(backoff_base=0.0, jitter=False, retries=2)
    go = lambda v, n, **more: fetching.land(spark, v, landed, n, marks=marks, policy=policy, transport=_answers, **more)
    got = {x.source: x for x in go("jobs", 60, sources="arbeitnow,remoteok")}
    assert (got["arbeitnow"].status, got["arbeitnow"].rows, got["arbeitnow"].pages) == ("exhausted", 19, 2)
    assert (got["remoteok"].status, got["remoteok"].rows, got["remoteok"].failed) == ("exhausted", 0, 1)
    c = I.ingest(spark, landed, "jobs", str(tmp_path / "out"), now=NOW)
    assert (c.processed, c.inserted, c.failed) == (19, 19, 0)

    first = go("products", 60)[0]
    assert (first.segment, first.page, first.pages, first.rows, first.status) == (0, 3, 2, 100, "completed")
    row = marks.get("products", "fetch:github")
    assert (row.segment, row.page, row.processed, row.status) == (0, 3, 100, "running")
    # Goes on at page 3: it is empty, so the next topics are tried: one empty, then one with rows.
    more = go("products", 40)[0]
    assert (more.segment, more.page, more.rows) == (2, 2, 50)
    end = fetching.land_source(spark, "products", "github", landed, 10**6, policy, _answers, fetching.Landed("github", 2, 10), 4)
    assert (end.status, end.rows, end.segment) == ("exhausted", 50, 20)
    rows = I.ingest(spark, landed, "products", str(tmp_path / "out"), now=NOW, limit=120)
    assert rows.inserted == 120
    kept = spark.read.parquet(str(tmp_path / "out" / "products"))
    assert kept.filter("startup_name = 'ai-tool'").count() == 100, "rows are taken in the order in which pages were asked for"


def test_ingest_others(spark, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    orgs = {"items": [{"name": "Acme Inc", "login": "a", "html_url": "https://GitHub.com/a"}, {"name": "Acme Inc", "login": "b", "html_url": "https://github.com/b"}, {"name": "B", "login": "b", "html_url": "https://github.com/b"}]}
    land(tmp_path, "startups", "github", "1.json", orgs)
    land(tmp_path, "products", "github", "1.json", {"items": [{"name": "p", "owner": {"login": "OpenAI"}, "html_url": "https://github.com/o/p", "description": "free tier"}]})
    land(tmp_path, "research", "arxiv", "1.xml", '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/1.1v1</id><title>T</title></entry></feed>')
    land(tmp_path, "news", "devto", "1.json", [{"title": "T", "url": "not a url", "published_at": "2026-08-15T10:00:00Z"}, {"title": "T", "url": "https://n/1"}])
    got = {v: I.ingest(spark, landed, v, out, now=NOW) for v in ("startups", "products", "research", "news")}
    assert (got["startups"].inserted, got["startups"].duplicates) == (2, 1)
    assert got["products"].inserted == got["research"].inserted == 1
    assert (got["news"].inserted, got["news"].invalid) == (1, 1)
    assert spark.read.parquet(f"{out}/news").first().freshness_status == "missing_date"
    assert services.validation(spark, out)["status"] == "FAIL"
    methods = services.run_resolution(spark, out, ["Anthropic"])
    assert methods["exact"] == 2 and methods["unresolved"] == 2
    assert {r.table_name for r in services.report(spark, out).collect()} == {"startups", "products", "research", "news", "mappings"}
    code, sheets = cli.run(cli.parser().parse_args(["export"]), {"DATA_FOLDER": out, "EXPORT_FOLDER": str(tmp_path / "x")}, spark)
    assert code == cli.DONE and {s["sheet"] for s in sheets} == {"startups", "products", "research", "news", "mappings"}
    with pytest.raises(ValueError):
        I.ingest(spark, landed, "x", out)


def test_rate_window(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    df = spark.createDataFrame([("a", at(0)), ("a", at(59)), ("a", at(60)), ("b", at(60)), ("a", at(200))], "k string, t timestamp")
    assert sorted((r.k, r.t.minute * 60 + r.t.second, r.in_window) for r in I.rate_window(df, "k", "t").collect()) == [("a", 0, 1), ("a", 59, 2), ("a", 60, 2), ("a", 200, 1), ("b", 60, 1)]
    hit, miss = I.answer_cache(spark.createDataFrame([("f1",), ("f2",)], "fingerprint string"), spark.createDataFrame([("f1", "x")], "fingerprint string, answer string"))
    assert hit.first().answer == "x" and miss.first().fingerprint == "f2"


def test_streams(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    src = str(tmp_path / "s")
    spark.createDataFrame([("a", at(s)) for s in (0, 1, 2, 30, 61)] + [("b", at(5))], "k string, t timestamp").coalesce(1).write.parquet(src)
    stream = lambda: spark.readStream.schema("k string, t timestamp").parquet(src)

    def run(df, name, mode):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted(tuple(r) for r in spark.table(name).collect())

    got = run(I.limited_stream(stream(), "k", "t", 3), "limited", "append")
    assert [(k, ok) for k, _, ok in got] == [("a", True), ("a", True), ("a", True), ("a", False), ("a", True), ("b", True)]
    assert [(k, n) for k, _, n in run(I.rate_stream(stream(), "k", "t", 3), "rate", "complete")] == [("a", 4)]


# ---- commands ---------------------------------------------------------------------------------------------------------


def test_commands(spark, tmp_path):
    env = {"DATA_FOLDER": str(tmp_path / "out"), "LANDED_FOLDER": str(tmp_path / "landed")}
    do = lambda *a, **e: cli.run(cli.parser().parse_args(a), {**env, **e}, spark)
    assert do("health")[0] == cli.DONE and do("status") == (cli.DONE, [])
    land(tmp_path, "jobs", "arbeitnow", "1.json", {"data": [job(1)]})
    code, got = do("jobs", "--batch-size", "5")
    assert code == cli.DONE and got["inserted"] == 1
    assert do("status")[1][0]["status"] == "completed"
    assert do("validate")[0] == cli.DONE and do("stats")[1][0]["total"] == 1
    assert do("resolve", "OpenAI")[1] == {"exact": 1, "unresolved": 1}
    assert do("export")[0] == cli.CONFIG and do("export", "--dry-run", "--vertical", "x")[0] == cli.ARGUMENTS
    assert do("reset-checkpoints", "--vertical", "jobs")[1]["deleted"] >= 1
    code, got = do("benchmark", "--records", "10")
    assert got["records"] == 10 and got["failed"] == 0 and "memory_mb" in got and not (tmp_path / "out" / "benchmark").exists()
    args = cli.parser().parse_args(["jobs", "--limit", "7", "--offset", "2", "--no-resume", "--batch-rows", "3"])
    assert (args.limit, args.offset, args.resume, args.batch_rows) == (7, 2, False, 3)
    assert cli.parser().parse_args(["crawl-test", "http://a", "--concurrency", "3"]).concurrency == 3
    assert do("jobs", "--limit", "1", "--no-resume")[1]["duplicates"] == 1
    assert do("llm-health")[1]["groq"] == "not_configured" and do("llm-smoke-test")[0] == cli.SERVICE
    assert do("news")[0] == cli.SERVICE
    code, got = do("pipeline", "--skip-news", "--skip-research", "--skip-startups", "--skip-products")
    assert code == cli.DONE and got["jobs"]["status"] == "no_data" and got["news"] == "skipped" and got["validate"]["status"] == "PASS"
    assert do("health", CRAWLER_TIMEOUT="x")[0] == cli.CONFIG
    assert cli.main(["nope"]) == cli.ARGUMENTS


def test_settings():
    s = config.read({"CRAWLER_TIMEOUT": "9", "SHEETS_ENABLED": "Yes", "LLM_BACKOFF_BASE": "1.5"})
    assert (s.crawler_timeout, s.sheets_enabled, s.llm_backoff_base, s.crawler_concurrency) == (9, True, 1.5, 10)


def test_health_of_stored_tables(spark, tmp_path):
    out = str(tmp_path / "out")
    spark.range(3).write.parquet(f"{out}/startups")
    spark.range(0).write.parquet(f"{out}/products")
    (tmp_path / "out" / "news").mkdir()
    (tmp_path / "out" / "news" / "part-0.parquet").write_text("no Parquet")
    got = {x.table: x for x in services.stored_health(spark, out)}
    assert (got["startups"].status, got["startups"].rows) == ("ok", 3)
    assert (got["products"].status, got["products"].rows) == ("empty", 0)
    assert got["jobs"].status == got["mappings"].status == "missing" and got["jobs"].rows is None
    assert got["news"].status == "failed" and got["news"].error


def test_benchmark_tells_what_did_not_come_back(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (1, None), (2, "x")], "id int, text string")
    got = services.benchmark(spark, str(tmp_path), rows=rows)
    assert (got["records"], got["failed"]) == (3, 0) and not (tmp_path / "benchmark").exists()
    # Rows that are another thing each time they are made don't come back as they went.
    assert services.benchmark(spark, str(tmp_path), rows=rows.withColumn("at", F.expr("java_method('java.util.UUID', 'randomUUID')")))["failed"] == 3


def test_many_small_payloads_are_few_batches(spark, tmp_path):
    """A batch has a fixed cost: small files go together by their bytes."""
    import json

    from tessera.streaming import ingest as I

    at = tmp_path / "landed" / "startups" / "github"
    at.mkdir(parents=True)
    for i in range(60):
        (at / f"{i}.json").write_text(json.dumps({"items": [{"name": f"Org {i}", "html_url": f"https://github.com/o{i}"}]}))
    batches = []
    got = I.ingest(spark, str(tmp_path / "landed"), "startups", str(tmp_path / "out"), on_batch=batches.append)
    assert got.inserted == 60 and len(batches) == 1
