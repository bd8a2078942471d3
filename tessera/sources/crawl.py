"""Fetching URLs on executors: cache, retries with backoff, a pause between requests to one host, failures as rows.

`transport` is any picklable function (url, headers, timeout) -> (status, body, content type, retry after); without one,
urllib is used. Tests and offline runs pass a function over a table of answers.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import url as U
from tessera.functions.classify import PERMANENT, RETRYABLE

SCHEMA = "ord long, url string, fingerprint string, status_code int, content string, content_type string, response_time double, attempts int, success boolean, error string, error_class string, retry_after double, fetched_at timestamp"


@dataclass(frozen=True)
class CrawlPolicy:
    concurrency: int = 10
    delay: float = 0.0
    timeout: float = 30.0
    retries: int = 3
    backoff_base: float = 2.0
    backoff_most: float = 60.0
    jitter: bool = True
    requests_a_minute: float | None = None
    allowed_domains: tuple[str, ...] = ()
    headers: dict = field(default_factory=dict)
    #: A token goes to this host alone.
    token: str = ""
    token_host: str = "api.github.com"

    def __post_init__(self) -> None:
        if self.concurrency < 1 or self.timeout < 1 or self.delay < 0 or self.retries < 1:
            raise ValueError("concurrency, timeout and retries are 1 or more, delay 0 or more")


def urllib_transport(url: str, headers: dict, timeout: float) -> tuple:
    import urllib.error
    import urllib.request

    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
            return r.status, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace"), r.headers.get("Content-Type"), None
    except urllib.error.HTTPError as e:
        after = e.headers.get("Retry-After", "")
        return e.code, None, None, float(after) if after.isdigit() else None


def error_class(status: int | None, error: Exception | None = None) -> str | None:
    """The class of a failure: timeout, connection, rate_limit or http; null of a success."""
    if error is not None:
        reason = getattr(error, "reason", error)
        return "timeout" if isinstance(reason, TimeoutError) or "timed out" in str(reason) else "connection" if isinstance(error, OSError) else "other"
    return None if status is None or status < 400 else "rate_limit" if status == 429 else "http"


def wait(attempt: int, policy: CrawlPolicy, retry_after: float | None = None) -> float:
    """Seconds before the next attempt: the backoff, or what the server asks for if that is more."""
    delay = min(policy.backoff_base**attempt, policy.backoff_most)
    return round(max(random.uniform(0, delay) if policy.jitter else delay, retry_after or 0.0), 3)


def fetch_one(url: str, policy: CrawlPolicy, transport: Callable, sleep: Callable = time.sleep) -> dict:
    """The answer for a URL after at most `retries` attempts; a permanent or unlisted failure ends them at once."""
    host = urlsplit(url).hostname or ""
    row = {"status_code": None, "content": None, "content_type": None, "response_time": 0.0, "attempts": 0, "success": False, "error": None, "error_class": None, "retry_after": None}
    if policy.allowed_domains and not any(host == d or host.endswith("." + d) for d in policy.allowed_domains):
        return row | {"error": "domain not allowed", "error_class": "not_allowed"}
    headers = dict(policy.headers) | ({"Authorization": f"Bearer {policy.token}"} if policy.token and host == policy.token_host else {})
    for attempt in range(1, policy.retries + 1):
        began = time.monotonic()
        try:
            status, body, kind, after = transport(url, headers, policy.timeout)
            row |= {"status_code": status, "content": body, "content_type": kind, "retry_after": after, "success": status < 400, "error": None if status < 400 else f"HTTP {status}", "error_class": error_class(status)}
        except Exception as e:  # a failing request is a row
            row |= {"status_code": None, "success": False, "error": f"{type(e).__name__}: {e}", "error_class": error_class(None, e)}
        row |= {"attempts": attempt, "response_time": time.monotonic() - began}
        status = row["status_code"]
        if row["success"] or status in PERMANENT or (status is not None and status not in RETRYABLE) or attempt == policy.retries:
            break
        sleep(wait(attempt, policy, row["retry_after"] if status == 429 else None))
    return row


def fetch(urls: DataFrame, policy: CrawlPolicy | None = None, transport: Callable | None = None, cache: DataFrame | None = None) -> DataFrame:
    """SCHEMA for each row of urls (ord, url). URLs with a successful row in cache (of SCHEMA) are answered from it.

    At most `concurrency` requests are under way at a time, in as many tasks as the cluster has cores for, and side by side
    in threads of a task. Requests to one host go one after the other with the policy's pause, so hosts never wait for one
    another, and a host is never asked by two. A URL that occurs more than once is fetched once.
    """
    policy, send = policy or CrawlPolicy(), transport or urllib_transport
    asked = urls.select("ord", "url").withColumn("fingerprint", U.url_fingerprint(F.col("url")))
    once = asked.groupBy("fingerprint").agg(F.min_by("url", "ord").alias("url"))
    columns = [c.split()[0] for c in SCHEMA.split(", ")][3:]
    if cache is not None:
        held = cache.filter("success").join(once.select("fingerprint"), "fingerprint", "left_semi").dropDuplicates(["fingerprint"]).select("fingerprint", *columns)
        once = once.join(held.select("fingerprint"), "fingerprint", "left_anti")
    pause = max(policy.delay, 60.0 / policy.requests_a_minute if policy.requests_a_minute else 0.0)

    tasks = max(1, min(policy.concurrency, asked.sparkSession.sparkContext.defaultParallelism))
    threads = -(-policy.concurrency // tasks)

    def of_host(rows: list[tuple], last: dict[str, float]) -> list[dict]:
        out = []
        for fp, url in rows:
            host = urlsplit(url or "").netloc
            if pause and host in last:
                time.sleep(max(0.0, last[host] + pause - time.monotonic()))
            last[host] = time.monotonic()
            out.append({"fingerprint": fp, **fetch_one(url or "", policy, send), "fetched_at": pd.Timestamp.now(tz="UTC")})
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[str, float] = {}
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                hosts: dict[str, list[tuple]] = {}
                for fp, url in zip(batch["fingerprint"], batch["url"], strict=True):
                    hosts.setdefault(urlsplit(url or "").netloc, []).append((fp, url))
                rows = [r for part in pool.map(lambda h: of_host(h, last), hosts.values()) for r in part]
                yield pd.DataFrame(rows, columns=["fingerprint", *columns])

    schema = "fingerprint string, " + ", ".join(SCHEMA.split(", ")[3:])
    done = once.repartition(tasks, U.host(F.col("url"))).mapInPandas(run, schema)
    if cache is not None:
        done = done.unionByName(held)
    return asked.join(done, "fingerprint").select("ord", "url", "fingerprint", *columns)


def summary(results: DataFrame) -> DataFrame:
    """total, succeeded, failed and bytes of a crawl."""
    return results.agg(F.count("*").alias("total"), F.count_if("success").alias("succeeded"), F.count_if(~F.col("success")).alias("failed"), F.sum(F.octet_length("content")).alias("bytes"))
