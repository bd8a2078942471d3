"""What the commands do: the whole run, resolution, reports, health, benchmark."""

from __future__ import annotations

import resource
import time
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import Settings
from tessera.operators import export as X
from tessera.operators import quality, resolve
from tessera.operators.state import Checkpoints, VersionedTable, deleted, read_or_none
from tessera.providers.chain import Chain, chained
from tessera.providers.http import HttpProvider, Limiter, configured_key
from tessera.sources.crawl import CrawlPolicy
from tessera.sources.fetching import Landed, land
from tessera.streaming.ingest import VERTICALS, Counts, ingest

ORDER = ["research", "startups", "products", "news", "jobs"]


def tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The stored tables that exist, by vertical, and the mappings."""
    found = {v: read_or_none(spark, f"{folder}/{v}") for v in VERTICALS}
    found["mappings"] = VersionedTable(spark, f"{folder}/mappings").read()
    return {k: v for k, v in found.items() if v is not None}


def pipeline(spark: SparkSession, settings: Settings, skip: set[str] = frozenset(), only: str | None = None, **more) -> dict:
    """Ingests every vertical in order, resolves names, reports; a vertical that fails does not stop the others."""
    out: dict = {}
    for v in [only] if only else ORDER:
        if v in skip:
            out[v] = "skipped"
            continue
        try:
            c: Counts = ingest(spark, settings.landed_folder, v, settings.data_folder, **more)
            out[v] = {"status": "success" if c.discovered else "no_data", **vars(c), "a_second": c.a_second}
        except Exception as e:  # noqa: BLE001 - each source stands alone
            out[v] = {"status": "failed", "error": str(e)[:300]}
    if not only:
        out["resolve"] = run_resolution(spark, settings.data_folder)
        out["validate"] = validation(spark, settings.data_folder)
    return out


def run_resolution(spark: SparkSession, folder: str, names: list[str] | None = None, chooser=None) -> dict[str, int]:
    """Resolves the stored names of startups, products and jobs (and given ones), stores entities and mappings; counts by method."""
    entities, mappings = VersionedTable(spark, f"{folder}/entities"), VersionedTable(spark, f"{folder}/mappings")
    held = tables(spark, folder)
    asked = spark.createDataFrame([(n, None) for n in names or []], "raw_name string, source_url string")
    for v, name, link in (("startups", "entity_name", "source_url"), ("products", "startup_name", "source_url"), ("jobs", "company", "url")):
        if v in held:
            asked = asked.unionByName(held[v].select(F.col(name).alias("raw_name"), F.col(link).alias("source_url")))
    known = resolve.with_seeds(entities.read(), spark)
    found = resolve.resolve(asked, known, mappings.read(), chooser)
    merged = mappings.upsert(found, "raw_name")
    entities.overwrite(resolve.with_new_aliases(known, merged))
    return {r["match_method"]: r["n"] for r in resolve.method_counts(merged).collect()}


def report(spark: SparkSession, folder: str) -> DataFrame:
    found = tables(spark, folder)
    if not found:
        return spark.createDataFrame([], "table_name string, total long, valid long, invalid long, missing_url long, duplicates long")
    return quality.quality_report(found, {v: "url_fingerprint" for v in VERTICALS} | {"mappings": "raw_name"})


def validation(spark: SparkSession, folder: str) -> dict:
    """The verdict over all tables and their quarantine, with counts of unresolved names."""
    sums = quality.verdict(report(spark, folder)).first().asDict()
    bad = [read_or_none(spark, f"{folder}/quarantine/{v}") for v in VERTICALS]
    sums["quarantined"] = sum(df.count() for df in bad if df is not None)
    m = tables(spark, folder).get("mappings")
    sums["unresolved"] = m.filter("match_method = 'unresolved'").count() if m is not None else 0
    sums["status"] = "FAIL" if sums["quarantined"] else sums["status"]
    return sums


def export(spark: SparkSession, settings: Settings, only: str | None = None, dry_run: bool = False) -> list[X.SheetResult]:
    return X.export(tables(spark, settings.data_folder), settings.export_folder or None, only, dry_run)


def chain(settings: Settings) -> Chain:
    """The providers in the order of the settings: the first, then the fallbacks."""
    made = [HttpProvider(n, getattr(settings, f"{n}_api_key"), getattr(settings, f"{n}_model"), limiter=Limiter(settings.openrouter_rpm_limit, settings.openrouter_daily_request_limit) if n == "openrouter" else None, cache={} if n == "openrouter" else None) for n in ("openrouter", "gemini", "groq", "deepseek")]
    return Chain(chained(made, f"{settings.llm_primary_provider},{settings.llm_fallback_providers}"), settings.llm_max_retries, settings.llm_max_input_chars)


class Stored(NamedTuple):
    """A stored table: ok, empty, missing or failed, with its rows or what went wrong."""

    table: str
    status: str
    rows: int | None = None
    error: str = ""


def stored_health(spark: SparkSession, folder: str) -> list[Stored]:
    """Whether each table that ingest and resolution keep can be read. Every row is: a footer alone would tell the count."""
    out = []
    for name in [*VERTICALS, "mappings"]:
        try:
            rows = VersionedTable(spark, f"{folder}/{name}").read() if name == "mappings" else read_or_none(spark, f"{folder}/{name}")
            n = None if rows is None else rows.select(F.xxhash64(*rows.columns).alias("h")).agg(F.count("h").alias("n")).first()["n"]
            out.append(Stored(name, "missing" if n is None else "ok" if n else "empty", n))
        except Exception as e:  # noqa: BLE001 - each table stands alone
            out.append(Stored(name, "failed", None, str(e)[:100]))
    return out


def health(spark: SparkSession, settings: Settings) -> dict[str, str]:
    """ok or failed for the session and the data folder; configured or not for what is optional."""
    out = {"spark": "ok" if spark.range(1).count() == 1 else "failed"}
    bad = [x for x in stored_health(spark, settings.data_folder) if x.status == "failed"]
    out["data"] = f"failed: {', '.join(f'{x.table}: {x.error}' for x in bad)}" if bad else "ok"
    keys = {n: getattr(settings, f"{n}_api_key") for n in ("openrouter", "gemini", "groq", "deepseek")} | {"github": settings.github_token}
    return out | {k: "configured" if configured_key(v) else "not_configured" for k, v in keys.items()} | {"sheets": "configured" if settings.export_folder else "not_configured"}


def benchmark(spark: SparkSession, folder: str, records: int = 100, rows: DataFrame | None = None) -> dict[str, float]:
    """Writes rows (synthetic ones if none are given), reads them back and deletes them: rows a second, milliseconds a row, and
    by how many MB the driver's Python and its JVM's heap grew. Rows that do not come back as they went have failed; repeated
    ones must come back as often."""
    path = f"{folder.rstrip('/')}/benchmark"
    runtime = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    memory = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024 + (runtime.totalMemory() - runtime.freeMemory()) / 2**20
    if rows is None:
        rows = spark.range(records).select("id", F.concat(F.lit("record "), "id").alias("text"), F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    digest = F.xxhash64(*rows.columns).alias("h")
    before, began = memory(), time.monotonic()
    try:
        rows.write.mode("overwrite").parquet(path)
        back = spark.read.parquet(path).select(digest)
        n = back.agg(F.count("h").alias("n")).first()["n"]
        s = max(time.monotonic() - began, 1e-6)
        went = rows.select(digest, F.lit(1).alias("n")).union(back.select("h", F.lit(-1).alias("n"))).groupBy("h").agg(F.sum("n").alias("n"))
        failed = went.agg(F.coalesce(F.sum(F.greatest("n", F.lit(0))), F.lit(0)).alias("n")).first()["n"]
    finally:
        deleted(spark, [path])
    return {"records": n, "failed": failed, "seconds": s, "records_a_second": n / s, "ms_a_record": 1000 * s / max(1, n), "memory_mb": memory() - before}


def fetch(spark: SparkSession, settings: Settings, vertical: str, limit: int = 50, sources: str | None = None, resume: bool = True, offset: int = 0, workers: int | None = None, transport=None) -> list[Landed]:
    """Fetches and lands payloads of a vertical's sources, from where the last run of each stopped."""
    policy = CrawlPolicy(workers or settings.crawler_concurrency, timeout=settings.crawler_timeout, retries=settings.crawler_max_retries, backoff_base=settings.crawler_backoff_base, backoff_most=settings.crawler_backoff_max, headers={"User-Agent": settings.crawler_user_agent}, token=settings.github_token)
    return land(spark, vertical, settings.landed_folder, limit, sources, Checkpoints(spark, f"{settings.data_folder}/checkpoints"), policy, transport, resume, offset)
