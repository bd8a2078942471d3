"""Flat rows for spreadsheets: projections of stored rows, file sinks, telemetry."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.url import without_secrets

# Headers of the exported sheets.
HEADERS = {
    "research": ["paper_url", "title", "authors", "published_date", "github_url", "github_stars", "abstract", "source_name", "source_url", "collected_at", "canonical_entity_id"],
    "startups": ["entity_name", "website", "description", "employee_count", "founded_date", "location", "funding", "source_url", "category", "qualification_status", "canonical_entity_id", "collected_at"],
    "products": ["product_name", "startup_name", "website", "description", "pricing_model", "source_url", "license", "qualification_category", "canonical_entity_id", "collected_at"],
    "news": ["title", "url", "published_date", "full_text", "source_name", "source_url", "canonical_entity_id", "collected_at"],
    "jobs": ["company", "date", "is_remote", "role_family", "url", "source_name", "canonical_entity_id", "collected_at"],
    "mappings": ["raw_name", "normalized_name", "canonical_name", "canonical_id", "match_method", "confidence", "source_url", "timestamp"],
}
ALIASES = {"papers": "research", "research_papers": "research", "startup": "startups", "product": "products", "job": "jobs", "entity_mappings": "mappings", "entities": "mappings", "mapping": "mappings"}
#: Other names under which a stored row may have a column, in order of preference.
_SOURCES = {
    "research": {"paper_url": ["paper_url", "source_url"], "source_url": ["source_url", "paper_url"], "collected_at": ["collectedAt", "collected_at"]},
    "startups": {"entity_name": ["entityName", "canonical_name", "entity_name"], "website": ["website", "source_url"], "employee_count": ["employeeCount", "employee_count"], "founded_date": ["founded_date", "foundedDate"], "collected_at": ["collectedAt", "collected_at"]},
    "products": {"product_name": ["product_name", "startupName", "canonical_startup_name"], "startup_name": ["startupName", "canonical_startup_name", "startup_name"], "website": ["website", "source_url"], "pricing_model": ["pricingModel", "pricing_model"], "qualification_category": ["category", "qualification_category"], "canonical_entity_id": ["canonical_startup_id", "canonical_entity_id"], "collected_at": ["collectedAt", "collected_at"]},
    "news": {"url": ["url", "source_url"], "source_url": ["source_url", "url"], "collected_at": ["collectedAt", "collected_at"]},
    "jobs": {"url": ["source_url", "url"], "collected_at": ["collectedAt", "collected_at"]},
    "mappings": {"canonical_id": ["canonical_id", "canonical_entity_id"], "timestamp": ["timestamp", "created_at", "resolved_at"]},
}
_REQUIRED = {"research": ["title", "paper_url"], "startups": ["entity_name"], "products": ["product_name"], "news": ["title", "url"], "jobs": ["company"], "mappings": ["raw_name", "canonical_name"]}


def vertical(name: str) -> str:
    """The sheet of a name or alias."""
    name = name.strip().lower()
    name = ALIASES.get(name, name)
    if name not in HEADERS:
        raise ValueError(f"unknown vertical {name!r}; known: {', '.join(HEADERS)}")
    return name


def _truth(c: Column) -> Column:
    return F.initcap(c.cast("string"))


def rows(df: DataFrame, kind: str) -> DataFrame:
    """The sheet's rows as strings (empty for what is missing), in its columns; rows without what is required are left out.

    Nothing is inferred: a licence is no price, an unknown head count stays empty.
    """
    kind = vertical(kind)
    out = {}
    types = dict(df.dtypes)
    for h in HEADERS[kind]:
        have = [n for n in _SOURCES[kind].get(h, [h]) if n in types]
        if h == "authors" and "authors" in types:
            out[h] = F.array_join(F.coalesce("authors", F.array().cast("array<string>")), ", ") if types["authors"].startswith("array") else F.col("authors")
        elif h == "qualification_status":
            flag = F.when(F.col("is_qualified"), "QUALIFIED").when(~F.col("is_qualified"), "UNQUALIFIED") if "is_qualified" in types else F.lit(None)
            out[h] = F.coalesce(flag, *([F.col(h)] if h in types else []))
        elif h == "is_remote" and have:
            out[h] = _truth(F.col("is_remote"))
        elif h in ("description", "full_text", "abstract"):
            out[h] = F.coalesce(*[F.col(n) for n in have]) if have else F.lit(None)
        else:
            out[h] = F.coalesce(*[F.nullif(F.col(n).cast("string"), F.lit("")) for n in have]) if have else F.lit(None)
        if h == "source_name" and kind == "research":
            out[h] = F.coalesce(out[h], F.lit("arXiv/GitHub"))
    flat = df.select(*[F.coalesce(c.cast("string"), F.lit("")).alias(h) for h, c in out.items()])
    for h in _REQUIRED[kind]:
        flat = flat.filter(F.col(h) != "")
    return flat


def safe(df: DataFrame) -> DataFrame:
    """Cells that a spreadsheet would read as formulas begin with an apostrophe."""
    kinds = dict(df.dtypes)
    return df.select(*[F.when(F.col(c).rlike(r"^[=+\-@]"), F.concat(F.lit("'"), F.col(c))).otherwise(F.col(c)).alias(c) if kinds[c] == "string" else F.col(c) for c in df.columns])


def telemetry(tables: dict[str, DataFrame]) -> DataFrame:
    """By sheet: queried, written and skipped rows."""
    from functools import reduce

    parts = []
    for name, df in tables.items():
        kind = vertical(name)
        seen = df.agg(F.count("*").alias("queried")).withColumn("sheet", F.lit(kind))
        kept = rows(df, kind).agg(F.count("*").alias("written")).withColumn("sheet", F.lit(kind))
        parts.append(seen.join(kept, "sheet").select("sheet", "queried", "written", (F.col("queried") - F.col("written")).alias("skipped")))
    return reduce(DataFrame.unionByName, parts)


def column_letter(n: int) -> str:
    """The letters of a sheet's column, counted from 1: A to Z, AA, AB ..."""
    out = ""
    while n > 0:
        n, at = divmod(n - 1, 26)
        out = chr(65 + at) + out
    return out


def layout(headers: list[str], n: int) -> dict:
    """How a sheet of n rows under these headers is shown: header bold and frozen, a filter over all, texts wrapped."""
    last = column_letter(len(headers))
    return {"frozen_rows": 1, "bold": f"A1:{last}1", "filter": f"A1:{last}{n + 1}", "wrap": f"A1:{last}{n + 1}", "autosize": [column_letter(i) for i in range(1, len(headers) + 1)]}


def over_quota(e: Exception) -> bool:
    """Whether a sink refused a write for now: another try may pass."""
    return any(x in str(e).lower() for x in ("429", "quota", "rate limit"))


def put(call: Callable, sleep: Callable[[float], None] = time.sleep):
    """A sink's write, tried at most five times while it is over its quota; other errors come without the secrets they quote."""
    from tessera.retry import retrying

    try:
        return retrying(5, 1.0, 16.0, 0.5, over_quota, sleep)(call)()
    except Exception as e:
        raise RuntimeError(without_secrets(str(e))) from None


@dataclass
class SheetResult:
    sheet: str
    queried: int
    written: int
    skipped: int
    seconds: float
    status: str


def export(tables: dict[str, DataFrame], folder: str | None, only: str | None = None, dry_run: bool = False) -> list[SheetResult]:
    """Overwrites one CSV folder a sheet (with header), and how it is shown (layouts/<sheet>); without a folder nothing is configured, on a dry run nothing is written."""
    wanted = vertical(only) if only else None
    out = []
    for name, df in tables.items():
        kind, began = vertical(name), time.monotonic()
        if wanted and kind != wanted:
            continue
        flat = safe(rows(df, kind))
        if folder is None and not dry_run:
            out.append(SheetResult(kind, 0, 0, 0, 0.0, "not_configured"))
            continue
        if not dry_run:
            put(lambda flat=flat, kind=kind: flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder.rstrip('/')}/{kind}"))
        queried, valid = df.count(), flat.count()
        if not dry_run:
            shown = df.sparkSession.createDataFrame([(json.dumps(layout(flat.columns, valid)),)], "layout string")
            put(lambda shown=shown, kind=kind: shown.coalesce(1).write.mode("overwrite").text(f"{folder.rstrip('/')}/layouts/{kind}"))
        out.append(SheetResult(kind, queried, 0 if dry_run else valid, queried - valid, time.monotonic() - began, "dry_run" if dry_run else "written"))
    return out
