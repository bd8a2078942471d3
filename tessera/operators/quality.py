"""Row constraints with quarantine, and reports on tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.basic import filled
from tessera.functions.dates import job_date
from tessera.functions.url import http_url

PRICING_MODELS = ["FREE", "FREEMIUM", "PAID", "ENTERPRISE"]
METHODS = ["exact", "normalized", "alias", "fuzzy", "llm", "unresolved"]
_TRUE, _FALSE = ["true", "t", "yes", "y", "on", "1"], ["false", "f", "no", "n", "off", "0"]


#: Columns that the constraints of each kind of row name.
_COLUMNS = {
    "startup": ["schemaVersion", "recordType", "source_name", "source_url", "entityName", "employeeCount", "collectedAt"],
    "product": ["schemaVersion", "recordType", "source_name", "source_url", "startupName", "pricingModel", "collectedAt"],
    "paper": ["schemaVersion", "recordType", "title", "paper_url", "github_url", "github_stars", "published_date", "collectedAt"],
    "news": ["schemaVersion", "recordType", "source_name", "source_url", "title", "url", "published_date", "collectedAt"],
    "job": ["schemaVersion", "recordType", "company", "date", "is_remote", "collectedAt"],
    "mapping": ["raw_name", "normalized_name", "canonical_name", "canonical_id", "match_method", "confidence", "source_url", "timestamp"],
}


def lax_bool(c: Column) -> Column:
    """A boolean as a lax reader takes it; null for anything else."""
    s = F.lower(filled(c.cast("string")))
    return F.when(s.isin(_TRUE), True).when(s.isin(_FALSE), False)


def lax_int(c: Column) -> Column:
    """A whole number, also from a text or a number without a fraction; else null."""
    s = filled(c.cast("string"))
    return F.when(s.rlike(r"^[+-]?\d+(?:\.0*)?$"), F.regexp_replace(s, r"\..*$", "").try_cast("int"))


def lax_time(c: Column) -> Column:
    return job_date(c.cast("string"))


def present(name: str) -> tuple[str, Column]:
    return f"{name}: missing or blank", filled(F.col(name).cast("string")).isNotNull()


def optional(name: str, ok, what: str) -> tuple[str, Column]:
    return f"{name}: {what}", F.col(name).isNull() | F.coalesce(ok, F.lit(False))


def required(name: str, ok, what: str) -> tuple[str, Column]:
    return f"{name}: {what}", F.coalesce(ok, F.lit(False))


def constraints(kind: str) -> list[tuple[str, Column]]:
    """(message, condition that holds for a good row) of each kind of row."""
    c = F.col
    url = lambda n: required(n, http_url(c(n)), "not a URL")
    maybe_url = lambda n: optional(n, http_url(c(n)), "not a URL")
    at = lambda n: required(n, lax_time(c(n)).isNotNull(), "not a time")
    count = lambda n: optional(n, lax_int(c(n)) >= 0, "not a whole number of 0 or more")
    version = optional("schemaVersion", c("schemaVersion").rlike(r"^\d+\.\d+$"), "not a version")
    literal = lambda v: optional("recordType", c("recordType") == v, f"not {v}")
    source = [present("source_name"), url("source_url")]
    return {
        "startup": [version, literal("STARTUP"), *source, present("entityName"), count("employeeCount"), at("collectedAt")],
        "product": [version, literal("PRODUCT"), *source, present("startupName"), optional("pricingModel", c("pricingModel").isin(PRICING_MODELS), "not a price model"), at("collectedAt")],
        "paper": [version, literal("RESEARCH_PAPER"), present("title"), url("paper_url"), maybe_url("github_url"), count("github_stars"), at("published_date"), at("collectedAt")],
        "news": [version, literal("NEWS"), *source, present("title"), url("url"), at("published_date"), at("collectedAt")],
        "job": [version, literal("JOB"), present("company"), at("date"), required("is_remote", lax_bool(c("is_remote")).isNotNull(), "not a boolean"), at("collectedAt")],
        "mapping": [
            present("raw_name"), present("normalized_name"), present("canonical_name"), present("canonical_id"),
            required("match_method", c("match_method").isin(METHODS), "not a method"),
            required("confidence", c("confidence").cast("string").try_cast("double").between(0, 1), "not in 0 to 1"),
            maybe_url("source_url"), at("timestamp"),
        ],
    }[kind]


def checked(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """df with `errors`: the messages of the constraints that a row breaks, in order. Columns that rules name but df lacks are null."""
    return df.withColumn("errors", F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(message)) for message, ok in rules])))


def validate(df: DataFrame, kind: str) -> DataFrame:
    missing = {n: F.lit(None).cast("string") for n in _COLUMNS[kind] if n not in df.columns}
    return checked(df.withColumns(missing) if missing else df, constraints(kind))


def split(df: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rows with errors)."""
    seen = validate(df, kind)
    return seen.filter(F.size("errors") == 0).drop("errors"), seen.filter(F.size("errors") > 0)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table, n for each table."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()])


def quality_report(tables: dict[str, DataFrame], key: dict[str, str] | None = None) -> DataFrame:
    """By table: rows, valid, invalid (by `errors`, if it has that), missing_url, duplicates (rows beyond the first of a key)."""
    out = []
    for name, df in tables.items():
        bad = F.count_if(F.size("errors") > 0) if "errors" in df.columns else F.lit(0).cast("long")
        blank = F.count_if(F.coalesce("source_url", F.lit("")) == "") if "source_url" in df.columns else F.count("*")
        k = (key or {}).get(name)
        unique = F.count_distinct(k) + F.max(F.when(F.col(k).isNull(), 1).otherwise(0)) if k else F.count("*")
        row = df.agg(F.count("*").alias("total"), bad.alias("invalid"), blank.alias("missing_url"), unique.alias("unique"))
        out.append(row.select(F.lit(name).alias("table_name"), "total", (F.col("total") - F.col("invalid")).alias("valid"), "invalid", "missing_url", (F.col("total") - F.coalesce("unique", F.lit(0))).cast("long").alias("duplicates")))
    return reduce(DataFrame.unionByName, out)


def verdict(report: DataFrame) -> DataFrame:
    """PASS, or FAIL if any table has invalid rows, with the sums."""
    sums = report.agg(F.sum("total").alias("total"), F.sum("invalid").alias("invalid"), F.sum("missing_url").alias("missing_url"), F.sum("duplicates").alias("duplicates"))
    return sums.withColumn("status", F.when(F.coalesce("invalid", F.lit(0)) > 0, "FAIL").otherwise("PASS"))


def repository_coverage(papers: DataFrame) -> DataFrame:
    """total, with_url (not blank), with_stars (over 0), starred (known)."""
    return papers.agg(F.count("*").alias("total"), F.count_if(filled(F.col("github_url")).isNotNull()).alias("with_url"), F.count_if(F.col("github_stars") > 0).alias("with_stars"), F.count("github_stars").alias("starred"))


def status_counts(df: DataFrame, column: str = "freshness_status") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def audited(startups: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored startups (entity_name, employee_count, source_url) and products (startup_name, pricing_model, source_url)
    classified anew by what is stored, a FREE price without a statement taken back, and the nine counts of that."""
    from tessera.functions.classify import product_category, startup_category

    none = F.lit(None).cast("string")
    s = startups.withColumn("q", startup_category(F.col("entity_name"), none, none, none)).select("*", "q.*").drop("q")
    name = F.element_at(F.split(F.coalesce("source_url", F.lit("")), "/"), -1)
    was_free = F.coalesce(F.col("pricing_model") == "FREE", F.lit(False))
    p = products.withColumns({"q": product_category(name, none), "was_free": was_free}).select("*", "q.*").drop("q")
    p = p.withColumn("pricing_model", F.when(~F.col("was_free"), F.col("pricing_model")))
    a = s.agg(F.count("*").alias("startups_total"), F.count_if("is_qualified").alias("startups_company"), F.count_if(~F.col("is_qualified")).alias("startups_uncertain"), F.count("employee_count").alias("startups_employee_count_authoritative"))
    b = p.agg(F.count("*").alias("products_total"), F.count("pricing_model").alias("products_explicit_pricing"), F.count_if("was_free").alias("products_license_only_pricing_fixed"), F.count_if("is_qualified").alias("products_qualified"), F.count_if(~F.col("is_qualified")).alias("products_educational_unqualified"))
    one = F.lit(1)
    return s, p.drop("was_free"), a.withColumn("_k", one).join(b.withColumn("_k", one), "_k").drop("_k")
