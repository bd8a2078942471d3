"""Qualifiers and classifiers of rows, and of crawl responses, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.basic import filled, has_any, has_word, quoted
from tessera.functions.url import own_domain

# Word lists of the classifiers. Order of families is order of precedence.
ROLE_FAMILIES = {
    "Engineering": [
        "software engineer", "software developer", "backend", "frontend", "full stack", "fullstack", "architect", "programmer",
        "web developer", "python developer", "golang engineer", "java engineer", "c++ developer", "ios developer", "android engineer",
    ],
    "Data & AI": [
        "machine learning", "ml engineer", "data scientist", "ai engineer", "artificial intelligence", "deep learning", "nlp",
        "computer vision", "data engineer", "mlops", "data analyst", "research scientist",
    ],
    "Infrastructure": ["devops", "site reliability", "sre", "cloud engineer", "infrastructure", "sysadmin", "system administrator", "platform engineer", "kubernetes"],
    "Security": ["security engineer", "cybersecurity", "infosec", "penetration tester", "security analyst"],
    "Quality Assurance": ["qa engineer", "quality assurance", "test engineer", "sdet", "qa"],
    "Product & Design": ["product manager", "project manager", "scrum master", "ui/ux", "product designer", "ux designer"],
}
FOUNDATION = ["non-profit", "nonprofit", "association", "consortium"]
COMPANY = [
    "inc", "corp", "corporation", "ltd", "limited", "llc", "gmbh", "company", "startup", "ai company", "tech company", "software company",
    "official github for", "commercial", "enterprise", "platform provider", "solution provider", "building",
]
COMMUNITY = ["open source community", "collection of algorithms", "algorithms", "curated list", "community-driven", "open-source resource"]
EDUCATIONAL = ["university", "college", "school", "research lab", "academic", "institute of technology"]
TUTORIAL = ["interview guide", "study guide", "learning resource", "awesome list", "roadmap", "curated list of", "interview questions", "cheat sheet", "cheatsheet"]
PRODUCT = ["application", "tool", "agent", "webui", "platform", "framework", "library", "system", "engine", "sdk", "cli", "saas", "product", "service", "copilot", "assistant"]
REMOTE_PLACE = ["remote", "anywhere", "work from home", "wfh"]
ONSITE_TEXT = ["onsite only", "in-office only", "relocation required"]
REMOTE_TEXT = ["remote", "work from anywhere", "work from home", "wfh", "telecommute"]
RETRYABLE = [429, 500, 502, 503, 504]
PERMANENT = [400, 401, 403, 404, 405, 406, 410, 422]


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def qualified_job(company: Column, title: Column, url: Column) -> Column:
    """Whether a posting has a company, a title, and a URL that begins with http."""
    return filled(company).isNotNull() & filled(title).isNotNull() & F.coalesce(filled(url).startswith("http"), F.lit(False))


def qualified_article(title: Column, url: Column) -> Column:
    return filled(title).isNotNull() & filled(url).isNotNull()


def role_family(title: Column, description: Column | None = None) -> Column:
    """The first family with a keyword anywhere in title or description, in lower case; else null."""
    text = F.lower(F.concat_ws(" ", _text(title), _text(description) if description is not None else F.lit("")))
    out = F.lit(None).cast("string")
    for name, words in reversed(ROLE_FAMILIES.items()):
        out = F.when(has_any(text, words), name).otherwise(out)
    return out


def role_family_or(title: Column, description: Column, answer: Column) -> Column:
    """The family by keywords, else a model's answer if that is one of the families."""
    return F.coalesce(role_family(title, description), F.when(answer.isin(list(ROLE_FAMILIES)), answer))


def remote(flag: Column, location: Column, title: Column, description: Column) -> Column:
    """Whether a posting is remote: by its flag (a string form of it), its place, then what its text denies or says."""
    f, text = F.lower(_text(flag)), F.lower(F.concat_ws(" ", _text(title), _text(description)))
    return (
        F.when(f.isin("true", "1", "yes"), True)
        .when(f.isin("false", "0", "no", "onsite"), False)
        .when(has_any(F.lower(_text(location)), REMOTE_PLACE), True)
        .when(has_any(text, ONSITE_TEXT), False)
        .otherwise(has_any(text, REMOTE_TEXT))
    )


def startup_category(name: Column, description: Column, blog: Column, email: Column) -> Column:
    """struct<is_qualified, category, reasons>; keyword reasons in alphabetical order."""
    d, n = F.lower(F.trim(_text(description))), F.lower(F.trim(_text(name)))
    b, e = F.lower(F.trim(_text(blog))), F.lower(F.trim(_text(email)))
    educational = has_any(d, EDUCATIONAL) | b.contains(".edu") | e.contains(".edu")
    foundation = has_any(d, FOUNDATION) | d.rlike(r"(?U)\bfoundation\b(?!\s*models?)")
    community = has_any(d, COMMUNITY)
    said = [F.when(has_word(d, w) | has_word(n, w), F.lit(f"Contains company keyword '{w}'")) for w in sorted(COMPANY)]
    domain = F.when((b != "") & own_domain(b), F.concat(F.lit("Has official external domain '"), b, F.lit("'")))
    company = F.array_compact(F.array(*said, domain))
    category = F.when(educational, "EDUCATIONAL").when(foundation, "FOUNDATION_NONPROFIT").when(community, "OPEN_SOURCE_COMMUNITY").when(F.size(company) > 0, "STARTUP_COMPANY").otherwise("UNKNOWN")
    reasons = (
        F.when(educational, F.array(F.lit("Matches educational or university patterns")))
        .when(foundation, F.array(F.lit("Matches foundation/nonprofit keywords in description")))
        .when(community, F.array(F.lit("Matches open-source community/resource keywords")))
        .when(F.size(company) > 0, company)
        .otherwise(F.array(F.lit("Insufficient evidence to reliably establish startup/company status")))
    )
    return F.struct((category == "STARTUP_COMPANY").alias("is_qualified"), category.alias("category"), reasons.alias("reasons"))


def product_category(name: Column, description: Column, topics: Column | None = None) -> Column:
    """struct<is_qualified, category, reasons>; the reason names the first three keywords in alphabetical order."""
    parts = [F.lower(F.trim(_text(name))), F.lower(F.trim(_text(description)))]
    text = F.concat_ws(" ", *parts, F.lower(F.array_join(F.coalesce(topics, F.array().cast("array<string>")), " ")) if topics is not None else F.lit(""))
    # No keyword overlaps another between word borders, so one scan finds them all; what is used more than once is bound first.
    scan = lambda t: F.struct(has_any(t, TUTORIAL).alias("tutorial"), _words(t, PRODUCT).alias("found"))
    return F.transform(F.transform(F.array(text), scan), lambda x: _product(x["tutorial"], x["found"]))[0]


def _words(text: Column, words: list[str]) -> Column:
    """Which of the words, none of which lies within another between word borders, occur between such, in alphabetical order."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?U)\b({'|'.join(quoted(w) for w in words)})\b"), F.lit(1))))


def _product(tutorial: Column, found: Column) -> Column:
    category = F.when(tutorial, "EDUCATIONAL_TUTORIAL").when(F.array_contains(found, "saas"), "SAAS_PRODUCT").when(F.size(found) > 0, "APPLICATION_TOOL").otherwise("LIBRARY_FRAMEWORK")
    reason = (
        F.when(tutorial, "Matches educational resource / interview guide pattern")
        .when(F.size(found) > 0, F.concat(F.lit("Contains product/tool indicators: "), F.array_join(F.slice(found, 1, 3), ", ")))
        .otherwise("General software repository with developer/product utility")
    )
    return F.struct((~tutorial).alias("is_qualified"), category.alias("category"), F.array(reason).alias("reasons"))


def retryable(status: Column) -> Column:
    """Whether a response is worth another try: no status, or one of the passing failures."""
    return status.isNull() | F.coalesce(status.isin(RETRYABLE), F.lit(False))


def permanent(status: Column) -> Column:
    return F.coalesce(status.isin(PERMANENT), F.lit(False))


def backoff(attempt: Column, base: float = 2.0, most: float = 60.0, jitter: bool = False) -> Column:
    """Seconds to wait after an attempt, to three places; with jitter, any share of them."""
    delay = F.least(F.pow(F.lit(base), attempt), F.lit(most))
    return F.round(delay * F.rand() if jitter else delay, 3)
