"""Parsers of landed payloads: one row of (payload, and what else it has) becomes typed rows, in the payload's order.

JSON is read as VARIANT, as fields change type from row to row (a date is a number or a text, a flag a boolean or a word);
XML by schema. A payload that cannot be read gives no rows. Dates that cannot be read stay null: `or_now` fills them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import classify, dates, text, url
from tessera.functions.basic import collapse, filled, first_filled, strip_tags

JOB_COLUMNS = ["ord", "company", "title", "url", "date", "date_raw", "is_remote", "description", "role_family", "source_name", "source_url"]
NEWS_COLUMNS = ["ord", "title", "url", "published_date", "date_raw", "full_text", "source_name", "source_url"]


def items(payloads: DataFrame, path: str | None, payload: str = "payload") -> DataFrame:
    """ord and item (a VARIANT) of each member of the array at a path of a JSON payload (null: the payload itself)."""
    doc = F.try_parse_json(F.col(payload))
    found = F.try_variant_get(doc, f"$.{path}" if path else "$", "array<variant>")
    return _ordered(payloads, F.posexplode(found).alias("ord", "item")).select("ord", "item")


def _ordered(payloads: DataFrame, *columns) -> DataFrame:
    """Columns with `ord` as the place in a payload; of payloads with a path, the path and the place in it."""
    if "path" not in payloads.columns:
        return payloads.select(*columns)
    return payloads.select(F.col("path").alias("_path"), *columns).withColumn("ord", F.struct(F.col("_path").alias("path"), F.col("ord").alias("at"))).drop("_path")


def unreadable(payload: Column) -> Column:
    """Whether a payload is neither JSON nor well-formed XML."""
    xml = F.from_xml(payload, F.lit("_corrupt_record string, any string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    blank = F.coalesce(F.trim(payload), F.lit("")) == ""
    return blank | F.when(F.ltrim(payload).startswith("<"), xml["_corrupt_record"].isNotNull()).otherwise(F.try_parse_json(payload).isNull())


def field(name: str, kind: str = "string") -> Column:
    """A field of the item, null if it is missing or of another kind."""
    return F.try_variant_get(F.col("item"), f"$.{name}", kind)


def _jobs(rows: DataFrame, company: Column, title: Column, link: Column, date: Column, description: Column, name: str, home: str, remote: Column | None = None) -> DataFrame:
    flat = rows.select("ord", company.alias("company"), title.alias("title"), link.alias("url"), date.alias("date_raw"), description.alias("description"), *([remote.alias("flag"), field("location").alias("place")] if remote is not None else []))
    flat = flat.filter(F.col("company").isNotNull() & F.col("title").isNotNull() & F.col("url").isNotNull())
    is_remote = classify.remote(F.col("flag"), F.col("place"), F.col("title"), F.col("description")) if remote is not None else F.lit(True)
    role = classify.role_family(F.col("title"), F.col("description")) if remote is not None else F.lit(None).cast("string")
    return flat.withColumns({"date": dates.job_date(F.col("date_raw")), "is_remote": is_remote, "role_family": role, "source_name": F.lit(name), "source_url": F.lit(home)}).select(*JOB_COLUMNS)


def jobs_generic(payloads: DataFrame, name: str = "Arbeitnow Tech Jobs", home: str = "https://www.arbeitnow.com/api/job-board-api", path: str = "data") -> DataFrame:
    """Postings of a board's API, whose names for a field vary; remote flag and role family are derived."""
    pick = lambda *names: first_filled(*[field(n) for n in names])
    about = filled(collapse(strip_tags(pick("description", "text"))))
    rows = _jobs(items(payloads, path), pick("company_name", "company", "company_title"), pick("title", "position", "role"), pick("url", "link", "job_url"), pick("created_at", "date", "posted_at", "published_at"), about, name, home, remote=field("remote"))
    return rows.filter(classify.qualified_job(F.col("company"), F.col("title"), F.col("url")))


def jobs_remoteok(payloads: DataFrame) -> DataFrame:
    """Members of a top-level array that have a position; the first, a notice, has none."""
    pick = lambda *n: first_filled(*[field(x) for x in n])
    rows = items(payloads, None).filter(pick("position").isNotNull())
    out = _jobs(rows, F.coalesce(pick("company"), F.lit("Unknown Company")), pick("position"), pick("url", "apply_url"), pick("date", "epoch"), pick("description"), "RemoteOK", "https://remoteok.com/api")
    return out.filter(classify.qualified_job(F.col("company"), F.col("title"), F.col("url")))


def jobs_jobicy(payloads: DataFrame) -> DataFrame:
    pick = lambda *n: first_filled(*[field(x) for x in n])
    out = _jobs(items(payloads, "jobs"), pick("companyName"), pick("jobTitle"), pick("url"), pick("pubDate"), pick("jobDescription", "jobExcerpt"), "Jobicy", "https://jobicy.com/api/v2/remote-jobs")
    return out.filter(classify.qualified_job(F.col("company"), F.col("title"), F.col("url")))


def jobs_himalayas(payloads: DataFrame) -> DataFrame:
    """Postings with a date in seconds; the link falls back to one made of the slug. Their URLs are not qualified."""
    pick = lambda *n: first_filled(*[field(x) for x in n])
    link = F.coalesce(pick("applicationLink", "excerptUrl"), F.concat(F.lit("https://himalayas.app/jobs/"), F.coalesce(field("slug"), F.lit(""))))
    return _jobs(items(payloads, "jobs"), pick("companyName"), pick("title"), link, pick("pubDate"), pick("excerpt", "description", "title"), "Himalayas", "https://himalayas.app/jobs/api")


_ITEM = "array<struct<title: array<string>, link: array<string>, pubDate: array<string>, description: array<string>, encoded: array<string>>>"
_ENTRY = "array<struct<id: array<string>, title: array<string>, link: array<struct<_rel: string, _href: string>>, published: array<string>, updated: array<string>, summary: array<string>, content: array<string>, author: array<struct<name: string>>>>"


def _local(payload: Column) -> Column:
    """XML whose elements go by their local names: any prefix of a feed's namespace, and any `...:encoded` child, is read."""
    return F.regexp_replace(payload, r"(</?)[A-Za-z_][\w.\-]*:([A-Za-z_])", "$1$2")


def _first(c: Column) -> Column:
    """The text of the first of the elements of one name."""
    return F.get(c, F.lit(0))


def _rss(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """feed_title, feed_link, ord, and the items' title, link, pubDate, description, encoded."""
    doc = F.from_xml(_local(F.col(payload)), F.lit(f"channel struct<title: array<string>, link: array<string>, item: {_ITEM}>"))
    rows = payloads.withColumn("d", doc)
    flat = _ordered(rows, F.col("d.channel.title").alias("feed_title"), F.col("d.channel.link").alias("feed_link"), F.posexplode("d.channel.item").alias("ord", "i"))
    # The channel's own link is the one with a text: links of other namespaces have attributes only.
    home = F.get(F.filter("feed_link", lambda x: filled(x).isNotNull()), F.lit(0))
    return flat.select(_first(F.col("feed_title")).alias("feed_title"), home.alias("feed_link"), "ord", *[_first(F.col(f"i.{n}")).alias(n) for n in ("title", "pubDate", "description", "encoded")], F.get(F.filter("i.link", lambda x: filled(x).isNotNull()), F.lit(0)).alias("link"))


def _atom(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """feed_title, ord, and the entries' id, title, published, updated, summary, content, link, author."""
    doc = F.from_xml(_local(F.col(payload)), F.lit(f"title array<string>, entry {_ENTRY}"))
    rows = payloads.withColumn("d", doc)
    flat = _ordered(rows, F.col("d.title").alias("feed_title"), F.posexplode("d.entry").alias("ord", "e"))
    return flat.select(_first(F.col("feed_title")).alias("feed_title"), "ord", *[_first(F.col(f"e.{n}")).alias(n) for n in ("id", "title", "published", "updated", "summary", "content")], "e.link", "e.author")


def jobs_wwr(payloads: DataFrame) -> DataFrame:
    """A feed whose titles are `Company: Role`."""
    rows = _rss(payloads).withColumns({"title": filled(F.col("title")), "link": filled(F.col("link"))}).filter("title is not null and link is not null")
    parted = F.col("title").contains(":")
    company = F.when(parted, F.trim(F.substring_index("title", ":", 1))).otherwise(F.lit("We Work Remotely Company"))
    role = F.when(parted, F.trim(F.regexp_replace("title", r"(?s)^[^:]*:", ""))).otherwise(F.col("title"))
    out = rows.select("ord", company.alias("company"), role.alias("title"), F.col("link").alias("url"), filled(F.col("pubDate")).alias("date_raw"), filled(F.col("description")).alias("description"))
    out = out.withColumns({"date": dates.job_date(F.col("date_raw")), "is_remote": F.lit(True), "role_family": F.lit(None).cast("string"), "source_name": F.lit("We Work Remotely"), "source_url": F.lit("https://weworkremotely.com/remote-jobs.rss")})
    return out.select(*JOB_COLUMNS).filter(classify.qualified_job(F.col("company"), F.col("title"), F.col("url")))


def _news(rows: DataFrame, name: Column, home: Column) -> DataFrame:
    out = rows.withColumns({"published_date": dates.article_date(F.col("date_raw")), "source_name": name, "source_url": home})
    return out.select(*NEWS_COLUMNS).filter(classify.qualified_article(F.col("title"), F.col("url")))


def news_rss(payloads: DataFrame, name: str | None = None, home: str | None = None) -> DataFrame:
    """Articles of an RSS 2.0 feed; the text is that of content:encoded (or another `encoded` child), else of the description."""
    rows = _rss(payloads).select("ord", filled(F.col("title")).alias("title"), filled(F.col("link")).alias("url"), filled(F.col("pubDate")).alias("date_raw"), text.html_text(F.coalesce("encoded", "description")).alias("full_text"), "feed_title", "feed_link")
    return _news(rows, F.lit(name) if name else F.coalesce(filled(F.col("feed_title")), F.lit("RSS Feed")), F.lit(home) if home else F.coalesce(filled(F.col("feed_link")), F.lit("https://techcrunch.com/")))


def news_atom(payloads: DataFrame, name: str | None = None, home: str | None = None) -> DataFrame:
    """Entries of an Atom feed: the alternate link if there is one, the date of publication, else of the last change."""
    alternate = F.filter("link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    link = F.coalesce(F.try_element_at(alternate, F.lit(-1))["_href"], F.try_element_at(F.col("link"), F.lit(1))["_href"])
    rows = _atom(payloads).select("ord", filled(F.col("title")).alias("title"), filled(link).alias("url"), first_filled(F.col("published"), F.col("updated")).alias("date_raw"), text.html_text(F.coalesce("content", "summary")).alias("full_text"), "feed_title")
    return _news(rows, F.lit(name) if name else F.coalesce(filled(F.col("feed_title")), F.lit("Atom Feed")), F.lit(home or "https://techcrunch.com/"))


def news_hackernews(payloads: DataFrame) -> DataFrame:
    """Stories; one without a link is its own page, one without readable text has its title as text."""
    title = first_filled(field("title"))
    link = F.coalesce(first_filled(field("url")), F.concat(F.lit("https://news.ycombinator.com/item?id="), field("objectID")))
    body = F.coalesce(text.html_text(F.coalesce(first_filled(field("story_text")), title)), title)
    rows = items(payloads, "hits").select("ord", title.alias("title"), link.alias("url"), first_filled(field("created_at")).alias("date_raw"), body.alias("full_text"))
    return _news(rows, F.lit("Hacker News AI"), F.lit("https://news.ycombinator.com"))


def news_devto(payloads: DataFrame) -> DataFrame:
    title = first_filled(field("title"))
    body = F.coalesce(text.html_text(F.coalesce(first_filled(field("description")), title)), title)
    rows = items(payloads, None).select("ord", title.alias("title"), first_filled(field("url"), field("canonical_url")).alias("url"), first_filled(field("published_at"), field("created_at")).alias("date_raw"), body.alias("full_text"))
    return _news(rows, F.lit("DEV.to AI"), F.lit("https://dev.to"))


def news_arxiv(payloads: DataFrame) -> DataFrame:
    """Papers as news: the abstract, its lines joined, is the text."""
    flat = lambda c: filled(F.replace(c, F.lit("\n"), F.lit(" ")))
    rows = _atom(payloads).select("ord", flat(F.col("title")).alias("title"), filled(F.col("id")).alias("url"), filled(F.col("published")).alias("date_raw"), flat(F.col("summary")).alias("full_text"))
    return _news(rows, F.lit("arXiv AI News"), F.lit("http://export.arxiv.org/api/query"))


def full_text(articles: DataFrame, pages: DataFrame, least: int = 50, closed_references: bool = False) -> DataFrame:
    """Articles whose text is missing or under `least` characters get that of their page (columns url, html), if it has one.
    closed_references: see `text.with_html_text`."""
    short = F.coalesce(F.length("full_text"), F.lit(0)) < least
    wanted = articles.filter(short).select("url").distinct()
    read = text.with_html_text(pages.join(wanted, "url", "left_semi").dropDuplicates(["url"]), F.col("html"), "page_text", closed_references).select("url", "page_text")
    return articles.join(read, "url", "left").withColumn("full_text", F.when(short, F.coalesce("page_text", "full_text")).otherwise(F.col("full_text"))).select(*articles.columns)


def papers(payloads: DataFrame) -> DataFrame:
    """Papers of an Atom answer: title and link are required; the link loses its version; a repository is sought in the abstract."""
    rows = _atom(payloads).select(
        "ord",
        filled(collapse(F.col("title"))).alias("title"),
        F.filter(F.transform(F.coalesce("author", F.array().cast("array<struct<name: string>>")), lambda a: collapse(a["name"])), lambda a: F.coalesce(a, F.lit("")) != "").alias("authors"),
        url.paper_url(F.coalesce("id", F.lit(""))).alias("paper_url"),
        F.coalesce(collapse(F.col("summary")), F.lit("")).alias("abstract"),
        dates.iso(filled(F.col("published"))).alias("published_date"),
    )
    return rows.filter("title is not null and paper_url <> ''").withColumns({"github_url": url.repository_in(F.col("abstract")), "source_name": F.lit("arXiv"), "source_url": F.lit("http://export.arxiv.org/api/query")})


def with_stars(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """github_url and github_stars of rows by a table of answers (url, status, stars): 404 takes the link away, any other
    failure leaves it without stars, success gives stars of zero or more."""
    known = stats.select(F.col("url").alias("github_url"), "status", F.col("stars").alias("found")).dropDuplicates(["github_url"])
    joined = rows.join(known, "github_url", "left")
    return joined.withColumns({"github_stars": F.when(F.col("status") == 200, F.greatest(F.coalesce("found", F.lit(0)), F.lit(0)).cast("int")), "github_url": F.when(F.coalesce("status", F.lit(0)) != 404, F.col("github_url"))}).drop("status", "found")


def startups(payloads: DataFrame, path: str | None = "items") -> DataFrame:
    """Organisations with a name or login and an http link, with head count and category."""
    pick = lambda *n: first_filled(*[field(x) for x in n])
    link = F.coalesce(pick("html_url"), F.concat(F.lit("https://github.com/"), pick("login")))
    rows = items(payloads, path).select("ord", pick("name", "login").alias("entity_name"), link.alias("source_url"), F.nullif(field("description"), F.lit("")).alias("description"), field("blog").alias("blog"), field("email").alias("email"))
    rows = rows.filter("entity_name is not null").filter(F.col("source_url").startswith("http"))
    q = classify.startup_category(F.col("entity_name"), F.col("description"), F.col("blog"), F.col("email"))
    out = rows.withColumns({"employee_count": text.employee_count(F.col("description")), "q": q, "source_name": F.lit("GitHub Organizations")})
    return out.select("ord", "entity_name", "source_url", "source_name", "employee_count", "description", "q.is_qualified", F.col("q.category").alias("qualification_category"), F.col("q.reasons").alias("qualification_reasons"))


def products(payloads: DataFrame, path: str | None = "items") -> DataFrame:
    """Repositories with a name, an owner and an http link, with licence, price and category."""
    pick = lambda *n: first_filled(*[field(x) for x in n])
    rows = items(payloads, path).select(
        "ord",
        pick("name").alias("product_name"),
        pick("owner.login", "owner.name").alias("startup_name"),
        pick("html_url").alias("source_url"),
        F.nullif(field("description"), F.lit("")).alias("description"),
        field("topics", "array<string>").alias("topics"),
        F.coalesce(F.nullif(field("license.name"), F.lit("")), F.nullif(F.lower(field("license.key")), F.lit(""))).alias("license"),
    )
    rows = rows.filter("product_name is not null and startup_name is not null").filter(F.col("source_url").startswith("http"))
    out = rows.withColumns({"p": text.pricing(F.col("description")), "q": classify.product_category(F.col("product_name"), F.col("description"), F.col("topics")), "source_name": F.lit("GitHub Products")})
    return out.select("ord", "product_name", "startup_name", "source_url", "source_name", F.col("p.model").alias("pricing_model"), "description", "license", "q.is_qualified", F.col("q.category").alias("qualification_category"), F.col("q.reasons").alias("qualification_reasons"), F.array("p.reason").alias("pricing_reasons"))


#: Parsers by vertical and source key.
PARSERS = {
    "jobs": {"arbeitnow": jobs_generic, "remoteok": jobs_remoteok, "jobicy": jobs_jobicy, "weworkremotely": jobs_wwr, "himalayas": jobs_himalayas},
    "news": {
        "techcrunch": lambda p: news_rss(p, "TechCrunch AI", "https://techcrunch.com/category/artificial-intelligence/feed/"),
        "venturebeat": lambda p: news_rss(p, "VentureBeat AI", "https://venturebeat.com/category/ai/feed/"),
        "mit_tech_review": lambda p: news_rss(p, "MIT Technology Review", "https://www.technologyreview.com/feed/"),
        "kdnuggets": lambda p: news_rss(p, "KDnuggets", "https://www.kdnuggets.com/feed"),
        "huggingface": lambda p: news_rss(p, "Hugging Face Blog", "https://huggingface.co/blog/feed.xml"),
        "hackernews": news_hackernews,
        "devto": news_devto,
        "arxiv": news_arxiv,
    },
    "research": {"arxiv": papers},
    "startups": {"github": startups},
    "products": {"github": products},
}


def enabled(vertical: str, keys: str | list[str] | None) -> dict:
    """The parsers of a comma list of source keys, in its order; unknown keys are left out; none left: all of the vertical."""
    known = PARSERS[vertical]
    asked = [k.strip().lower() for k in (keys.split(",") if isinstance(keys, str) else keys or [])]
    return {k: known[k] for k in dict.fromkeys(asked) if k in known} or dict(known)
