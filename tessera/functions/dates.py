"""Dates of postings and articles, and their freshness. All times are UTC; a time without zone is taken as UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.basic import filled

_ISO = r"^\s*\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)?)?\s*(?:Z|[+-]\d{2}:?\d{2}(?::?\d{2})?)?\s*$"
_MAIL = r"^\s*(?:[A-Za-z]{3,9},?\s+)?(\d{1,2})\s+([A-Za-z]{3})\s+(\d{4})\s+(\d{1,2}:\d{2})(:\d{2})?(?:\s+([A-Z]{1,4}|[+-]\d{4}))?\s*$"
_ZONES = {"UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700"}
FRESH_HOURS = 24.0


def iso(c: Column) -> Column:
    """An ISO 8601 date or time; else null."""
    return F.when(c.rlike(_ISO), F.trim(F.replace(c, F.lit(","), F.lit("."))).try_cast("timestamp"))


def rfc822(c: Column) -> Column:
    """A date of a mail header; the name of the weekday is not read; without a zone, or with an unknown one, it is UTC."""
    part = lambda i: F.regexp_extract(c, _MAIL, i)
    zones = F.create_map(*[F.lit(x) for pair in _ZONES.items() for x in pair])
    offset = F.coalesce(F.try_element_at(zones, part(6)), F.regexp_extract(c, r"([+-]\d{4})\s*$", 1))
    text = F.concat(part(1), F.lit(" "), F.initcap(part(2)), F.lit(" "), part(3), F.lit(" "), part(4), F.rpad(part(5), 3, ":00"), F.lit(" "), F.rpad(offset, 5, "+0000"))
    return F.try_to_timestamp(text, F.lit("d MMM yyyy H:mm:ss Z"))


def epoch(c: Column) -> Column:
    """A string of digits (with a fraction, from a number) as seconds since 1970; else null."""
    return F.when(c.rlike(r"^\s*\d{1,11}(?:\.\d+)?\s*$"), F.timestamp_micros((F.trim(c).try_cast("decimal(18,6)") * 1_000_000).cast("long")))


def job_date(c: Column) -> Column:
    """Seconds since 1970, an ISO date, or a mail date; else null."""
    return F.coalesce(epoch(c), iso(c), rfc822(c))


def article_date(c: Column) -> Column:
    """A mail date or an ISO date; else null."""
    return F.coalesce(rfc822(c), iso(c))


def or_now(date: Column, now: Column) -> Column:
    """The date, or the time of the run."""
    return F.coalesce(date, now)


def freshness(date: Column, raw: Column | None, ref: Column, hours: float = FRESH_HOURS) -> Column:
    """fresh, stale, missing_date or invalid_date. A date of exactly that age, or of the future, is fresh.

    raw: the text that the date was read from; a text without a date is invalid, no text is missing.
    """
    limit = ref - F.make_dt_interval(secs=F.lit(hours * 3600).cast("decimal(18,6)"))
    unread = F.when(filled(raw).isNotNull(), F.lit("invalid_date")).otherwise(F.lit("missing_date")) if raw is not None else F.lit("missing_date")
    return F.when(date.isNull(), unread).when(date < limit, "stale").otherwise("fresh")


def effective_date(date: Column, status: Column, collected: Column) -> Column:
    """The date if fresh, else one hour before it was collected: old rows are re-dated, not dropped."""
    return F.when(status == "fresh", date).otherwise(collected - F.expr("interval 1 hour"))
