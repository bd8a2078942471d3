"""URLs: canonical form, fingerprint, repositories in text, hosts; hashing and redaction of secrets."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.basic import strip

#: scheme, authority, path, query of a URL; every string matches.
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"

# Paths of the code host that are no repositories, hosts that are no domain of one's own.
NO_REPOSITORY = ["sponsors", "settings", "features", "topics", "collections", "trending", "events", "marketplace", "pricing", "orgs", "users", "about"]
BLOG_HOSTS = ["github.io", "blogspot.com", "wordpress.com", "medium.com"]


def _unquote(c: Column) -> Column:
    """Decodes + and %XX; a malformed escape leaves its part as it stands."""
    return F.coalesce(F.try_url_decode(c), F.replace(c, F.lit("+"), F.lit(" ")))


def _quote(c: Column) -> Column:
    """Encodes all but letters, digits and _ . - ~ ; a blank is +."""
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def normalize_url(url: Column) -> Column:
    """Lower-case scheme and authority, no fragment, no parameters of the last segment, no slash at the end (but a lone
    one), query sorted by key; values of one key keep their order, blank values stay. Idempotent; null stays null."""
    part = lambda i: F.regexp_extract(url, _PARTS, i)
    path = F.regexp_replace(F.regexp_replace(part(3), r"(?s);[^/]*$", ""), r"/+$", "")
    pairs = F.filter(F.split(part(4), "&"), lambda x: x != "")
    keyed = F.transform(
        pairs,
        lambda x, i: F.struct(
            _unquote(F.substring_index(x, "=", 1)).alias("k"),
            i.alias("i"),
            _unquote(F.when(F.instr(x, "=") > 0, F.regexp_replace(x, r"(?s)^[^=]*=", "")).otherwise(F.lit(""))).alias("v"),
        ),
    )
    query = F.array_join(F.transform(F.array_sort(keyed), lambda p: F.concat(_quote(p["k"]), F.lit("="), _quote(p["v"]))), "&")
    return F.concat(
        F.when(part(1) != "", F.concat(F.lower(part(1)), F.lit(":"))).otherwise(F.lit("")),
        F.when(part(2) != "", F.concat(F.lit("//"), F.lower(part(2)))).otherwise(F.lit("")),
        F.when(path == "", F.lit("/")).otherwise(path),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
    )


def url_fingerprint(url: Column) -> Column:
    """SHA-256, in hex, of the canonical form."""
    return F.sha2(normalize_url(url), 256)


def http_url(url: Column) -> Column:
    """Whether a string is an absolute http(s) URL with a host."""
    return F.coalesce(url.rlike(r"^(?i:https?)://[^/?#\s]+"), F.lit(False))


def canonical_http(url: Column) -> Column:
    """A valid URL as a typed field stores it: host lower-cased, default port dropped, a bare host ends in a slash."""
    bare = F.regexp_replace(url, r"^((?i:http)://[^/?#]*):80(?=[/?#]|$)", "$1")
    bare = F.regexp_replace(bare, r"^((?i:https)://[^/?#]*):443(?=[/?#]|$)", "$1")
    head = F.regexp_extract(bare, r"(?s)^([^:]+://[^/?#]*)", 1)
    tail = F.regexp_replace(bare, r"(?s)^[^:]+://[^/?#]*", "")
    return F.when(http_url(url), F.concat(F.lower(head), F.when(tail.startswith("/"), tail).otherwise(F.concat(F.lit("/"), tail))))


def paper_url(url: Column) -> Column:
    """https, without the version; a bare identifier gets its prefix; blank stays empty."""
    secure = F.regexp_replace(strip(url), r"^http://", "https://")
    plain = F.regexp_replace(secure, r"v\d+$", "")
    return F.when(plain == "", F.lit("")).when(plain.startswith("https://"), plain).otherwise(F.concat(F.lit("https://arxiv.org/abs/"), plain))


def repository_in(text: Column) -> Column:
    """The first repository URL of the code host in a text, in canonical form; null without one."""
    found = F.regexp_extract_all(text, F.lit(r"(?i)(https?://github\.com/[a-zA-Z0-9\-_]+/[a-zA-Z0-9._\-]+)"), 1)
    owner = lambda u: F.regexp_extract(u, r"(?i)github\.com/([^/]+)/", 1)
    repo = lambda u: F.regexp_replace(F.regexp_replace(F.regexp_extract(u, r"(?i)github\.com/[^/]+/(.*)$", 1), r"[.,;:!)]+$", ""), r"\.git$", "")
    named = F.transform(found, lambda u: F.struct(owner(u).alias("owner"), repo(u).alias("repo")))
    real = F.filter(named, lambda x: (x["repo"] != "") & ~F.lower(x["owner"]).isin(NO_REPOSITORY) & ~F.lower(x["repo"]).isin(NO_REPOSITORY))
    first = F.try_element_at(real, F.lit(1))
    return F.when(first.isNotNull(), F.concat(F.lit("https://github.com/"), first["owner"], F.lit("/"), first["repo"]))


def host(url: Column) -> Column:
    """Lower-case host without user and port; a URL without scheme is read as https; empty if there is none."""
    whole = F.when(url.startswith("http"), url).otherwise(F.concat(F.lit("https://"), url))
    return F.lower(F.regexp_extract(F.regexp_extract(whole, r"(?s)^[^:]*://([^/?#]*)", 1), r"^(?:.*@)?([^:]*)", 1))


def own_domain(url: Column) -> Column:
    """Whether the host is not one of the blog hosts or below one."""
    h = host(url)
    blog = F.lit(False)
    for b in BLOG_HOSTS:
        blog = blog | (h == b) | h.endswith(f".{b}")
    return (h != "") & ~blog


def request_fingerprint(provider: Column, model: Column, system: Column, prompt: Column, schema: Column | None = None) -> Column:
    """SHA-256 of the parts of a model request, joined by colons; a null part is empty."""
    parts = [provider, model, system, prompt, F.lit(None).cast("string") if schema is None else schema]
    return F.sha2(F.concat_ws(":", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


# Patterns of secrets, in the order in which they are replaced.
SECRETS = [
    (r"-----BEGIN PRIVATE KEY-----[\s\S]*?-----END PRIVATE KEY-----", "[REDACTED_PRIVATE_KEY]"),
    (r'"private_key":\s*"[^"]+"', '"private_key": "[REDACTED]"'),
    (r'"client_id":\s*"[^"]+"', '"client_id": "[REDACTED]"'),
    (r'"client_secret":\s*"[^"]+"', '"client_secret": "[REDACTED]"'),
    (r'"private_key_id":\s*"[^"]+"', '"private_key_id": "[REDACTED]"'),
    (r'"refresh_token":\s*"[^"]+"', '"refresh_token": "[REDACTED]"'),
    (r'"access_token":\s*"[^"]+"', '"access_token": "[REDACTED]"'),
    (r"(?i)bearer\s+[a-zA-Z0-9_\-.]+", "Bearer [REDACTED]"),
    (r"(?i)authorization:\s*[^\s,]+", "Authorization: [REDACTED]"),
    (r"key=[a-zA-Z0-9_\-]+", "key=[REDACTED]"),
]


def redact(text: Column) -> Column:
    """A text without keys, tokens and secrets of credentials; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for pattern, new in SECRETS:
        out = F.regexp_replace(out, pattern, new)
    return out


def without_secrets(text: str) -> str:
    """`redact` of one text, as of an error's message."""
    for pattern, new in SECRETS:
        text = re.sub(pattern, new, text)
    return text


def redact_key(text: Column, key: str | None) -> Column:
    """A text without one known key."""
    return F.replace(text, F.lit(key), F.lit("[REDACTED_API_KEY]")) if key else text


# Class of a sink's error and what its message holds, in order of precedence: one of the texts as they are, one of
# the texts in any case, or the name of an API that is off (together with a text of API_OFF, before or after it).
API_OFF = ["disabled", "has not been used"]
SINK_ERRORS = [
    ("sheet_api_disabled", ["sheets.googleapis.com"], [], "Google Sheets API"),
    ("drive_api_disabled", ["drive.googleapis.com"], [], "Google Drive API"),
    ("credentials_not_found", ["No such file or directory"], ["file not found"], None),
    ("invalid_credentials", ["Invalid Google Service Account JSON", "JSONDecodeError"], [], None),
    ("authentication_failure", ["invalid_grant", "invalid_claim", "Signature verification failed", "GoogleAuthError", "DefaultCredentialsError", "401"], [], None),
    ("not_found", ["SpreadsheetNotFound", "404", "NOT_FOUND"], [], None),
    ("permission_denied", ["403", "PermissionDenied"], ["permission"], None),
    ("worksheet_failure", ["WorksheetNotFound"], ["worksheet"], None),
    ("network_failure", ["Connection refused", "Failed to establish a new connection", "Name or service not known", "SSL", "gaierror", "URLError", "TimeoutError", "socket"], [], None),
]


def sink_error(message: Column) -> Column:
    """The class of a sink's error message; `other` if none fits."""
    text = F.coalesce(message, F.lit(""))
    holds = lambda where, parts: reduce(lambda a, b: a | b, [where.contains(p) for p in parts], F.lit(False))
    out = F.lit("other")
    for name, plain, any_case, api in reversed(SINK_ERRORS):
        fits = holds(text, plain) | holds(F.lower(text), any_case)
        if api:
            fits = fits | (text.contains(api) & holds(text, API_OFF))
        out = F.when(fits, name).otherwise(out)
    return out
