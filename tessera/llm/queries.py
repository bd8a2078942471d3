"""The queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, divergence, html_diff, interactions, jaccard, langid, licenses, quality_rules, spans, tiling, topk, url_alias, warc
from tessera.llm.common import hash_bound

#: The tokenizer of the contract. Others of the tokenizers library give right results too, but a text is one word then.
TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def fold(key: str, n: int):
    """The contract's folds: crc32 of the key as text, modulo n; -1 of a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % n, F.lit(-1))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    done = bpe.encode_decode(docs, tokenizer_path())
    return done.select(
        "doc_id",
        F.expr("cast(octet_length(ids) / 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


OP2_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id as vec_id,
         cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e)
  where q.vec_id % 50 = 0
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5
"""


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    model = langid.fit(docs.filter(~held_out), order="doc_id")
    return langid.predict(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_diff.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


#: The pages of these tables have one article each, of h1 and p: a plain reading of that element gives the same text.
OP3_SQL = r"""
with a as (
  select page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1), '<[^>]*$', '') as body from pages
), b as (
  select page_id, url, list_filter(list_transform(string_split_regex(regexp_replace(regexp_replace(body, '</?b>', '', 'g'), '<br>', ' ', 'g'), '</?(?:p|h1)>'),
    lambda x: trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(x, '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' '), '&amp;?', '&', 'g'), '[\s\x{a0}]+', ' ', 'g'))), lambda x: x <> '') as lines
  from a
)
select page_id, url, array_to_string(lines, chr(10) || chr(10)) as text, cast(length(array_to_string(lines, chr(10) || chr(10))) as bigint) as n_chars from b
"""


def op4_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed", "chars_removed")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(bundles).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
with p as (
  select page_id, coalesce(html, '') as h, octet_length(encode(coalesce(html, ''))) as n from pages
), d as (
  select page_id, n, sha1(h) as x, min(page_id) over (partition by sha1(h), n) as first from p
), b as (
  select *, list_aggregate(list_transform(string_split(x, ''), lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (instr('0123456789abcdef', c) - 1) + 1, 4)), 'string_agg', '') as bits from d
)
select page_id, cast(n as bigint) as payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_sum(list_transform(range(1, 6), lambda k: cast(substr(bits, 5 * i + k, 1) as integer) * (1 << cast(5 - k as integer))))::integer, 1)), 'string_agg', '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from b
"""

RULES = [
    url_alias.rule("allow", "org/"),
    url_alias.rule("block", "example.org/es/"),
    url_alias.rule("block", "example.org/en/1"),
    url_alias.rule("allow", "com/fr/"),
    url_alias.rule("block", "com/de/"),
]


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_alias.judge(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def _fit_sql(host: str, path: str) -> str:
    """The name of the longest rule that fits, as a CASE over the rules from the longest on."""
    longest = sorted(RULES, key=lambda r: (-len(r.name), r.verdict))
    return "case " + " ".join(f"when ({host} = '{r.host}' or ends_with({host}, '.{r.host}')) and starts_with({path}, '{r.path}') then '{r.name}'" for r in longest) + " end"


_VERDICT = "case {} " + " ".join(f"when '{r.name}' then '{r.verdict}'" for r in RULES) + " end"
_HOST = "regexp_extract({0}, '(?s)^.*?://([^/?#]*)', 1)"
_PATH = "regexp_extract({0}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DOTLESS = "case when contains({0}, '/.') then list_reduce(list_prepend('', string_split({0}[2:], '/')), lambda a, x: case x when '.' then a when '..' then regexp_replace(a, '/[^/]*$', '') else a || '/' || x end) || case when string_split({0}, '/')[-1] in ('.', '..') then '/' else '' end else {0} end"


def _node_sql(url: str) -> str:
    path = _PATH.format(url)
    return f"case when {url} like '%://%' and {_HOST.format(url)} <> '' then {_LOWERED.format(_HOST.format(url))} || case when {path} = '' then '/' else {_DOTLESS.format(path)} end || regexp_extract({url}, '(?s)^.*?://[^?#]*(\\?[^#]*)', 1) end"


def _attribute_sql(tag: str, name: str) -> str:
    pattern = rf"""(?is)^<\w+(?:\s+[^\s=>"''/]+(?:\s*=\s*(?:"[^"]*"|''[^'']*''|[^"''\s>][^\s>]*))?|\s|/)*?\s{name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^"''\s>][^\s>]*))"""
    return "(" + " || ".join(f"coalesce(regexp_extract({tag}, '{pattern}', {i}), '')" for i in (1, 2, 3)) + ")"


_TAGS = r"""regexp_extract_all(bare, '(?is)<{0}\b(?:[^>"'']|"[^"]*"|''[^'']*'')*>')"""
OP7_SQL = rf"""
with recursive p as (
  select page_id, url, html,
    case when url like '%://%' then {_LOWERED.format(_HOST.format("url"))} else '' end as host,
    case when url like '%://%' then {_PATH.format("url")} else '' end as path
  from pages
), bared as (
  select url, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<!--.*?(?:-->|\z)', '', 'g'), '(?is)<script\b[^>]*>.*?(?:</script\b|\z)', '', 'g'), '(?is)<style\b[^>]*>.*?(?:</style\b|\z)', '', 'g') as bare
  from pages
), tags as (
  select url, list_filter({_TAGS.format("link")}, lambda x: list_contains(string_split_regex(lower({_attribute_sql("x", "rel")}), '\s+'), 'canonical'))[1] as link,
    list_filter({_TAGS.format("meta")}, lambda x: lower(trim({_attribute_sql("x", "http-equiv")})) = 'refresh')[1] as meta
  from bared
), t as (
  select url, trim(replace(unnest([{_attribute_sql("link", "href")}, regexp_extract({_attribute_sql("meta", "content")}, '(?is)^[\s\d.]*[;,\s]\s*url\s*=\s*["'']?\s*([^"'']*)', 1)]), '&amp;', '&')) as target
  from tags
), parts as (
  select url, target, regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) as root, {_PATH.format("url")} as path, regexp_extract(target, '(?s)^([^?#]*)', 1) as own
  from t where target <> ''
), l as (
  select url, case when regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') then target
    when target like '//%' then regexp_extract(url, '(?s)^(.*?:)//', 1) || target
    when regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') then null
    when own like '/%' then root || target
    when own <> '' then root || case when path = '' then '/' else regexp_replace(path, '[^/]*$', '') end || target
    when target like '?%' then root || path || target
    else root || path || regexp_extract(url, '(?s)^.*?://[^?#]*(\?[^#]*)', 1) || target end as target
  from parts
), e as (
  select distinct {_node_sql("url")} as a, {_node_sql("target")} as b from l
), both_ways as (
  select a, b from e where a <> b union select b, a from e where a <> b
), reach(a, b) as (
  select a, a from both_ways union select r.a, w.b from reach r join both_ways w on r.b = w.a
), blocked as (
  select distinct a from reach
  where {_VERDICT.format(_fit_sql("regexp_extract(b, '(?s)^([^/]*)', 1)", "regexp_extract(b, '(?s)^[^/]*([^?]*)', 1)"))} = 'block'
), j as (
  select page_id, host, path, {_fit_sql("host", "path")} as rule, {_node_sql("url")} as node from p
)
select page_id, host, path, rule,
  coalesce({_VERDICT.format("rule")}, case when node in (select a from blocked) then 'block' else 'allow' end) as verdict
from j
"""


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 4) != 2).filter("quality in (0, 1)")
    rows, total = training_rows(docs, labels)
    model = quality_rules.fit(rows, total=total)
    scored = quality_rules.score(docs, model)
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = quality_rules.SAMPLE) -> tuple[DataFrame, int]:
    """(doc_id, text, label of labelled documents, by hash of doc_id; the number of labels, at most about bound, that are
    broadcast for it)."""
    rows = labels.groupBy("doc_id").agg(F.min("quality").alias("label"))
    total = rows.count()
    if total > bound:
        rows = rows.filter(F.xxhash64("doc_id") <= hash_bound(0.95 * bound / total))
    return docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id"), min(total, bound)


def op9_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "text_id", "n_links")


_SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
OP10_SQL = f"""
with recursive t as (
  select md5(coalesce(text, '')) as id, min(doc_id) as text_id, any_value(coalesce(text, '')) as text from documents group by 1
), w as (
  select id, list_filter(string_split_regex(text, '{_SPACE}'), lambda x: x <> '') as w from t
), s as (
  select distinct id, unnest(case when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g
  from w where len(w) > 0
), n as (
  select id, count(*) as n from s group by 1
), c as (
  select a.id as a, b.id as b, count(*) as both_have from s a join s b on a.g = b.g and a.id <> b.id group by 1, 2
), l as (
  select c.a, c.b from c join n x on x.id = c.a join n y on y.id = c.b where both_have / (x.n + y.n - both_have) >= 0.8
), reach(a, b) as (
  select id, id from t union select r.a, l.b from reach r join l on r.b = l.a
), k as (
  select r.a as id, min(t.text_id) as class_id from reach r join t on t.id = r.b group by 1
), m as (
  select a as id, count(*) as n_links from l group by 1
)
select d.doc_id, k.class_id, t.text_id, coalesce(m.n_links, 0)::bigint as n_links
from documents d join t on t.id = md5(coalesce(d.text, '')) join k on k.id = t.id left join m on m.id = t.id
"""



def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
with d as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), g as (
  select distinct lang, source from d
), t as (
  select lang, source, term, count(*) as n, count(distinct row) as docs from (select lang, source, row, unnest(w) as term from d) group by 1, 2, 3
), k as (
  select lang, term, sum(n) as n from t group by 1, 2 having sum(docs) >= 3
), v as (
  select lang, count(*)::hugeint as v, sum(n)::hugeint as n from k group by 1
), s as (
  select g.lang, g.source, k.term, coalesce(t.n, 0)::hugeint as c, k.n::hugeint as lang_c
  from g join k using (lang) left join t using (lang, source, term)
), p as (
  select s.*, 1 + 1000000000 * (c + 1) // (sum(c) over (partition by s.lang, source) + v.v) as p, 1 + 1000000000 * (lang_c + 1) // (v.n + v.v) as q
  from s join v using (lang)
), pair as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3
), r as (
  select x.lang, x.source, 'pair' as part, y.source as item, coalesce(value, 0)::bigint as value
  from g x join g y on x.lang = y.lang and x.source <> y.source left join pair on pair.lang = x.lang and pair.source = x.source and pair.item = y.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint from p where c > 0 and p > q
), o as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::integer as rank from r
)
select * from o where part = 'pair' or rank <= 200
"""


def op12_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
with t as (
  select doc_id, coalesce(text, '') as text, coalesce(lang, '') as part from documents
), w as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w, min(doc_id) over (partition by text) as least from t
), f as (
  select doc_id, part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text),
    regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] as fails
  from w
), l as (
  select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels where doc_id is not null group by 1
), m as (
  select part, fails, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic
  from f left join l using (doc_id) group by 1, 2
), letters as (
  select unnest(range(1, 6)) as i
), o as (
  select [a.i, b.i, c.i, d.i, e.i] as o from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), s as (
  select part, o, step, o[step] as own, fails, n, good, toxic, len(list_filter(o[1:step - 1], lambda i: fails[i])) > 0 as before
  from m, o, (select unnest(range(1, 6)) as step)
), r as (
  select part, o, step, own,
    sum(n) filter (where not before and not fails[own]) as kept, sum(n) filter (where not before and fails[own]) as removed,
    sum(n) filter (where before and fails[own]) as redundant, sum(n) filter (where fails[own] and len(list_filter(fails, lambda x: x)) = 1) as alone,
    sum(good) filter (where not before and fails[own]) as good_lost, sum(toxic) filter (where not before and fails[own]) as toxic_lost
  from s group by 1, 2, 3, 4
)
select part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') as filter_order, step::integer as step,
  coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant,
  coalesce(alone, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  coalesce(sum(removed) over (partition by part, own), 0)::bigint as shapley
from r
"""


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.filter("license_places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"].cast("long"))
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("license_places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("license_places", lambda p: p["score"])), F.lit(0.0)).alias("score"),
    )


def _places_sql(t: licenses.Template) -> str:
    """Starts (from 1) of a key in the words w."""
    key = t.key.split()
    tests = " and ".join(f"w[i + {j}] = '{x}'" if j else f"w[i] = '{x}'" for j, x in enumerate(key))
    return f"list_filter(range(1, len(w) + 1), lambda i: {tests})"


def _score_sql(t: licenses.Template, places: str) -> str:
    own = sorted(set(t.words))
    if own == sorted(set(t.key.split())):
        return f"case when len({places}) > 0 then 1.0::double else 0.0::double end"
    listed, size = "[" + ", ".join(f"'{x}'" for x in own) + "]", len(t.words)
    weigh = lambda words: f"list_sum(list_transform({words}, lambda x: weights[x]))"
    near = f"w[greatest(i - {t.at + licenses.SLACK}, 1):i - {t.at} + {size + licenses.SLACK} - 1]"
    return f"coalesce(list_max(list_transform({places}, lambda i: coalesce({weigh(f'list_intersect({listed}, {near})')}, 0)::double / {weigh(listed)}::double)), 0)"


_ALL = list(enumerate(licenses.TEMPLATES))
OP13_SQL = rf"""
with d as (
  select row_number() over () as row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), v as (
  select unnest([{", ".join(f"'{x}'" for x in sorted({x for t in licenses.TEMPLATES for x in t.words}))}]) as word
), n as (
  select v.word, count(x.row) as n from v left join (select distinct row, unnest(w) as word from d) x using (word) group by 1
), i as (
  select map(list(word), list(1 + round(1000 * log2(((select count(*) from d) + 1) / (n + 1)))::bigint)) as weights from n
), p as (
  select doc_id, w, weights, {", ".join(f"{_places_sql(t)} as p{k}" for k, t in _ALL)} from d, i
), l as (
  select doc_id, len(w) as n_words, {" || ".join(f"p{k}" for k, t in _ALL if t.base)} as base,
    {" || ".join(f"case when len(p{k}) > 0 then ['{t.label}'] else [] end" for k, t in _ALL if t.base)} as base_labels,
    {" || ".join(f"case when len(p{k}) > 0 then ['{t.label}'] else [] end" for k, t in _ALL)} as labels,
    greatest({", ".join(_score_sql(t, f"p{k}") for k, t in _ALL)}) as score
  from p
)
select doc_id, n_words::bigint as n_words, len(base)::bigint as n_base, list_min(base)::bigint - 1 as first_word, list_max(base)::bigint - 1 as last_word,
  array_to_string(list_sort(list_distinct(base_labels)), ',') as base_labels, array_to_string(list_sort(list_distinct(labels)), ',') as labels, score::double as score
from l
"""

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_topk": op2_topk,
    "op3_html": op3_html,
    "op4_spans": op4_spans,
    "op5_warc": op5_warc,
    "op6_langid": op6_langid,
    "op7_urls": op7_urls,
    "op8_quality": op8_quality,
    "op9_tiling": op9_tiling,
    "op10_jaccard": op10_jaccard,
    "op11_divergence": op11_divergence,
    "op12_interactions": op12_interactions,
    "op13_licenses": op13_licenses,
}
SQL = {"op2_topk": OP2_SQL, "op3_html": OP3_SQL, "op5_warc": OP5_SQL, "op7_urls": OP7_SQL, "op10_jaccard": OP10_SQL, "op11_divergence": OP11_SQL, "op12_interactions": OP12_SQL, "op13_licenses": OP13_SQL}
