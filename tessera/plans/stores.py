"""Queries over stored tables: existence by any of several keys, batches that are taken more than once, the key index, places of
rows in an order."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import url
from tessera.operators import existence, fanin, resolve, state
from tessera.operators.key_index import KeyIndex
from tessera.operators.sink import BatchSink
from tessera.plans.catalog import _norm, query
from tessera.sources import pages
from tessera.sources.crawl import CrawlPolicy
from tessera.sources.fetching import Paged
from tessera.streaming import ingest as streaming


@query(f"""with p as (select page_id, url, {_norm("url")} as n, 'page ' || page_id % 97 as name from pages),
s as (select case when page_id % 2 = 0 then n end as n, case when page_id % 3 = 0 then url end as raw, case when page_id % 5 = 0 then sha256(n) end as fp, case when page_id % 7 = 0 then name end as name from p where page_id % 8 = 0)
select page_id, exists (select 1 from s where s.n = p.n or s.n = p.url or s.raw = p.n or s.raw = p.url or s.fp = sha256(p.n) or (p.page_id % 3 = 1 and s.name = p.name)) as is_stored from p""")
def exists_by_any_key(read, spark):
    """Pages that are stored by their URL as it is or normalized, by its fingerprint, or (a third of them) by a name; stored rows
    lack some of the keys."""
    page, link = F.col("page_id"), url.normalize_url(F.col("url"))
    rows = state.staged(read("pages").select("page_id", "url", link.alias("normalized"), F.concat(F.lit("page "), page % 97).alias("name"))).withColumn("fingerprint", F.sha2("normalized", 256))
    stored = rows.filter("page_id % 8 = 0").select(
        F.when(page % 2 == 0, F.col("normalized")).alias("normalized"), F.when(page % 3 == 0, F.col("url")).alias("raw"), F.when(page % 5 == 0, F.col("fingerprint")).alias("fingerprint"), F.when(page % 7 == 0, F.col("name")).alias("name")
    )
    own = {"url": ["normalized", "url"], "fingerprint": ["fingerprint"], "name": [F.when(page % 3 == 1, F.col("name"))]}
    held = {"url": ["normalized", "raw"], "fingerprint": ["fingerprint"], "name": ["name"]}
    return existence.exists(rows, stored, own, "page_id", held).select("page_id", "is_stored")


_BATCHES = 4


@query(f"select user_id % {_BATCHES} as batch, count(*) filter (event_type <> 'view') as kept, count(*) filter (event_type = 'view') as refused from events group by 1")
def batches_once(read, spark):
    """Events go in by batches into a table and a quarantine. Every batch is sent twice, and before that its writer dies once
    after the table and before the commit; each row is there once."""
    sink = BatchSink(spark, state.scratch(spark), "events", ["rows", "refused"])
    rows = read("events").select("event_id", "event_type", (F.col("user_id") % _BATCHES).alias("number"))
    for number in range(_BATCHES):
        mine, token = rows.filter(F.col("number") == number), sink.token("run", number)
        sink.write("rows", token, mine.filter("event_type <> 'view'"))  # and the writer dies
        sink.recover()
        for _ in range(2):
            if sink.begin(token) is None:
                sink.write("rows", token, mine.filter("event_type <> 'view'"))
                sink.write("refused", token, mine.filter("event_type = 'view'"))
                sink.commit(token, {"number": number})
    counts = lambda table, name: spark.read.parquet(f"{sink.folder}/{table}").groupBy("number").agg(F.count("*").alias(name))
    return counts("rows", "kept").join(counts("refused", "refused"), "number", "full").fillna(0).select(F.col("number").alias("batch"), "kept", "refused")


@query("""with o as (select o_orderkey, o_custkey, o_orderdate, o_custkey % 50 as ring, o_custkey % 3 = 0 or o_orderkey % 4 = 3 as sent from orders), s as (select * from o where not sent)
select o_orderkey from o where sent and not exists (select 1 from s where s.o_custkey = o.o_custkey) and not exists (select 1 from s where s.o_orderdate = o.o_orderdate and s.ring = o.ring)""")
def index_new_rows(read, spark):
    """Of a batch of orders those whose customer, and whose day with a group of customers, no stored order has: all other orders
    are stored and indexed, in two batches, and this one is probed through the filters."""
    sent = (F.col("o_custkey") % 3 == 0) | (F.col("o_orderkey") % 4 == 3)
    orders = read("orders").select("o_orderkey", "o_custkey", F.concat_ws(" ", "o_orderdate", F.col("o_custkey") % 50).alias("day"))
    sink = BatchSink(spark, state.scratch(spark), "orders", KeyIndex.tables("index"))
    index, keys = KeyIndex(sink, "index"), {"customer": ["o_custkey"], "day": ["day"]}
    for number in range(2):
        index.add(sink.token("run", number), orders.filter(~sent & (F.col("o_orderkey") % 2 == number)), keys)
        sink.commit(sink.token("run", number), {})
    return index.new_rows(orders.filter(sent), keys, "o_orderkey").select("o_orderkey")


_CHAIN = "md5('a' || s_suppkey) || md5('b' || s_suppkey)"


@query(f"""with h as (select s_suppkey as k, {_CHAIN} as h, unnest(range(1, 5)) as i from supplier)
select k, i::integer as i, case when k % 2 = 0 or i = 1 then 'ent_' || k else 'unresolved_' || substr(h, 3 * i + 1, 20) end as canonical_id, case when k % 2 = 0 or i = 1 then 'fuzzy' else 'unresolved' end as match_method,
  case when k % 2 = 0 or i = 1 then 0.85 else 0.0 end::double as confidence from h""")
def resolve_chain(read, spark):
    """Four names a supplier of which each is like the one before and unlike the entity: in order all resolve, by the aliases that
    those before have left; backwards, as of every second supplier, only the nearest one does."""
    letters = F.concat(F.md5(F.concat(F.lit("a"), "s_suppkey")), F.md5(F.concat(F.lit("b"), "s_suppkey")))
    rows = read("supplier").select(F.col("s_suppkey").alias("k"), letters.alias("h"))
    entities = rows.select(F.concat(F.lit("ent_"), "k").alias("canonical_id"), F.substring("h", 1, 20).alias("canonical_name"), F.array().cast("array<string>").alias("aliases"))
    steps = state.staged(rows.select("k", "h", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("i")).withColumn("raw_name", F.substring(F.col("h"), 3 * F.col("i") + 1, F.lit(20))))
    place = F.when(F.col("k") % 2 == 0, F.col("i")).otherwise(-F.col("i"))
    found = resolve.resolve_in_order(steps.select("raw_name", F.lit(None).cast("string").alias("source_url"), place.alias("place")), entities, "place")
    return steps.join(found, "raw_name").select("k", "i", "canonical_id", "match_method", "confidence")


@query("select l_orderkey, l_linenumber, row_number() over (order by l_shipdate, l_orderkey, l_linenumber) - 1 as place from lineitem")
def row_places(read, spark):
    """The place of every line in order of shipping, over all partitions at once."""
    return fanin.numbered(read("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), ["l_shipdate", "l_orderkey", "l_linenumber"], "place").drop("l_shipdate")


@query("select l_orderkey, l_linenumber from lineitem order by l_shipdate, l_orderkey, l_linenumber limit 500 offset (select count(*) // 2 from lineitem)")
def rows_from_the_middle(read, spark):
    """A slice far from the first row."""
    rows = read("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return fanin.sliced(rows, 500, rows.count() // 2, ["l_shipdate", "l_orderkey", "l_linenumber"]).drop("l_shipdate")


# ---- paged sources ----------------------------------------------------------------------------------------------------

_SEGMENTS, _PAGE = 4, 20
#: Parts as items of four searches, in pages; the third page of the third search has got lost.
_LISTED = f"select p_partkey, p_partkey % {_SEGMENTS} as segment, ((row_number() over (partition by p_partkey % {_SEGMENTS} order by p_partkey) - 1) // {_PAGE} + 1) as page from part"


def _listed(read, spark) -> tuple[Paged, int]:
    """(the source of the landed pages, pages of the longest segment)."""
    rows = read("part").select("p_partkey", (F.col("p_partkey") % _SEGMENTS).alias("segment"))
    at = F.row_number().over(Window.partitionBy("segment").orderBy("p_partkey")) - 1
    placed = rows.withColumn("page", F.floor(at / _PAGE) + 1).groupBy("segment", "page").agg(F.sort_array(F.collect_list("p_partkey")).alias("items"))
    folder = state.scratch(spark)
    text = placed.filter("not (segment = 2 and page = 3)").select("segment", "page", F.to_json(F.struct("items")).alias("value"))
    # A number, as Spark joins partitions of few bytes else, and one task writes all the files.
    text.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "segment", "page").write.partitionBy("segment", "page").text(folder)
    most = placed.agg(F.max("page")).first()[0]
    base = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return Paged(lambda query, page: f"{base}/segment={query}/page={page}", _PAGE, None, [str(i) for i in range(_SEGMENTS)]), most


def _parts(rows):
    return rows.select("segment", "page", F.explode(F.from_json("payload", "items array<long>")["items"]).alias("p_partkey"))


_POLICY = CrawlPolicy(backoff_base=0.0, jitter=False, retries=1)


@query(f"select segment::integer as segment, page::integer as page, p_partkey from ({_LISTED}) where not (segment = 2 and page > 2)")
def pages_read(read, spark):
    """The landed pages through the batch reader; what comes after a page that is missing does not count."""
    source, most = _listed(read, spark)
    name = pages.register(spark, "tessera_parts", source, _POLICY, pages.folder_transport)
    return _parts(pages.contiguous(spark.read.format(name).option("pages", most + 1).load()))


@query(f"select segment::integer as segment, page::integer as page, p_partkey from ({_LISTED}) where page <= 7 and not (segment = 2 and page > 2)")
def pages_streamed(read, spark):
    """The same as a stream of three pages a batch with at most seven pages a segment, stopped and started again."""
    source, _ = _listed(read, spark)
    folder = state.scratch(spark)
    name = pages.register(spark, "tessera_parts_stream", Paged(source.url, _PAGE, 7, source.queries), _POLICY, pages.folder_transport)
    kept = f"{folder}/rows"
    base = folder if folder.startswith("file:") or "://" in folder else f"file://{folder}"
    for _ in range(2):
        stream = spark.readStream.format(name).option("state", f"{base}/state").option("pagesABatch", 3).option("pagesATask", 1).load().filter("items > 0")
        running = stream.writeStream.format("parquet").option("path", kept).option("checkpointLocation", f"{folder}/progress").start()
        try:
            running.processAllAvailable()
        finally:
            running.stop()
    return _parts(spark.read.parquet(kept))


# ---- streams ----------------------------------------------------------------------------------------------------------

_ALLOWED, _WITHIN = 2, 6 * 3600


@query(f"""with recursive e as (select user_id, ts, epoch_us(ts) as t, row_number() over (partition by user_id order by ts) as n from events),
r as (
  select user_id, 0::bigint as n, []::bigint[] as held, null::timestamp as ts, null::boolean as allowed from (select distinct user_id from events)
  union all
  select e.user_id, e.n, case when c < {_ALLOWED} then list_append(held, t) else held end, e.ts, c < {_ALLOWED}
  from (select e.*, r.held, len(list_filter(r.held, lambda x: x > e.t - {_WITHIN}::bigint * 1000000)) as c from r join e on e.user_id = r.user_id and e.n = r.n + 1) e
)
select user_id, ts, allowed from r where n > 0""")
def limited_requests(read, spark):
    """Events as requests of users, two in any six hours, decided as a stream with state and timers."""
    folder = state.scratch(spark)
    held = state.staged(read("events").select("user_id", F.col("ts").cast("timestamp").alias("ts")))
    stream = spark.readStream.schema(held.schema).parquet(held._staged_at)
    done = streaming.limited_stream(stream, "user_id", "ts", _ALLOWED, _WITHIN)
    running = done.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.parquet(f"{folder}/rows").select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "allowed")
