"""Resumable ingest of landed payloads in micro-batches, and stateful views of request streams."""

from __future__ import annotations

import time
import uuid
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tessera.functions import dates
from tessera.functions.url import canonical_http, url_fingerprint
from tessera.operators import dedup, fanin, quality
from tessera.operators.key_index import KeyIndex
from tessera.operators.sink import BatchSink
from tessera.operators.state import Checkpoints, deleted, scoped, staged
from tessera.sources.feeds import PARSERS, enabled, unreadable
from tessera.sources.landed import payload_stream, payloads, source_key

#: By vertical: the URL that tells rows apart, the date that is checked for freshness, a second key, the kind of constraints.
VERTICALS = {
    "jobs": ("url", "date", None, "job"),
    "news": ("url", "published_date", None, "news"),
    "research": ("paper_url", None, None, "paper"),
    "startups": ("source_url", None, "entity_name", "startup"),
    "products": ("source_url", None, None, "product"),
}


#: Fewest rows that a source may give of a limited run, by vertical.
LEAST = {"news": 5}


@dataclass
class Counts:
    """What a run (with those that it goes on from) found: rows discovered and processed, of these the valid, inserted,
    duplicate and invalid ones; failed: payloads that could not be read."""

    discovered: int = 0
    processed: int = 0
    valid: int = 0
    inserted: int = 0
    duplicates: int = 0
    invalid: int = 0
    failed: int = 0
    seconds: float = 0.0
    last_item: str = ""

    @property
    def a_second(self) -> float:
        return self.processed / max(self.seconds, 0.001)

    def add(self, c: Counts) -> None:
        for k in COUNTED:
            setattr(self, k, getattr(self, k) + getattr(c, k))
        self.last_item = c.last_item or self.last_item


COUNTED = ["discovered", "processed", "valid", "inserted", "duplicates", "invalid", "failed"]


def by_source(payloads: DataFrame, vertical: str, sources: str | None = None) -> dict[str, DataFrame]:
    """The rows of a batch of payloads (path, payload) by source, each by its parser; ord is the path and the place in it."""
    key = source_key(F.col("path"), vertical)
    return {name: parser(payloads.filter(key == name)) for name, parser in enabled(vertical, sources).items()}


def parsed(payloads: DataFrame, vertical: str, sources: str | None = None) -> DataFrame:
    """The rows of all sources with source_key and an order over all: by source, then path and place."""
    parts = [rows.withColumns({"source_key": F.lit(name), "_order": F.struct(F.lit(i).alias("source"), "ord")}) for i, (name, rows) in enumerate(by_source(payloads, vertical, sources).items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def typed(rows: DataFrame, vertical: str, now) -> DataFrame:
    """Stored columns of a vertical: fingerprint, collection time, freshness and effective date; names that constraints use."""
    link, date, _, _ = VERTICALS[vertical]
    out = rows.withColumn("collectedAt", now)
    if vertical != "jobs":  # their URLs are stored as found, those of the others as typed URLs are
        out = out.withColumn(link, F.coalesce(canonical_http(F.col(link)), F.col(link)))
    out = out.withColumn("url_fingerprint", url_fingerprint(F.col(link)))
    if date:
        status = dates.freshness(F.col(date), F.col("date_raw"), now)
        out = out.withColumn("freshness_status", status).withColumn(date, dates.effective_date(F.col(date), F.col("freshness_status"), now))
    if vertical == "research":
        out = out.withColumns({"published_date": dates.or_now(F.col("published_date"), now), "github_stars": F.lit(None).cast("int")})
    names = {"startups": {"entityName": "entity_name", "employeeCount": "employee_count"}, "products": {"startupName": "startup_name", "pricingModel": "pricing_model"}}.get(vertical, {})
    return out.withColumns({k: F.col(v) for k, v in names.items()}) if names else out


def key_columns(vertical: str) -> dict[str, list[str]]:
    """What tells rows of a vertical apart from stored ones, by kind of key: any of them is enough."""
    link, _, name, _ = VERTICALS[vertical]
    return {"url": [link], "fingerprint": ["url_fingerprint"]} | ({"name": [name]} if name else {})


class Target:
    """Where batches of a vertical go: its table, its quarantine and the index of its keys, all through one sink."""

    def __init__(self, spark: SparkSession, folder: str, vertical: str) -> None:
        self.vertical, self.bad, self.name = vertical, f"quarantine/{vertical}", f"index/{vertical}"
        self.sink = BatchSink(spark, folder, vertical, [vertical, self.bad, *KeyIndex.tables(self.name)])
        self.index, self.keys = KeyIndex(self.sink, self.name), key_columns(vertical)

    def new_rows(self, rows: DataFrame) -> DataFrame:
        """rows that the table lacks: those first that have any key of theirs first in the batch, less what is stored."""
        _, _, name, _ = VERTICALS[self.vertical]
        return self.index.new_rows(dedup.batch_to_save(rows, None, "_order", name), self.keys, "_order")


def _observed(o: Observation) -> dict:
    """The metrics of an observation; of a plan that was found to be empty there may be none."""
    return {k: v for k, v in (o.get or {}).items() if v is not None}


def save(rows: DataFrame, target: Target, now, token: str | None, failed: int = 0) -> Counts:
    """One batch of parsed rows: type, check, dedup against the batch and the table, add rows, quarantine and keys.

    Rows are counted by what writes them. A token that is committed writes nothing and gives the counts of its first time;
    without a token nothing is written, and the counts are those that writing would give.
    """
    vertical, sink = target.vertical, target.sink
    if token and (before := sink.begin(token)) is not None:
        return Counts(**before)
    _, _, _, kind = VERTICALS[vertical]
    title = next(c for c in ("title", "entity_name", "product_name") if c in rows.columns)
    with scoped(rows.sparkSession):
        seen, kept = Observation(), Observation()
        checked = quality.validate(typed(rows, vertical, now), kind)
        bad = F.size("errors") > 0
        rows = staged(checked.observe(seen, F.count(F.lit(1)).alias("n"), F.max_by(title, "_order").alias("last"), F.count_if(bad).alias("invalid")))
        found = _observed(seen)
        n, invalid = found.get("n", 0), found.get("invalid", 0)
        new = target.new_rows(rows.filter(~bad).drop("errors")).drop("_order")
        if token is None:
            inserted = new.count()
        else:
            sink.write(vertical, token, new.observe(kept, F.count(F.lit(1)).alias("n")))
            inserted = _observed(kept).get("n", 0)
            if inserted:
                target.index.add(token, sink.read(vertical, token), target.keys)
            else:
                sink.drop(vertical, token)
            if invalid:
                sink.write(target.bad, token, rows.filter(bad).drop("_order"))
    counts = Counts(n, n, n - invalid, inserted, n - invalid - inserted, invalid, failed, 0.0, found.get("last", ""))
    if token:
        sink.commit(token, vars(counts))
    return counts


def save_payloads(batch: DataFrame, target: Target, sources: str | None, now, token: str | None = None) -> Counts:
    """One batch of payloads. Those of the enabled sources that cannot be read count as failed."""
    if token and (before := target.sink.begin(token)) is not None:
        return Counts(**before)
    known = batch.filter(source_key(F.col("path"), target.vertical).isin(list(enabled(target.vertical, sources))))
    failed = known.agg(F.count_if(unreadable(F.col("payload"))).alias("n")).first()["n"]
    return save(parsed(batch, target.vertical, sources), target, now, token, failed)


def _run_id(target: Target, source: str, fresh: bool) -> str:
    """The id under which a run commits its batches: a new one for a fresh run, that of the run that is gone on with else."""
    runs = Checkpoints(target.sink.spark, f"{target.sink.folder}/runs")
    row = None if fresh else runs.get(target.vertical, source)
    run = row["cursor"] if row is not None else uuid.uuid4().hex
    if row is None:
        runs.save(target.vertical, source, cursor=run)
    return run


def _resumed(marks: Checkpoints, vertical: str, source: str, resume: bool) -> tuple[Counts, Row | None]:
    """The counters to go on with, and the checkpoint of an interrupted run, if there is one and it is to be resumed."""
    if not resume:
        marks.reset(vertical, source)
    row = marks.resume(vertical, source) if resume else None
    return (Counts(row["processed"], *(row[k] for k in ("processed", "valid", "inserted", "duplicates", "invalid", "failed"))) if row else Counts()), row


def _mark(marks: Checkpoints, vertical: str, source: str, status: str, c: Counts, **more) -> None:
    marks.save(vertical, source, status=status, last_item=c.last_item, **{k: getattr(c, k) for k in ("processed", "valid", "inserted", "duplicates", "invalid", "failed")}, **more)


def ingest(
    spark: SparkSession,
    landed: str,
    vertical: str,
    folder: str,
    batch_files: int | None = None,
    sources: str | None = None,
    now=None,
    dry_run: bool = False,
    on_batch: Callable[[Counts], None] | None = None,
    limit: int | None = None,
    offset: int = 0,
    resume: bool = True,
    batch_rows: int = 10_000,
) -> Counts:
    """Takes what has landed into the table of a vertical, batch by batch.

    Without a limit: all that has landed since the last run, as a stream of batches of so many files or, by default, bytes. Its own checkpoint says which files are done: an
    interrupted run goes on with the batch that it did not finish, a second run over the same files inserts nothing.
    resume=False starts over from the first file. A batch is committed under the id of its run and its number: taken again, it
    changes neither table nor quarantine, and what a run that died has left without a commit is deleted first.

    With a limit (or an offset): at most so many rows of what has landed, an equal share of each source, batch_rows at a
    time. How far each source is read is kept with the counters after every batch, so an interrupted run, or one that found
    less than its limit, goes on there; a completed one, or resume=False, starts from the offset of each source.

    A dry run reads what is there once, writes neither rows nor progress. now: the time of collection, by default that of the run.
    """
    if vertical not in PARSERS:
        raise ValueError(f"unknown vertical {vertical!r}")
    began, at = time.monotonic(), F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    where, marks, source = f"{landed}/{vertical}", Checkpoints(spark, f"{folder}/checkpoints"), sources or "all"
    target = Target(spark, folder, vertical)
    if not dry_run:
        target.sink.recover()

    if limit is not None or offset:
        total = _limited(spark, where, target, sources, at, dry_run, on_batch, limit, offset, resume, batch_rows, marks)
    elif dry_run:
        total = save_payloads(payloads(spark, where), target, sources, at)
        if on_batch:
            on_batch(total)
    else:
        progress = f"{folder}/progress/{vertical}"
        if not resume:
            deleted(spark, [progress])
        stream = payload_stream(spark, where, batch_files)
        total, row = _resumed(marks, vertical, source, resume)
        run = _run_id(target, source, row is None)
        done = int(row["cursor"]) if row and (row["cursor"] or "").lstrip("-").isdigit() else -1

        def take(df: DataFrame, batch: int) -> None:
            nonlocal done
            c = save_payloads(df, target, sources, at, target.sink.token(run, batch))
            if batch > done:  # a batch that is taken again was counted before
                total.add(c)
                done = batch
            _mark(marks, vertical, source, "running", total, cursor=str(done))
            if on_batch:
                on_batch(c)

        _mark(marks, vertical, source, "running", total, cursor=str(done))
        query = stream.writeStream.foreachBatch(take).option("checkpointLocation", progress).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except BaseException:
            query.stop()
            _mark(marks, vertical, source, "interrupted", total, cursor=str(done))
            raise
        _mark(marks, vertical, source, "completed", total, cursor=str(done))
    total.seconds = time.monotonic() - began
    return total


def _limited(spark, where, target, sources, at, dry_run, on_batch, limit, offset, resume, batch_rows, marks) -> Counts:
    vertical, name_of = target.vertical, sources or "all"
    names = list(enabled(vertical, sources))
    total, row = (Counts(), None) if dry_run else _resumed(marks, vertical, name_of, resume)
    run = None if dry_run else _run_id(target, name_of, row is None)
    held = {n: None if dry_run or row is None else marks.get(vertical, n) for n in names}
    start = {n: int(c["cursor"]) if c is not None else offset for n, c in held.items()}
    wanted = (1 << 31) - 1 if limit is None else limit - total.processed
    if wanted <= 0:
        return total
    with scoped(spark):
        landed = payloads(spark, where)
        known = landed.filter(source_key(F.col("path"), vertical).isin(names))
        found = by_source(landed, vertical, sources)
        if limit is None:
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [fanin.from_place(df, start[n]).withColumns({"source_key": F.lit(n)}) for n, df in found.items()])
        else:
            rows = fanin.fan_in(found, wanted, start, LEAST.get(vertical, 1))
        number = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)])
        rows = staged(rows.withColumn("_order", F.struct(number[F.col("source_key")].alias("source"), "ord")))
        ranks = staged(fanin.numbered(rows.select("_order", "source_key"), "_order", "_rank"))
        n = ranks.count()
        failed = known.agg(F.count_if(unreadable(F.col("payload"))).alias("n")).first()["n"] if row is None else 0
        status = lambda: "completed" if limit is not None and total.processed >= limit else "running"
        try:
            for first in range(0, n, batch_rows):
                mine = ranks.filter((F.col("_rank") >= first) & (F.col("_rank") < first + batch_rows))
                # A batch is known by how many rows of the run came before it.
                token = None if dry_run else target.sink.token(run, total.processed)
                c = save(rows.join(mine.select("_order"), "_order", "left_semi"), target, at, token, failed if first == 0 else 0)
                total.add(c)
                if not dry_run:
                    for r in mine.groupBy("source_key").agg(F.count("*").alias("n"), F.max("_order").alias("last")).collect():
                        start[r["source_key"]] += r["n"]
                    for name in names:
                        marks.save(vertical, name, cursor=str(start[name]), status=status())
                    _mark(marks, vertical, name_of, status(), total, cursor=str(total.processed))
                if on_batch:
                    on_batch(c)
        except BaseException:
            if not dry_run:
                _mark(marks, vertical, name_of, "interrupted", total, cursor=str(total.processed))
            raise
        if not n and not dry_run:
            _mark(marks, vertical, name_of, status(), total, cursor=str(total.processed))
    return total


def rate_window(requests: DataFrame, by: str, at: str, seconds: int = 60) -> DataFrame:
    """requests with `in_window`: those of the same key in the seconds up to each (its own time included).

    A row's window lies in its own stretch of so many seconds and the one before, so a row takes part in its own and in the
    next one, and windows are parted by key and stretch: a key with very many requests is spread over its time.
    """
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    stretch = F.floor(micros / (seconds * 1_000_000))
    both = requests.withColumns({"_at": micros, "_own": F.explode(F.array(F.lit(True), F.lit(False)))}).withColumn("_part", stretch + F.when(F.col("_own"), 0).otherwise(1))
    w = Window.partitionBy(by, "_part").orderBy("_at").rangeBetween(-seconds * 1_000_000 + 1, 0)
    return both.withColumn("in_window", F.count("*").over(w)).filter("_own").drop("_at", "_own", "_part")


def rate_stream(requests: DataFrame, by: str, at: str, limit: int, seconds: int = 60, late: str = "10 minutes") -> DataFrame:
    """Tumbling counts over the limit of a request stream: key, window start, n. Late requests count until the watermark."""
    counted = requests.withWatermark(at, late).groupBy(F.window(at, f"{seconds} seconds").alias("w"), by).agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") > limit).select(by, F.col("w.start").alias("window_start"), "n")


class _Limit(StatefulProcessor):
    """Allowed requests of a key in the last seconds, as list state; the key goes when the watermark has passed all of them."""

    def __init__(self, by: str, at: str, limit: int, seconds: int) -> None:
        self.names, self.limit, self.span = [by, at, "allowed"], limit, seconds * 1_000_000

    def init(self, handle) -> None:
        self.handle, self.times = handle, handle.getListState("times", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        stamps = pd.concat([b[self.names[1]] for b in rows]).sort_values(ignore_index=True)
        held, ok = sorted(t for (t,) in self.times.get()) if self.times.exists() else [], []
        for t in stamps.astype("datetime64[us]").astype("int64").tolist():
            allowed = bisect_right(held, t) - bisect_right(held, t - self.span) < self.limit
            if allowed:
                insort(held, t)
            ok.append(allowed)
        # Late requests are no older than the watermark, so what it has left behind by the span counts for none.
        held = held[bisect_right(held, timerValues.getCurrentWatermarkInMs() * 1000 - self.span) :]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if held:
            self.times.put([(t,) for t in held])
            self.handle.registerTimer((held[-1] + self.span) // 1000 + 1)
        else:
            self.times.clear()
        yield pd.DataFrame({self.names[0]: [key[0]] * len(ok), self.names[1]: stamps, self.names[2]: ok})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.times.clear()
        yield pd.DataFrame(columns=self.names)

    def close(self) -> None:
        pass


#: The state store that timers and lists need; a session that streams `limited_stream` is to name it.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def limited_stream(requests: DataFrame, by: str, at: str, limit: int, seconds: int = 60, late: str = "10 minutes") -> DataFrame:
    """Of a request stream key, time and `allowed`: whether fewer than `limit` allowed requests of its key lie in the seconds up
    to it. Requests of a batch are decided at once, in order of time; those older than the watermark are dropped.

    A key's state is its allowed requests of the last seconds (and of as long as the watermark lags); a timer drops it when
    the watermark has passed them. The session's state store is set to the one that has timers, for as long as it lives.
    """
    requests.sparkSession.conf.set(*STATE_STORE)
    kind = requests.schema[by].dataType.simpleString()
    rows = requests.select(by, at).withWatermark(at, late).groupBy(by)
    return rows.transformWithStateInPandas(_Limit(by, at, limit, seconds), f"{by} {kind}, {at} timestamp, allowed boolean", "Append", "EventTime")


def answer_cache(requests: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests with the answer that the cache has for their fingerprint, requests that it lacks)."""
    held = cache.dropDuplicates(["fingerprint"])
    return requests.join(held, "fingerprint"), requests.join(held.select("fingerprint"), "fingerprint", "left_anti")
