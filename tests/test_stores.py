"""Existence by several keys, the sink, the key index, places of rows, ingest that dies between append and commit."""

import datetime as dt
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import existence, fanin, key_index
from tessera.operators.sink import BatchSink
from tessera.streaming import ingest as I


@pytest.mark.parametrize("seed", range(2))
def test_exists_by_any_key(spark, seed):
    """Nulls and blanks match nothing; keys of one kind match across columns, those of two kinds never."""
    r = random.Random(seed)
    some = lambda: r.choice([None, "", " ", *"abcdefghij"])
    rows, held = [(i, some(), some(), some()) for i in range(60)], [(some(), some()) for _ in range(3)]
    df, stored = spark.createDataFrame(rows, "id long, a string, b string, n string"), spark.createDataFrame(held, "a string, n string")
    own, theirs = {"url": ["a", "b"], "name": ["n"]}, {"url": ["a"], "name": ["n"]}
    real = lambda x: bool(x and x.strip())
    want = {i: any((real(x) and x in (a, b)) or (real(y) and y == n) for x, y in held) for i, a, b, n in rows}
    assert {x.id: x.is_stored for x in existence.exists(df, stored, own, "id", theirs).collect()} == want
    assert {x.id for x in existence.new_rows(df, stored, own, "id", theirs).collect()} == {i for i, x in want.items() if not x}
    assert existence.exists(df.limit(0), stored, own, "id", theirs).collect() == []
    assert not any(x.is_stored for x in existence.exists(df, stored.limit(0), own, "id", theirs).collect())


def test_keys_meet_in_one_join(spark):
    df = spark.range(10).select("id", F.col("id").alias("a"), F.col("id").alias("b"))
    plan = existence.found(df, df, {"x": ["a"], "y": ["b"]}, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bJoin\b", plan)) == 1 and " OR " not in plan


def test_sink_takes_a_batch_once(spark, tmp_path):
    sink = BatchSink(spark, str(tmp_path), "w", ["t", "q"])
    one, two = sink.token("r", 1), sink.token("r", 2)
    assert sink.begin(one) is None and sink.committed(one) is None
    sink.write("t", one, spark.range(5))
    sink.write("q", one, spark.range(2))
    sink.commit(one, {"n": 5})
    sink.commit(one, {"n": 5})
    sink.write("t", two, spark.range(7))  # no commit
    again = BatchSink(spark, str(tmp_path), "w", ["t", "q"])
    assert again.begin(one) == {"n": 5}
    assert again.recover() == [two] and again.recover() == []
    assert spark.read.parquet(f"{tmp_path}/t").count() == 5 and spark.read.parquet(f"{tmp_path}/q").count() == 2
    assert BatchSink(spark, str(tmp_path), "w", ["t"]).committed(two) is None


def _job(i, **more):
    return {"company_name": f"C{i}", "title": f"Dev {i}", "url": f"https://j/{i}", "created_at": 1786708800 + i, "remote": True, **more}


def _land(folder, name, body):
    path = folder / "landed" / "jobs" / "arbeitnow"
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(json.dumps(body))


@pytest.mark.parametrize("dies_at", ["commit", "index", "mark"])
def test_ingest_that_dies_changes_nothing_twice(spark, tmp_path, monkeypatch, dies_at):
    """Killed after the table and before the commit, before the index, or after the commit and before its checkpoint: table,
    quarantine and counters are in the end as those of a run that was not."""
    _land(tmp_path, "1.json", {"data": [_job(1), _job(2), _job(1), _job(3, company_name=" ", url="no url")]})
    _land(tmp_path, "2.json", {"data": [_job(2), _job(4)]})
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    now = dt.datetime(2026, 8, 15, 12)
    want = I.ingest(spark, landed, "jobs", str(tmp_path / "whole"), batch_files=1, now=now)

    def die(*a, **k):
        raise OSError("the machine is gone")

    with monkeypatch.context() as m:
        if dies_at == "commit":
            m.setattr(BatchSink, "commit", die)
        elif dies_at == "index":
            m.setattr(key_index.KeyIndex, "add", die)
        with pytest.raises(Exception, match="gone"):
            I.ingest(spark, landed, "jobs", out, batch_files=1, now=now, on_batch=die if dies_at == "mark" else None)
    assert (tmp_path / "out" / "jobs").exists()
    got = I.ingest(spark, landed, "jobs", out, batch_files=1, now=now)
    rows = lambda where: sorted((r.company, r.url) for r in spark.read.parquet(where).collect())
    assert rows(f"{out}/jobs") == rows(f"{tmp_path}/whole/jobs") and len(rows(f"{out}/jobs")) == want.inserted
    bad = [f"{x}/quarantine/jobs" for x in (out, tmp_path / "whole")]
    if want.invalid:
        assert rows(bad[0]) == rows(bad[1]) and len(rows(bad[0])) == want.invalid
    assert (got.processed, got.inserted, got.duplicates, got.invalid) == (want.processed, want.inserted, want.duplicates, want.invalid)


def _index(spark, folder, **how):
    sink = BatchSink(spark, str(folder), "w", key_index.KeyIndex.tables("i"))
    return sink, key_index.KeyIndex(sink, "i", **how)


def test_index_reads_only_buckets_that_may_hold_a_key(spark, tmp_path):
    sink, index = _index(spark, tmp_path)
    keys = {"k": ["k"]}
    for n in range(3):
        index.add(sink.token("r", n), spark.range(n * 5000, n * 5000 + 5000).select(F.concat(F.lit("key"), "id").alias("k")), keys)
    asked = spark.createDataFrame([("k", "key7"), ("k", "new"), ("k", "other")], "kind string, key string")
    plan = index.stored(asked)._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    own = asked.filter("key = 'key7'").select(key_index.bucket().alias("b")).first()["b"]
    named = re.search(r"bucket#\d+ (?:IN \(([\d,]+)\)|= (\d+))", filters)
    assert str(own) in (named.group(1) or named.group(2)).split(",") and len((named.group(1) or named.group(2)).split(",")) <= 3
    read = index.stored(asked).select(F.input_file_name().alias("f")).distinct().collect()
    assert len(read) <= 9 < 3 * index.buckets
    assert index.stored(asked.filter("key = 'nobody has this'")) is None


@pytest.mark.parametrize("how", [{"buckets": 2}, {"buckets": 64}])
def test_index_is_exact(spark, tmp_path, how, monkeypatch):
    """Filters that are nearly full still lose no key, and keys that they let through by mistake are found out."""
    monkeypatch.setattr(key_index, "KEYS_A_FILTER", 20_000)
    sink, index = _index(spark, tmp_path, **how)
    rows = spark.range(0, 40_000, 2).select("id", F.col("id").alias("a"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("n"), "id")).alias("n"))
    own = {"a": ["a"], "n": ["n"]}
    index.add(sink.token("r", 1), rows.filter("id < 30000"), own)
    index.add(sink.token("r", 2), rows.filter("id >= 30000"), own)
    asked = spark.range(0, 50_000).select("id", F.when(F.col("id") % 5 > 0, F.col("id")).alias("a"), F.concat(F.lit("n"), "id").alias("n"))
    got = {r.id for r in index.new_rows(asked, own, "id").collect()}
    stored = lambda i: i < 40_000 and i % 2 == 0 and (i % 5 > 0 or i % 3 == 0)
    assert got == {i for i in range(50_000) if not stored(i)}


def test_filters_are_right_about_most_new_keys(spark, tmp_path):
    sink, index = _index(spark, tmp_path)
    index.add(sink.token("r", 1), spark.range(20_000).select(F.col("id").alias("k")), {"k": ["k"]})
    asked = spark.range(10**6, 10**6 + 20_000).select(F.lit("k").alias("kind"), F.col("id").cast("string").alias("key")).withColumn("bucket", key_index.bucket())
    held = spark.read.parquet(f"{sink.folder}/i/filters")
    assert key_index.may_hold(asked, held).count() < 600
    all_ = spark.range(20_000).select(F.lit("k").alias("kind"), F.col("id").cast("string").alias("key")).withColumn("bucket", key_index.bucket())
    assert key_index.may_hold(all_, held).count() == 20_000


def test_places(spark):
    r = random.Random(4)
    rows = [(r.choice([None, *range(50)]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(7)
    got = {x.i: x.n for x in fanin.numbered(df, ["k", "i"]).collect()}
    assert got == {i: n for n, (_, i) in enumerate(sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1])))}
    plan = fanin.numbered(df, ["k", "i"])._jdf.queryExecution().executedPlan().toString()
    singles = [x for x in plan.splitlines() if "SinglePartition" in x]
    assert len(singles) <= 1, "only the counts of the partitions go through one task"
    assert [x.i for x in fanin.sliced(df, 5, 100, ["k", "i"]).orderBy("k", "i").collect()] == [i for i, n in sorted(got.items(), key=lambda x: x[1])[100:105]]
    assert fanin.numbered(df.limit(0), "i").collect() == [] and fanin.sliced(df, 5, 1000, "i").collect() == []
    assert fanin.from_place(df, 498, "i").count() == 2


def test_limited_stream_forgets_idle_keys(spark, tmp_path):
    """Decisions go on over batches, and the state of a key goes when the watermark has passed its requests."""
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    src = tmp_path / "s"
    batches = [[("a", at(0)), ("a", at(1)), ("b", at(2))], [("a", at(30)), ("a", at(61))], [("c", at(10_000))], [("c", at(20_000))], [("c", at(30_000))]]

    def step(n):
        spark.createDataFrame(batches[n], "k string, t timestamp").coalesce(1).write.mode("append").parquet(str(src))
        stream = I.limited_stream(spark.readStream.schema("k string, t timestamp").parquet(str(src)), "k", "t", 2, 60, "5 seconds")
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "rows")).option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()
        q.awaitTermination()

    for n in range(len(batches)):
        step(n)
    got = sorted((r.k, r.t, r.allowed) for r in spark.read.parquet(str(tmp_path / "rows")).collect())
    assert [(k, ok) for k, _, ok in got] == [("a", True), ("a", True), ("a", False), ("a", True), ("b", True), ("c", True), ("c", True), ("c", True)]
    held = spark.read.format("statestore").option("stateVarName", "times").option("flattenCollectionTypes", "true").load(str(tmp_path / "progress"))
    assert {r.key[0] if hasattr(r.key, "__getitem__") else r.key for r in held.select("key").distinct().collect()} <= {"c"}
