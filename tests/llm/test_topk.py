import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import queries, topk

SCHEMA = "vec_id long, embedding array<double>, score long, rank int, q string"


def brute(rows, ask, k):
    import math

    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.setdefault(i, []).append([math.floor(x * 256) for x in v])
    out = []
    for i in sorted(set(ask) & set(ok)):
        q = ok[i][0]
        held = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for j in ok if j != i for c in ok[j] if len(c) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(held[:k])]
    return out


@pytest.mark.parametrize("dim", [1, 3, 16])
@pytest.mark.parametrize("block", [4, 1000])
def test_against_brute_force(spark, monkeypatch, dim, block):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    monkeypatch.setattr(topk, "CELLS", 64)
    rng = random.Random(dim)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.25, 0.3, 1.0]) for _ in range(dim)]) for i in range(90)]
    rows += [(200, None), (201, [None] * dim), (202, [float("nan")] * dim), (203, [float("inf")] * dim), (204, []), (None, [1.0] * dim), (205, [1.0] * (dim + 1)), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, 0, 0, "x") for i, v in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in topk.search(df, df.filter("vec_id % 10 = 0 or vec_id in (202, 205)"), k=3).collect()]
    assert sorted(got) == sorted(brute(rows, [i for i, _ in rows if i is not None and (i % 10 == 0 or i in (202, 205))], 3))


def test_large_values_stay_exact(spark):
    rows = [(i, [float(2**22 + i), float(2**23 - 3 * i)]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.search(df, df, k=4, scale=1 << 6).collect()]
    exact = {i: [int(x) << 6 for x in v] for i, v in rows}
    for q, _, c, s in got:
        assert s == sum(a * b for a, b in zip(exact[q], exact[c], strict=True))


def test_too_large_values(spark):
    df = spark.createDataFrame([(i, [2.0**40 + i]) for i in range(9)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        topk.search(df, df, k=2).collect()


@pytest.mark.parametrize("decay", [0.0, 0.12])
def test_the_threshold_saves_products(decay):
    """Phases 2 and 3 multiply less than all pairs in full; with weight in few coordinates all three do."""
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((3000, 64)) * np.exp(-decay * np.arange(64)) * 256).astype(np.int64)
    batch = [pa.RecordBatch.from_arrays([pa.array(np.arange(3000)), pa.array(list(vectors))], ["key", "v"])]
    at = np.arange(60)
    shared = SimpleNamespace(value={64: topk.Asked.of(at, at * 50, vectors[::50])})
    one, two = [0], [0]
    heads = dict(topk._gather(batch, shared, 5, 20_000, one))
    first = [heads[i] for i in range(60)]
    # The heads are of chunks of candidates, as of partitions: their fifth score is no more than the true one.
    cutoffs = SimpleNamespace(value=np.array([x[4] for x in first]))
    got = sorted(topk._resolve(batch, shared, cutoffs, 5, 20_000, two))
    scores = vectors[::50] @ vectors.T
    scores[at, at * 50] = -(1 << 62)
    want = sorted((i, int(j), int(scores[i, j])) for i in range(60) for j in np.lexsort((np.arange(3000), -scores[i]))[:5])
    assert got == want
    full = 60 * 3000 * 64
    assert one[0] < 0.3 * full and two[0] < full
    if decay:
        assert one[0] + two[0] < 0.75 * full, (one[0] / full, two[0] / full)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(df, df).collect() == []


def test_query_agrees_with_its_sql(spark, sf):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    want = con.execute(queries.OP2_SQL).fetchall()
    assert sorted(tuple(r) for r in queries.op2_topk(spark, sf).collect()) == sorted(want)
