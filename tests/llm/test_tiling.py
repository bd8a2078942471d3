import random
import time

import pytest

from tessera.llm import queries, tiling

RNG = random.Random(11)
VOCAB = [f"v{i}" for i in range(300)]


def text(n):
    return " ".join(RNG.choice(VOCAB) for _ in range(n))


def tiled(a, b, least):
    """Greedy string tiling by its definition: the longest unmarked match each time, first by place."""
    ua, ub, out = set(), set(), []
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in ua and j + n not in ub:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (i, j, n)
        if best is None:
            return out
        out.append(best)
        ua.update(range(best[0], best[0] + best[2]))
        ub.update(range(best[1], best[1] + best[2]))


@pytest.mark.parametrize("seed", range(12))
def test_tiles(seed):
    r = random.Random(seed)
    a = [r.randint(0, 3) for _ in range(30)]
    b = [r.randint(0, 3) for _ in range(50)] + a[5:17] + a[:4]
    assert tiling.tiles(a, b, 3) == tiled(a, b, 3)
    known = tiling.WordHashes()
    x, y = (known.of([f"w{m}" for m in s]) for s in (a, b))
    assert [(i, n) for i, _, n in tiling.covered(x, y, 3)] == [(i, n) for i, _, n in tiled(a, b, 3)]


def test_very_long_and_repetitive_texts():
    """Time grows with the text, not with the number of matching pairs of places."""
    known = tiling.WordHashes()
    item = known.of(["of"] * 60)
    began = time.perf_counter()
    assert [n for *_, n in tiling.covered(item, known.of(["of"] * 200_000), 4)] == [60]
    mixed = known.of((["of"] * 7 + ["x"]) * 20_000)
    assert sum(n for *_, n in tiling.covered(item, mixed, 4)) == 60
    assert time.perf_counter() - began < 5


def test_very_long_text(spark):
    item = text(30)
    long = " ".join(text(1000) for _ in range(200))
    words = item.split()
    moved = " ".join([*words[15:], long, *words[:15]])
    assert leaks(spark, [(1, long), (2, f"{long} {item} {long}"), (3, moved)], [(7, item)]) == [(2, 7, 1.0), (3, 7, 1.0)]


def leaks(spark, docs, items, **more):
    d = spark.createDataFrame([(k, t, 0.5) for k, t in docs], "doc_id long, text string, coverage double").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((r.doc_id, r.item_id, round(r.coverage, 6)) for r in tiling.leaks(d, i, **more).collect())


@pytest.mark.parametrize("block", [60, 1_000_000])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(tiling, "SEED_BLOCK", block)
    items = [(i, text(RNG.randint(12, 40))) for i in range(12)] + [(20, None), (21, ""), (22, "v1 v2"), (23, "!!")]
    docs = []
    for i in range(40):
        parts = [text(RNG.randint(0, 40))]
        if i % 2:
            w = items[i % 12][1].split()
            cut = len(w) // 2
            parts += {1: [" ".join(w)], 3: [" ".join(w[cut:]), text(8), " ".join(w[:cut])], 5: [" ".join(w[: len(w) // 3])], 7: [" ".join(w).upper() + "!"]}[i % 8]
        docs.append((i, " ".join([*parts, text(5)])))
    docs += [(90, None), (91, ""), (92, "x"), (1, docs[1][1])]
    want = []
    for k, t in docs:
        for n, x in items:
            a, b = tiling.words(x), tiling.words(t)
            if a and b:
                c = sum(m for *_, m in tiled(a, b, min(len(a), tiling.MIN_TILE)))
                if c >= tiling.COVERAGE * len(a):
                    want.append((k, n, round(c / len(a), 6)))
    assert leaks(spark, docs, items) == sorted(want) and want


def test_empty_sides(spark):
    assert leaks(spark, [], [(1, "a b c d e")]) == [] == leaks(spark, [(1, "a b c d e")], [])


def test_query(spark, sf):
    bench = {r.item_id: tiling.words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        own = " ".join(tiling.words(r.text))
        want |= {(r.doc_id, i) for i, w in bench.items() if f" {' '.join(w)} " in f" {own} "}
    got = {(r.doc_id, r.item_id) for r in queries.op9_tiling(spark, sf).collect()}
    assert want <= got
