import hashlib
import random

import pytest

from tessera.llm import jaccard, queries
from tessera.operators import components

RNG = random.Random(3)
VOCAB = [f"t{i}" for i in range(500)]


def text(n):
    return [RNG.choice(VOCAB) for _ in range(n)]


def grams(t):
    w = (t or "").split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, threshold=0.8):
    texts = {}
    for k, t in rows:
        texts.setdefault(t or "", []).append(k)
    ids = {t: min([k for k in ks if k is not None], default=None) for t, ks in texts.items()}
    sets, root, links = {t: grams(t) for t in texts}, {t: t for t in texts}, dict.fromkeys(texts, 0)

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    known = list(texts)
    for i, a in enumerate(known):
        for b in known[:i]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for t in known:
        if ids[t] is not None:
            least[find(t)] = min(least.get(find(t), ids[t]), ids[t])
    return sorted((repr((k, least.get(find(t or "")), ids[t or ""], links[t or ""])) for k, t in rows))


def corpus():
    rows, n = [], 0
    for size in (3, 6, 40, 120, 300):
        base = text(size)
        for edits in (0, 0, 1, 1, 2, 4, 8, 16):
            w = list(base)
            for _ in range(edits):
                w[RNG.randrange(len(w))] = RNG.choice(VOCAB)
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n + i, " ".join(text(RNG.randint(1, 80)))) for i in range(60)]
    return rows + [(900, None), (901, ""), (902, "  "), (3, rows[3][1]), (None, rows[5][1]), (None, "only null keys here now")]


@pytest.mark.parametrize(("chunk", "size"), [(2, 16 << 20), (1024, 16 << 20), (1024, 500)])
def test_against_brute_force(spark, monkeypatch, chunk, size):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    monkeypatch.setattr(jaccard, "CHUNK_BYTES", size)
    rows = corpus()
    docs = spark.createDataFrame([(k, t, b"x", 1) for k, t in rows], "doc_id long, text string, sig binary, band int").repartition(4)
    got = sorted(repr((r.doc_id, r.class_id, r.text_id, r.n_links)) for r in jaccard.join(docs).collect())
    assert got == brute(rows)


def test_pruning_bounds():
    """A pair at the threshold is dropped with at most about the tolerance."""
    from math import comb

    for m, k in jaccard.least_equal(0.8):
        below = sum(comb(m, i) * 0.8**i * 0.2 ** (m - i) for i in range(k))
        assert 0 < k <= m and below < 1e-5
    assert jaccard.least_equal(0.8)[-1][1] > 0.4 * jaccard.N_HASHES


def test_empty(spark):
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 101), (101, 100), (102, 102), (None, 1), (103, 30)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys([*range(31), 103], 0), 100: 100, 101: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_query_agrees_with_its_sql(spark, sf):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    got = [(r.doc_id, r.class_id, r.text_id, r.n_links) for r in queries.op10_jaccard(spark, sf).collect()]
    assert sorted(got) == sorted(con.execute(queries.OP10_SQL).fetchall())


def test_classes_told_apart_without_keys(spark):
    """Unrelated texts under null keys, or under one key, share class_id but no class."""
    a, b, c, d = (" ".join(text(40)) for _ in range(4))
    near = a + " end"
    rows = [(None, a), (None, near), (None, b), (7, c), (7, d), (None, d)]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    classes = {}
    for r in got:
        classes.setdefault(bytes(r.class_digest), set()).add(bytes(r.digest))
    digest = {t: hashlib.md5(t.encode()).digest() for _, t in rows}
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, [{digest[a], digest[near]}, {digest[b]}, {digest[c]}, {digest[d]}]))
    assert all(k in v for k, v in classes.items())


@pytest.mark.parametrize(("size", "chunks"), [(16 << 20, 1), (8 * 4000, 10), (8, 20)])
def test_groups_are_bounded_by_bytes(spark, monkeypatch, size, chunks):
    """Long texts of one bucket are dealt to chunks, a text each at most; every two meet once."""
    monkeypatch.setattr(jaccard, "CHUNK_BYTES", size)
    sig = bytes(4 * jaccard.N_HASHES)
    texts = spark.createDataFrame([(i.to_bytes(16, "big"), 2000, sig) for i in range(20)], "text_id binary, size int, sig binary")
    rows = [r for r in jaccard.members(texts).collect() if r["at"] == 0]
    groups = {}
    for r in rows:
        groups.setdefault((r.x, r.y), {})[bytes(r.text_id)] = r.own
    assert max(r.y for r in rows) < chunks and len({(r.text_id, r.x, r.y) for r in rows}) == len(rows) == 20 * chunks
    assert chunks == 1 or max(map(len, groups.values())) < 20
    met = [frozenset((a, b)) for (x, y), g in groups.items() for a in g for b in g if a < b and (x == y or g[a] != g[b])]
    assert len(met) == len(set(met)) == 190


def test_very_long_texts(spark):
    """Texts of a hundred thousand words are compared whole: one word in a hundred changed, or every third."""
    words = text(100_000)
    near, far = list(words), list(words)
    near[::100], far[::3] = ["other"] * 1000, ["other"] * len(far[::3])
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far)), (4, "x" * 1_000_000), (5, "x " * 300_000), (6, "x " * 300_001)]
    got = sorted(repr((r.doc_id, r.class_id, r.text_id, r.n_links)) for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows) and repr((2, 1, 2, 1)) in got
