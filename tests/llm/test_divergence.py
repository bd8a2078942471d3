"""The source divergence audit against a brute force in Python's whole numbers, and its SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import divergence, queries

SCHEMA = "doc_id long, text string, lang string, source string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least_docs=3, top=200):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text or ""))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [(s, w) for a, s, w in docs if a == lang]
        df = Counter(t for _, w in mine for t in set(w))
        kept = [t for t in df if df[t] >= least_docs]
        n = defaultdict(Counter)
        for s, w in mine:
            n[s].update(t for t in w if df[t] >= least_docs)
        whole = sum(n.values(), Counter())
        p = lambda c, t: 1 + 1_000_000_000 * (c[t] + 1) // (c.total() + len(kept))
        share = {s: {t: p(n[s], t) for t in kept} for s in n}
        all_ = {t: p(whole, t) for t in kept}
        for s in n:
            pair = [(sum((share[s][t] - share[h][t]) ** 2 // share[h][t] for t in kept), h) for h in n if h != s]
            term = [((share[s][t] - all_[t]) ** 2 // all_[t], t) for t in kept if n[s][t] and share[s][t] > all_[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found[:most], 1)]
    return sorted(out)


def _rows(seed, sources, n):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "kmé" for b in "aeß" for c in "xyz日"] + ["THE", "the", "a1b", "Don't", "ÉT"]
    text = lambda: " ".join(rng.choice(words[: rng.choice([5, 12, 40])]) for _ in range(rng.randrange(1, 30)))
    rows = [(rng.choice([None, i, i // 2]), rng.choice([None, "", "...\x00\x7f", text(), text(), text(), text()]), rng.choice(["en", "de", None, "", "en"]), rng.choice(sources)) for i in range(n)]
    rows += [(1, "only here", "xx", "one"), (2, None, "yy", "no words"), (3, "", "yy", "none either"), (4, "word " * 40_000 + "x" * 100_000 + " the", "en", sources[0])]
    return rows + rows[:20]


@pytest.mark.parametrize(("sources", "how"), [(["s1", "S1", None, "", "é", "日"], {}), (["s1", "S1", None, "", "é"], {"heavy": 2, "most": 1, "least_docs": 1}), ([f"s{i}" for i in range(13)], {"heavy": 4, "tile": 4, "block": 3, "top": 5}), ([f"s{i}" for i in range(7)], {"heavy": 0, "tile": 3, "block": 2}), (["a", "b", "c"], {"heavy": 100})])
def test_audit_is_exact(spark, sources, how):
    """With nulls, empty and very long texts, ties, repeated rows, clashing columns; with several tiles and blocks, and with
    all terms heavy or light."""
    rows = _rows(len(sources), sources, 160)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", term string, n int").repartition(4)
    got = divergence.audit(docs, **how)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, **{k: v for k, v in how.items() if k in ("least_docs", "top")})


def test_shares_of_counts_beyond_32_bits(spark):
    n = [(10**13, 10**13 + 5, 3), (0, 10**15, 10**6), (7, 9, 1)]
    got = spark.createDataFrame(n, "c long, n long, v long").select(divergence._share(F.col("c"), F.col("n"), F.col("v")).alias("p"))
    assert [r["p"] for r in got.collect()] == [1 + 10**9 * (c + 1) // (m + v) for c, m, v in n]


def test_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = "Alpha beta-gamma  delta1epsilon É日 zeta" * 3
    assert [w.decode() for words in divergence.terms(text) for w in words] == re.findall(r"[a-zÉ日]+", lowered(text))


def test_a_partition_holds_bounded_terms():
    rows = [("en", "s", f"{chr(97 + i % 26)}{chr(97 + i // 26)} the") for i in range(400)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("lang", "source", "text"), r, strict=True)) for r in rows])
    out = [b.to_pylist() for b in divergence._counted(iter([batch]), 50)]
    assert max(map(len, out)) <= 53
    total = Counter()
    for r in (r for b in out for r in b):
        total[r["term"]] += r["docs"]
    assert total["the"] == 400 and total[""] == 0


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_is_its_sql(spark, tmp_path):
    rows = [(*r, 0) for r in _rows(5, [f"s{i}" for i in range(20)], 300)]
    spark.createDataFrame(rows, SCHEMA + ", n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_divergence(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"select {', '.join(got.columns)} from ({queries.OP11_SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
