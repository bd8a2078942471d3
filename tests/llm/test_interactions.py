"""The filter interaction audit against a brute force that applies the filters one after the other."""

import random
import re
from itertools import permutations

import duckdb
import pytest

from tessera.llm import interactions, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string"


def _conditions(rows):
    """What each row fails, by the contract's words."""
    for doc_id, text, lang in rows:
        text = text or ""
        words = WORD.findall(text)
        out = set()
        if len(words) < 100:
            out.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            out.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
            out.add("C")
        if re.search(r"[#$%&*|]", text):
            out.add("D")
        if doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in rows):
            out.add("E")
        yield doc_id, lang or "", out


def brute(rows, labels):
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, t in labels if t == 1 and d is not None}
    judged, out = list(_conditions(rows)), {}
    for part in {lang for _, lang, _ in judged}:
        mine = [(d, f) for d, lang, f in judged if lang == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                earlier = [x for x in mine if letter in x[1] and x not in left]
                left = [x for x in left if letter not in x[1]]
                total[letter] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(earlier), sum(x[1] == {letter} for x in mine), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


def _rows(seed):
    rng = random.Random(seed)
    texts = ["", None, "a b c", " ".join(f"w{i}" for i in range(120)), " ".join(["same"] * 150), "LOUD TEXT HERE", "50% off | # now", " ".join(f"É{i}\x85x" for i in range(99)), "x" * 50_000 + " A" * 30_000, "a\x0bb\x1cc\xa0d"]
    texts += [" ".join(f"w{rng.randrange(200)}" for _ in range(rng.randrange(60, 200))) for _ in range(10)]
    return [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(70)]


def _labels(seed):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(45)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(30)]


@pytest.mark.parametrize("how", [{}, {"hashed": lambda raw: 7}, {"hashed": lambda raw: len(raw) % 2, "chain_bytes": 1}])
def test_audit_is_that_of_the_filters_one_after_the_other(spark, how):
    """With nulls, empty and very long texts, ties, repeated rows, extra columns; with texts that share a hash, and chains
    that go on row by row."""
    rows, labels = _rows(len(how)), _labels(3)
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", part string, mask int, n int").repartition(5)
    got = interactions.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), **how)
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) == 600 * len({lang or "" for _, _, lang in rows})
    assert set(found) == brute(rows, labels)


def test_copies_leave_a_partition_without_their_text():
    rows = [(i, "the same text " * 100, "en") for i in range(1000)]
    out = list(interactions._routed(iter(rows[::-1]), [], interactions.digest, 1 << 20))
    assert [key for (_, _, _), (raw, key, _, _) in out if raw] == [0]
    assert len(out) == 1000


def test_strings_as_keys(spark):
    docs = spark.createDataFrame([("b", "t", "en"), ("a", "t", "en"), ("é", "t", "en")], "doc_id string, text string, lang string")
    got = {(r["key"], r["mask"]) for r in interactions.masks(docs, filters={}).collect()}
    assert got == {("a", 0), ("b", 1), ("é", 1)}


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interactions.audit(spark.createDataFrame([], SCHEMA), labels).collect() == []
    one = interactions.audit(spark.createDataFrame([(1, None, None)], SCHEMA), labels).collect()
    assert len(one) == 600 and {r["part"] for r in one} == {""} and {r["kept"] for r in one if r["step"] == 5} == {0}


def test_query_is_its_sql(spark, tmp_path):
    rows = [(d, t, lang, "s", 0) for d, t, lang in _rows(11)]
    spark.createDataFrame(rows, SCHEMA + ", source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(_labels(5), "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op12_interactions(spark, str(tmp_path))
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(f"select {', '.join(got.columns)} from ({queries.OP12_SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
