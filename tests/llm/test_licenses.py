"""The license scan against a brute force that looks at every word, and its SQL."""

import math
import random
import re

import duckdb
import pytest

from tessera.llm import licenses, queries

SCHEMA = "doc_id long, text string"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(texts, templates=licenses.TEMPLATES, slack=licenses.SLACK):
    held = [words(t) for t in texts]
    weight = {w: 1 + round(1000 * math.log2((len(held) + 1) / (sum(w in x for x in held) + 1))) for t in templates for w in t.words}
    out = []
    for ws in held:
        places = []
        for n, t in enumerate(templates):
            key, own = t.key.split(), set(t.words)
            for i in range(len(ws) - len(key) + 1):
                if ws[i : i + len(key)] == key:
                    near = set(ws[max(0, i - t.at - slack) : max(0, i - t.at + len(t.words) + slack)])
                    score = 1.0 if own == set(key) else sum(weight[w] for w in own & near) / sum(weight[w] for w in own)
                    places.append((t.label, n, t.base, i, len(key), score))
        out.append((len(ws), sorted(places)))
    return out


def _texts(seed):
    rng = random.Random(seed)
    pieces = [t.notice or t.key for t in licenses.TEMPLATES] + ["under", "the", "MIT", "license", "cc", "by", "nc", "version", "Zürich", "K", "İn", "CC BY-NC 4.0", "Apache License, Version 2.0", "\n\n", "a\x7fb", "2", "ſ"]
    texts = [None, "", "...", " under the MIT\n\tlicense", "under the mit license" * 2, "cc by nc by nc", "cc byK nc", "mit " * 30_000 + "under the mit license " * 2000, "x" * 200_000 + " Under-THE-mit?license"]
    for _ in range(40):
        made = " ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12))).split(" ")
        texts.append(" ".join(w for w in made if rng.random() > 0.03))
    return texts + texts[:12]


@pytest.mark.parametrize("rare", [1, 2, 5])
def test_scan_finds_every_place(spark, rare):
    """With nulls, empty and very long texts, repeated rows, letters that lower into ASCII, columns that clash."""
    texts = _texts(rare)
    rows = [(i % 7 if i % 5 else None, t, 1, "x", i) for i, t in enumerate(texts)]
    got = licenses.scan(spark.createDataFrame(rows, SCHEMA + ", N_Words int, license_spots string, row int"), rare=rare)
    assert got.columns == ["doc_id", "text", "license_spots", "row", "n_words", "license_places"]
    found = {r["row"]: (r["n_words"], sorted(tuple(p) for p in r["license_places"])) for r in got.collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts)


def test_indexed_words_are_the_rarest():
    weights = dict.fromkeys("under the mit license".split(), 5) | {"mit": 9, "the": 1}
    assert licenses.index(licenses.TEMPLATES[:1], weights) == [[("mit", 2), ("license", 3)]]


def test_notices_hold_their_keys():
    for t in licenses.TEMPLATES:
        assert t.words[t.at : t.at + len(t.key.split())] == t.key.split()
        assert words(" ".join(t.words)) == t.words


def test_no_python_and_no_shuffle_of_texts(spark, sf):
    plan = queries.op13_licenses(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange|Join", plan)


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_is_its_sql(spark, tmp_path):
    rows = [(i, t, None, "s", 0) for i, t in enumerate(_texts(9)) if t is None or len(t) < 5000]
    spark.createDataFrame(rows, SCHEMA + ", lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_licenses(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"select {', '.join(got.columns)} from ({queries.OP13_SQL})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
