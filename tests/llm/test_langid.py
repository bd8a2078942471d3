import math
import random
import unicodedata
from collections import Counter

import numpy as np
import pytest

from tessera.llm import langid, queries


def bucket(gram):
    """The feature of an n-gram of code points, number by number."""
    h = 0
    for n, c in enumerate(gram, 1):
        h = (h * 0x01000193 + ord(c) + n) % 2**32
    h = h * 0x9E3779B1 % 2**32
    h ^= h >> 15
    return (h * 0x85EBCA6B % 2**32) >> 16


def grams(text):
    flat = "".join(c.lower()[0] if c.isalpha() else c if unicodedata.category(c)[0] == "M" else " " for c in text)
    flat = f" {' '.join(flat.split(' '))} "
    while "  " in flat:
        flat = flat.replace("  ", " ")
    return Counter(bucket(flat[i : i + n]) for n in langid.ORDERS for i in range(len(flat) - n + 1) if flat[i : i + n] != " ")


def brute(rows, texts):
    """Naive Bayes by its definition, in plain numbers."""
    langs = sorted({x for _, x in rows if x is not None})
    seen = {x: sum((grams(t or "") for t, y in rows if y == x), Counter()) for x in langs}
    prior = {x: math.log(sum(y == x for _, y in rows) / sum(y is not None for _, y in rows)) for x in langs}
    out = []
    for t in texts:
        if not any(c.isalpha() for c in t or ""):
            out.append(("und", 0.0))
            continue
        total = {x: prior[x] + sum(n * math.log((seen[x][f] + 1) / (seen[x].total() + langid.BUCKETS)) for f, n in grams(t).items()) / len(langid.ORDERS) for x in langs}
        best = max(langs, key=lambda x: (total[x], [-ord(c) for c in x]))
        out.append((best, 1 / sum(math.exp(total[x] - total[best]) for x in langs)))
    return out


WORDS = {"en": "the and of to in that was it he".split(), "de": "der die und in das nicht ein zu für".split(), "fr": "le la et à les des un été ça".split()}


def text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", ",", "!?", " 12 "]) for _ in range(n))


@pytest.mark.parametrize("piece", [7, 64, 1 << 18])
def test_against_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(langid, "PIECE", piece)
    rng = random.Random(4)
    rows = [(text(rng, x, rng.randint(1, 9)), x) for x in WORDS for _ in range(12)] + [(None, "de"), ("", "fr"), ("99", "en"), ("the", None)]
    texts = [text(rng, x, rng.randint(1, 30)) for x in WORDS for _ in range(8)] + [None, "", "123 !? 456", "́́", " ́ ", "漢字", "a", "  a  b  ", "İ ΑΣ", "x" * 100 + "  " * 50 + "y", "- the - "]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    want = brute(rows, texts)
    for got in (langid.scores(model, texts), [langid.scores(model, [t])[0] for t in texts]):
        assert [x for x, _ in got] == [x for x, _ in want]
        assert np.allclose([s for _, s in got], [s for _, s in want], atol=1e-4)
    for t in texts:
        got = langid.counts(t or "")
        assert {int(i): int(got[i]) for i in np.flatnonzero(got)} == (dict(grams(t)) if t else {})


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.op6_langid(spark, sf).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r.held_out]
    assert held and sum(docs[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "de"), ("", "en"), ("x", None)], "text string, lang string")
    model = langid.fit(train)
    assert model.langs == ["de", "en"]
    rows = [(1, "und der hund"), (2, "and the dog"), (3, None), (4, ""), (5, "123 !? 456"), (None, "the the"), (1, "und der hund"), (6, "the dog " * 300_000), (7, "漢字"), (8, "́ ̈")]
    docs = spark.createDataFrame([(i, t, "keep", 9.0) for i, t in rows], "doc_id long, text string, predicted string, score double")
    got = langid.predict(docs, model).collect()
    by = {(r.doc_id, (r.text or "")[:20]): (r.lang_pred, r.score) for r in got}
    assert len(got) == len(rows) and all(r.predicted == "keep" for r in got)
    assert by[(1, "und der hund")][0] == "de" and by[(2, "and the dog")][0] == "en" and by[(None, "the the")][0] == "en"
    assert by[(3, "")] == by[(4, "")] == by[(5, "123 !? 456")] == by[(8, "́ ̈")] == ("und", 0.0)
    assert by[(6, ("the dog " * 3)[:20])][0] == "en"
    assert by[(7, "漢字")][0] in ("de", "en")
    assert langid.predict(docs.limit(0), model).collect() == []


def test_no_labels(spark):
    none = spark.createDataFrame([("x", None)], "text string, lang string")
    model = langid.fit(none)
    assert langid.predict(none, model).first().lang_pred == "und"


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGS", 2)
    with pytest.raises(ValueError, match="more than 2"):
        langid.fit(spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "text string, lang string"))


@pytest.mark.parametrize("bound", [1, 50])
def test_bound(spark, bound):
    rows = [(f"text number {i}", "en") for i in range(300)]
    assert langid.fit(spark.createDataFrame(rows, "text string, lang string"), bound=bound).langs == ["en"]
