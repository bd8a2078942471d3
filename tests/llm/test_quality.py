import math
from types import SimpleNamespace

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import quality_rules, queries


def test_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op8_quality(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_compiled_rules_are_the_model(spark):
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abc XYZ.!|#\n0"), int(rng.integers(1, 200)))) for _ in range(300)]
    y = np.array([("#" * 2 not in t) + 0 for t in texts])
    df = spark.createDataFrame([(i, t, int(v)) for i, (t, v) in enumerate(zip(texts, y, strict=True))], "doc_id long, text string, label int")
    model = quality_rules.fit(df)
    assert model.rules
    stats = {k: [r[0] for r in df.orderBy("doc_id").select(v).collect()] for k, v in quality_rules.statistics(F.col("text")).items()}
    want = np.full(len(texts), model.bias)
    for rule, w in model.rules:
        want += w * np.all([(np.array(stats[f]) <= c) if b else (np.array(stats[f]) > c) for f, b, c in rule.limits], axis=0)
    got = [r.score for r in quality_rules.score(df, model).orderBy("doc_id").collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-want)))


def plain_statistics(t):
    """The statistics of a text, read letter by letter."""
    t = t or ""
    n, words, lines = len(t), t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "), t.split("\n")
    share = lambda chars: sum(c in chars for c in t) / max(n, 1)
    return {
        "log_chars": math.log1p(n), "word_length": n / len(words), "words_a_line": len(words) / len(lines), "symbols": share("#$%&*@^~=+<>|{}[]\\/_`"), "bars": share("|"),
        "upper": share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": share("0123456789"), "stops": share(".?"), "marks": share("!"), "commas": share(",;:"), "quotes": share("\"'()"),
        "distinct_words": len(set(words)) / len(words), "distinct_lines": len(set(lines)) / len(lines), "longest_line": max(map(len, lines)) / max(n, 1), "links": 3 * t.count("://") / max(n, 1),
    }


def test_statistics_and_scores_against_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = [None, "", " ", "\n\n", "a://b http://c", "ß É 漢字 #", "x" * 300_000, "one two one\nthree\n\none"] + ["".join(rng.choice(list("ab Z.!|#\n0,'")) for _ in range(int(rng.integers(1, 60)))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id int, text string, digits int")
    rows = df.select("doc_id", *[v.alias(f"v_{k}") for k, v in quality_rules.statistics(F.col("text")).items()]).collect()
    for r in rows:
        want = plain_statistics(texts[r.doc_id])
        assert all(abs(r[f"v_{k}"] - v) < 1e-9 for k, v in want.items()) and len(want) == len(r) - 1, (texts[r.doc_id], r)
    limits = [(("symbols", True, 0.05),), (("upper", False, 0.1), ("words_a_line", True, 4.0)), (("log_chars", False, 3.0),)]
    model = quality_rules.Model(0.3, [(quality_rules.Rule(x), w) for x, w in zip(limits, (1.5, -2.0, 0.7), strict=True)])
    for r in quality_rules.score(df, model).collect():
        s = plain_statistics(texts[r.doc_id])
        total = 0.3 + sum(w for rule, w in model.rules if all(s[f] <= c if below else s[f] > c for f, below, c in rule.limits))
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-9 and r.digits == 5


def test_splits_against_brute_force():
    """The first split of a tree is the best of all limits of all statistics; its paths part the rows."""
    rng = np.random.default_rng(5)
    x = np.round(rng.random((200, 3)), 2)
    y = ((x[:, 1] > 0.6) ^ (rng.random(200) < 0.1)).astype(float)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, 12)[1:-1])) for c in x.T]
    class All:
        def __getitem__(self, half):
            return range(3)

    every = SimpleNamespace(permutation=lambda n: All())  # all statistics in place of a random half of them
    paths = set()
    quality_rules._grow(x, y, cuts, every, 1, (), paths)

    def error(f, c):
        parts = [y[x[:, f] <= c], y[x[:, f] > c]]
        return sum(((p - p.mean()) ** 2).sum() for p in parts) if min(map(len, parts)) >= quality_rules.LEAF else np.inf

    best = min(((f, c) for f in range(3) for c in cuts[f]), key=lambda fc: error(*fc))
    assert paths == {((best[0], True, best[1]),), ((best[0], False, best[1]),)}


def test_weights_are_those_of_the_lasso():
    """At the optimum the gradient is within the penalty, and equal to it where a weight is not zero."""
    rng = np.random.default_rng(6)
    r = (rng.random((400, 12)) < 0.4).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(-(2 * r[:, 0] - 3 * r[:, 1] + 0.2)))).astype(float)
    penalty = 0.01
    bias, w = quality_rules._lasso(r, y, np.full(400, 1 / 400), penalty)
    gradient = r.T @ ((1 / (1 + np.exp(-(bias + r @ w))) - y) / 400)
    assert abs(((1 / (1 + np.exp(-(bias + r @ w))) - y) / 400).sum()) < 1e-4
    assert np.all(np.abs(gradient) <= penalty + 1e-4) and 2 <= np.count_nonzero(w) < 12
    assert np.allclose(gradient[w != 0], -penalty * np.sign(w[w != 0]), atol=1e-4)


def test_edges(spark):
    model = quality_rules.fit_rules(np.array([[float(i % 2), 0.0] for i in range(400)]), np.array([i % 2 for i in range(400)]), ["symbols", "digits"])
    rows = [(1, None, 7.0), (2, "", 7.0), (3, "x" * 200_000, 7.0), (None, "# # #", 7.0), (1, None, 7.0)]
    out = quality_rules.score(spark.createDataFrame(rows, "doc_id long, text string, stat_symbols double"), model).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 and r.stat_symbols == 7.0 for r in out)
    none = quality_rules.fit(spark.createDataFrame([], "doc_id long, text string, label int"))
    assert none.rules == [] and none.bias == 0.0
    one = quality_rules.fit(spark.createDataFrame([(i, "a", 1) for i in range(100)], "doc_id long, text string, label int"))
    assert one.rules == [] and one.bias > 0
    assert quality_rules.score(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []


def test_samples_of_very_many_rows_are_not_empty():
    """The share of hashes that is taken is as exact as hashes are: at 10^12 labels a bound of 12,000 still keeps some."""
    from tessera.llm.common import hash_bound

    for total in (10**5, 10**9, 10**10, 12 * 10**9, 10**12, 10**15):
        share = (hash_bound(0.95 * 12_000 / total) + (1 << 63) + 1) / (1 << 64)
        assert 0 < share * total <= 12_000 and abs(share * total / 11_400 - 1) < 1e-3
    assert hash_bound(1.0) == hash_bound(7.0) == (1 << 63) - 1 and hash_bound(0) == -(1 << 63)
