import hashlib

import corpus_pipeline as cp
from tests.llm.test_bpe import expected
from tests.llm.test_jaccard import grams
from tests.llm.test_langid import brute as languages
from tests.llm.test_spans import brute as passages
from tests.llm.test_tiling import tiled

from tessera.llm import queries, tiling


def test_stages(spark, sf):
    """Each stage against a brute-force version on its own input."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = [docs]
    for _, stage in cp.STAGES:
        done = stage(spark, held[-1], sf)
        held.append(spark.createDataFrame(done.collect(), done.schema))
    assert [d.columns for d in held[1:-1]] == [list(cp.COLUMNS)] * 4
    rows = [{r.doc_id: r for r in d.collect()} for d in held]
    labelled = [(r.text, r.lang) for r in docs.filter(queries.fold("doc_id", 5) != 0).collect()]
    found = dict(zip(rows[0], languages(labelled, [r.text for r in rows[0].values()]), strict=True))
    assert set(rows[1]) == {k for k, (lang, score) in found.items() if lang != "und" and score >= 0.5}
    assert len(rows[1]) > 0.97 * len(rows[0])

    sets = {k: grams(r.text) for k, r in rows[1].items()}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if b < a and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert set(rows[2]) == {k for k in sets if find(k) == k}

    left = passages([(k, r.text) for k, r in rows[2].items()])
    assert set(rows[3]) == {k for k, r in rows[2].items() if left.get((k, r.text), r.text).strip()}
    for k, r in rows[3].items():
        assert r.text.split() == left[(k, rows[2][k].text)].split() and r.n_chars == len(r.text)

    bench = [tiling.words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for k, r in rows[3].items():
        own = tiling.words(r.text)
        known = set(own)  # words that are not in the document can't be covered
        leak = any(w and sum(n for *_, n in tiled(w, own, min(4, len(w)))) >= 0.6 * len(w) for w in bench if sum(x in known for x in w) >= 0.6 * len(w))
        assert (k in rows[4]) != leak
    assert set(rows[5]) == set(rows[4])
    for k, r in rows[5].items():
        ids, text = expected(rows[4][k].text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_run(spark, sf):
    assert cp.run(spark, sf).count() > 0


def test_edges(spark, sf):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the dog and the cat sat there", "en", "s", 3), (3, "der hund und die katze", "de", "s", 3), (3, "der hund und die katze", "de", "s", 3), (4, "123", "de", "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, sf)
    # Of the rows that repeat, one stays; the model learns from the labelled rows outside the held-out fold, German ones only here.
    assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr) == [(3, "der hund und die katze"), (None, "the dog and the cat sat there")]
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, sf).collect() == []


def test_near_duplicates_of_null_and_repeated_ids(spark, sf):
    """Texts, not ids, tell documents apart: unrelated ones of one id all stay, copies of a document go whatever their id."""
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcde")
    rows = [(None, a, "x"), (None, b, "x"), (None, b, "x"), (5, c, "y"), (5, c, "x"), (5, d, "x"), (9, e, "x"), (None, e, "x"), (2, e + " end", "x"), (None, d + " end", "x")]
    docs = spark.createDataFrame([(k, t, "en", s, 3) for k, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = [(r.doc_id, r.text, r.source) for r in cp.near_duplicates(spark, docs, sf).collect()]
    assert sorted(got, key=repr) == sorted([(None, a, "x"), (None, b, "x"), (5, c, "x"), (5, d, "x"), (2, e + " end", "x")], key=repr)
