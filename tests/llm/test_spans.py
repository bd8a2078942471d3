import random
import re
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import queries, spans

RNG = random.Random(5)
VOCAB = [f"w{i}" for i in range(900)]


def sentence(n):
    return " ".join(RNG.choice(VOCAB) for _ in range(n)).capitalize() + "."


def prose(n):
    return " ".join(sentence(RNG.randint(4, 14)) for _ in range(n))


def sentences(text):
    """The sentences of a text as lists of words, by a plain reading of lines and of marks before white space."""
    return [s.split() for line in text.split("\n") for s in re.split(r"(?<=[.!?])\s+|(?<=[.!?][\"')\]])\s+", line) if s.split()]


def sentence_places(text):
    """(first word, word after the last) of the span from each sentence."""
    parts, at, out = sentences(text), 0, []
    for i in range(len(parts)):
        j, n = i, 0
        while j < len(parts) and (j - i < 3 or n < 20):
            n += len(parts[j])
            j += 1
        if j - i >= 3 and n >= 20:
            out.append((at, at + n))
        at += len(parts[i])
    return out


def run_places(text):
    """The runs of 25 words from each place where the hash of four words is the least of 24 in a row, window by window."""
    words = text.split()
    hashes = [spans._words()[w] for w in words]
    grams = [int(x) for x in spans.word_runs(spans.np.array(hashes, spans.np.uint64), 4)] if len(words) >= 4 else []
    chosen = set()
    for i in range(len(grams) - 23):
        chosen.add(min(range(i, i + 24), key=lambda j: (grams[j], j)))
    return [(i, i + 25) for i in sorted(chosen) if i + 25 <= len(words)]


def brute(rows, runs=True):
    """What is left of each (key, text): the words of every occurrence of a span but the first go."""
    seen, gone = {}, {}
    for k, t in sorted({(k, t) for k, t in rows if t}, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = t.split()
        for a, b in sorted({*sentence_places(t), *(run_places(t) if runs else ())}):
            first = seen.setdefault(tuple(words[a:b]), (k, t, a, b))
            if first != (k, t, a, b):
                gone.setdefault((k, t), set()).update(range(a, b))
    return {(k, t): " ".join(w for i, w in enumerate(t.split()) if i not in gone.get((k, t), ())) for k, t in rows if t}


def run(spark, rows, **more):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, span_key string, n_units int").repartition(3)
    return [(r.doc_id, r.text, r.n_removed, r.chars_removed) for r in spans.dedup(docs, **more).collect()]


@pytest.mark.parametrize("runs", [False, True])
@pytest.mark.parametrize("group", [300, 10**6])
def test_against_brute_force(spark, monkeypatch, runs, group):
    monkeypatch.setattr(spans, "GROUP_CHARS", group)
    rng = random.Random(2)
    passages = [prose(7) for _ in range(4)] + [sentence(60), "Yes. No. Why? 'Well.' Said who! " * 3]
    rows = []
    for i in range(60):
        parts = [prose(rng.randint(1, 4))]
        for p in rng.sample(passages, rng.randint(0, 2)):
            parts += [p, prose(1)]
        rows.append((i, rng.choice([" ", "\n", " \n\n "]).join(parts)))
    rows += [(100, rows[3][1]), (101, None), (102, ""), (103, "of. " * 90), (104, "short. text."), (105, " \n "), (106, "\x01 odd \x01\nword. " * 9)]
    want = brute(rows, runs)
    got = {k: t for k, t, *_ in run(spark, rows, runs=runs)}
    assert len(got) == len(rows) and got[101] is None and got[102] == "" and got[105] == " \n "
    assert {k: " ".join(t.split()) for k, t in got.items() if t is not None} == {k: " ".join(want.get((k, t), t).split()) for k, t in rows if t is not None}
    texts = dict(rows)
    for k, t, n, chars in run(spark, rows, runs=runs):
        assert n == len((texts[k] or "").split()) - len((t or "").split()) and chars == len(texts[k] or "") - len(t or "")


def test_sentences_go_whole(spark):
    """The first path removes whole sentences, and leaves all others as they stand."""
    shared = [sentence(9) for _ in range(4)]
    rows = [(i, f"{sentence(12)}  {' '.join(shared)}\n{sentence(7)} {sentence(8)}") for i in range(3)]
    got = {k: t for k, t, *_ in run(spark, rows, runs=False)}
    assert got[0] == rows[0][1]
    for i in (1, 2):
        assert got[i] == rows[i][1].replace(" ".join(shared), "") and got[i].count("\n") == 1


def test_long_passage_goes_everywhere_but_first(spark):
    passage = " ".join(sentence(n) for n in (9, 30, 12, 22))
    alone = [prose(5) for _ in range(8)]
    rows = [(i, f"{a}\n{passage}\n{prose(3)}") for i, a in enumerate(alone)]
    got = {k: t for k, t, *_ in run(spark, rows)}
    assert passage in got[0]
    for i in range(1, 8):
        assert passage.split()[10] not in got[i].split("\n")[1] and alone[i] in got[i]
        assert " ".join(passage.split()[10:-10]) not in " ".join(got[i].split())


def test_rows_of_one_key_and_of_none(spark):
    """Rows that repeat key and text are one document; other texts of a key, or of no key, are documents of their own."""
    a, b = prose(6), prose(6)
    rows = [(1, a), (1, a), (1, b), (2, a), (None, b), (None, prose(5)), (None, b)]
    got = sorted(((k, t) for k, t, *_ in run(spark, rows)), key=repr)
    # Null comes first, so b stays there, in both of its rows, and goes elsewhere.
    assert got == sorted([(1, a), (1, a), (1, ""), (2, ""), (None, b), rows[5], (None, b)], key=repr)


def test_clean(spark):
    rows = [(i, prose(6)) for i in range(20)] + [(None, prose(6)), (None, prose(6))]
    got = run(spark, rows)
    assert {(k, t) for k, t, *_ in got} == set(rows) and all(n == 0 for *_, n, _ in got)


def test_one_pass_over_the_texts(spark, sf):
    """Spans are sought once: both joins of the plan read the same shuffles."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    done = spans.dedup(docs)
    done.collect()
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan[: plan.find("== Initial Plan ==")].count("MapInArrow ") == 1, plan


def test_empty_table(spark):
    assert spans.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_very_long_text(spark):
    long = " ".join(sentence(RNG.randint(4, 14)) for _ in range(30_000))
    began = time.perf_counter()
    got = {k: t for k, t, *_ in run(spark, [(1, long), (2, f"{long[5000:900_000]} own end."), (3, "a" * 3_000_000)])}
    assert got[1] == long and len(got[2]) < 1000 and got[2].endswith("own end.") and got[3] == "a" * 3_000_000
    assert time.perf_counter() - began < 60


def test_query_removes_repeats(spark, sf):
    got = queries.op4_spans(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.length("text").alias("n"))
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count() and all(len(r.text) + r.chars_removed == r.n for r in rows)
    again = spans.dedup(got.select("doc_id", "text"))
    assert again.agg(F.sum("chars_removed")).first()[0] < 0.05 * sum(r.chars_removed for r in rows) + 1


def test_no_shared_run_of_48_words_is_left(spark):
    """Passages of 48 words or more, set mid-sentence into other texts, against a search for equal runs of 48 words."""
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(4000)]

    def words(n):
        return [rng.choice(vocab) + rng.choice(["", "", "", "", "", "", "", "", "."]) for _ in range(n)]

    passages = [["of"] * 60, [rng.choice(vocab) for _ in range(48)]] + [words(rng.randint(48, 90)) for _ in range(120)]
    rows = []
    for i in range(3):
        for j, p in enumerate(passages):
            parts = (" ".join(x) for x in (words(rng.randint(1, 60)), p, words(rng.randint(1, 60))))
            rows.append((1000 * i + j, rng.choice([" ", " ", "\n"]).join(parts)))
    left = {}
    for k, t, *_ in run(spark, rows):
        w = t.split()
        for at in range(len(w) - 47):
            left.setdefault(tuple(w[at : at + 48]), set()).add(k)
    assert not [ks for ks in left.values() if len(ks) > 1]
    assert {k for ks in left.values() for k in ks} >= set(range(1, len(passages)))


def test_a_common_span_is_sent_once_a_partition():
    """Of many batches that hold one passage, only the first sends it by its hash, unless a later one has a smaller key."""
    passage = " ".join(f"word{i}" for i in range(60)) + "."
    batches = [pa.RecordBatch.from_pydict({"key": pa.array([k], pa.int64()), "mark": pa.array([0], pa.int64()), "text": [passage]}) for k in (5, 6, 7, 3, 4, None, 8)]
    out = [(b.column(0)[i].as_py(), b.column(4)[i].as_py()) for b in spans._span_rows(iter(batches), True) for i in range(b.num_rows)]
    assert {k for k, again in out if not again} == {5, 3, None} and {k for k, again in out if again} == {6, 7, 4, 8}
