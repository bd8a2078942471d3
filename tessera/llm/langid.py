"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, every run of characters that are not letters (or marks on them) becomes one space, and the 1- to
4-grams of code points (spaces included, so word edges count) are hashed into BUCKETS features. Training counts features per
language; the log-probability matrix (BUCKETS x languages floats) is broadcast; texts are scored in groups of bounded size
as sparse rows: for each order one take of the matrix rows of all n-grams of the group, one sum by text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import batched, free_name, hash_bound, text_batches

BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
#: Labelled rows that the model is fitted on, at most: the bound of the training sample, per language.
SAMPLE_PER_LANG = 4000
#: Languages of a model, at most: bounds the matrix, which is broadcast, at 64 MB.
MOST_LANGS = 256
#: Characters handled at once. A longer text is taken piece by piece, whole, with the n-grams across the cuts.
PIECE = 1 << 18
_MIX = np.uint32(0x9E3779B1)


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the lower-case letter, the mark, or a space; whether it is a letter."""
    table, letter = np.full(0x110000, 32, np.uint32), np.zeros(0x110000, bool)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            table[cp], letter[cp] = ord(c.lower()[0]), True
        elif unicodedata.category(c)[0] == "M":
            table[cp] = cp
    return table, letter


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of the normalised texts, each between two spaces; the number of the text of each; letters of each text)."""
    table, letter = _letters()
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    whole, of = np.full(len(raw) + 2 * len(texts), 32, np.uint32), np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    whole[np.arange(len(raw)) + 2 * owner + 1] = table[raw]
    keep = np.ones(len(whole), bool)
    keep[1:] = (whole[1:] != 32) | (whole[:-1] != 32) | (of[1:] != of[:-1])
    return whole[keep], of[keep], np.bincount(owner[letter[raw]], minlength=len(texts))


def features(cps: np.ndarray, of: np.ndarray, skip: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the hashed n-grams of texts, and the number of the text of each (n-grams of a lone space left out).
    skip: code points at the start that were there before; n-grams that end in them are left out."""
    h = np.zeros(len(cps), np.uint32)
    for n in ORDERS:
        if len(cps) < n:
            return
        h = h[: len(cps) - n + 1] * np.uint32(0x01000193) + cps[n - 1 :] + np.uint32(n)
        mixed = h * _MIX
        mixed ^= mixed >> np.uint32(15)
        x = (mixed * np.uint32(0x85EBCA6B)) >> np.uint32(16)
        inside = of[: len(x)] == of[n - 1 :]
        if n == 1:
            inside &= cps != 32
        inside[: max(0, skip - n + 1)] = False
        yield x[inside], of[: len(x)][inside]


def _pieces(text: str) -> Iterator[tuple[np.ndarray, int, int]]:
    """(code points, how many of them were there before, letters) of a long text piece by piece, as if it were cut nowhere."""
    held, before = np.array([32], np.uint32), 0
    for at in range(0, len(text), PIECE):
        cps, _, n = normalised([text[at : at + PIECE]])
        cps = cps[1:-1] if len(cps) > 1 else cps  # without the spaces around it
        # What is left of one space or none at either end says whether the piece began or ended with one.
        edge = _letters()[0][[ord(text[at]), ord(text[min(at + PIECE, len(text)) - 1])]] == 32
        inner = np.concatenate([[32] if edge[0] and not (len(cps) and cps[0] == 32) else [], cps, [32] if edge[1] and not (len(cps) and cps[-1] == 32) else []]).astype(np.uint32)
        if len(held) and held[-1] == 32 and len(inner) and inner[0] == 32:
            inner = inner[1:]
        last = at + PIECE >= len(text)
        if last and not ((len(inner) and inner[-1] == 32) or (not len(inner) and len(held) and held[-1] == 32)):
            inner = np.concatenate([inner, [np.uint32(32)]])
        whole = np.concatenate([held, inner]).astype(np.uint32)
        yield whole, before, int(n[0])
        held = whole[-(len(ORDERS) - 1) :]
        before = len(held)


def counts(text: str) -> np.ndarray:
    """How often each feature occurs in a text."""
    out = np.zeros(BUCKETS, np.int64)
    for cps, before, _ in _pieces(text):
        for x, _ in features(cps, np.zeros(len(cps), np.int64), before):
            out += np.bincount(x, minlength=BUCKETS)
    return out


@dataclass
class Model:
    langs: list[str]
    matrix: np.ndarray  # BUCKETS x languages, log probabilities
    prior: np.ndarray


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    sums: dict[str, np.ndarray] = {}
    for b in batches:
        for text, lang in zip(b.column(0), b.column(1).to_pylist(), strict=True):
            got = counts(text.as_py() or "")
            sums[lang] = sums[lang] + got if lang in sums else got
    for lang, x in sums.items():
        held = np.flatnonzero(x)
        yield lang, held.tolist(), x[held].tolist()


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", order: str | None = None, bound: int = SAMPLE_PER_LANG) -> Model:
    """A model of the texts of each non-null lang; add-one smoothing, priors by number of rows.

    At most bound rows of each lang are counted, those with the smallest hash of `order` (default: of the text), a sample
    that no one can steer by row order. Rows with a null or empty text, or no letter, add only to the prior. No rows: no
    languages. More than MOST_LANGS values of lang are an error.
    """
    text_batches(labelled.sparkSession)
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(order or text)).alias("h")).filter(F.col("lang").isNotNull())
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGS + 1).collect()}
    if len(totals) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    if not totals:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    # A hash below the share that gives about 0.9 of the bound: no sort and no shuffle of texts; lang by lang.
    last = F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, hash_bound(0.9 * bound / n))])
    taken = rows.filter(F.col("h") <= last[F.col("lang")]).select("text", "lang")
    schema = pa.schema([("lang", pa.string()), ("i", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))])
    parts = taken.mapInArrow(batched(_counts, schema, rows=1), "lang string, i array<int>, n array<long>")
    summed = parts.select("lang", F.explode(F.arrays_zip("i", "n")).alias("x")).select("lang", "x.i", "x.n").groupBy("lang", "i").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(totals)
    table = np.zeros((BUCKETS, len(langs)))
    at = {x: i for i, x in enumerate(langs)}
    table[summed.column("i").to_numpy(), [at[x] for x in summed.column("lang").to_pylist()]] = summed.column("n").to_numpy()
    table += 1.0
    docs = np.array([totals[x] for x in langs], float)
    return Model(langs, np.log(table / table.sum(axis=0)).astype(np.float32), np.log(docs / docs.sum()))


def _added(m: Model, sums: np.ndarray, cps: np.ndarray, of: np.ndarray, skip: int = 0) -> None:
    """Adds the log probabilities of all n-grams of texts to the rows of sums."""
    for x, texts in features(cps, of, skip):
        if len(x):
            starts = np.flatnonzero(np.concatenate([[True], texts[1:] != texts[:-1]]))
            sums[texts[starts]] += np.add.reduceat(m.matrix.take(x, axis=0), starts, axis=0, dtype=np.float64)


def scores(m: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, posterior probability) of each text; ("und", 0) of one without a letter, and by a model without languages."""
    texts = [t or "" for t in texts]
    sums, letters = np.zeros((len(texts), len(m.langs))), np.zeros(len(texts), np.int64)
    group, held = [], 0

    def close() -> None:
        nonlocal held
        if group:
            cps, of, n = normalised([texts[i] for i in group])
            letters[group] = n
            part = np.zeros((len(group), len(m.langs)))
            _added(m, part, cps, of)
            sums[group] = part
            group.clear()
            held = 0

    for i, t in enumerate(texts if m.langs else []):
        if len(t) > PIECE:
            for cps, before, n in _pieces(t):
                letters[i] += n
                _added(m, sums, cps, np.full(len(cps), i), before)
            continue
        if held + len(t) > PIECE:
            close()
        group.append(i)
        held += len(t)
    close()
    if not m.langs:
        return [("und", 0.0)] * len(texts)
    # N-grams of one place overlap: their evidence counts once a character, not once an order.
    total = sums / len(ORDERS) + m.prior
    best = total.argmax(axis=1)
    sure = 1.0 / np.exp(total - total[np.arange(len(texts)), best][:, None]).sum(axis=1)
    return [(m.langs[b], float(s)) if n else ("und", 0.0) for b, s, n in zip(best.tolist(), sure.tolist(), letters.tolist(), strict=True)]


def language(spark: SparkSession, model: Model, text: Column) -> Column:
    """struct<lang_pred, score> of a text column; other columns of the row stay where they are."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def scored(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(scores(shared.value, texts.tolist()), columns=["lang_pred", "score"])

    return scored.asNondeterministic()(text)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred and score: the likeliest language of each whole text and its posterior probability.

    A null or empty text, or one without a letter (marks alone are none), or a model without languages, gives `und` with
    score 0. Every row is answered, repeated ones too; ties go to the first language by name. Columns named lang_pred or
    score are replaced.
    """
    text_batches(docs.sparkSession)
    got = free_name(docs, "predicted")
    held = docs.withColumn(got, language(docs.sparkSession, model, F.col(text)))
    return held.withColumns({"lang_pred": F.col(f"{got}.lang_pred"), "score": F.col(f"{got}.score")}).drop(got)
