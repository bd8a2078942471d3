"""Substring dedup by sliding sentence spans.

A sentence ends at . ! ? (and what closes after it) before white space, at a line end, and at the end of the text. From every
sentence a span runs over the next ones until it holds SENTENCES sentences and LEAST_WORDS words; its hash covers its words.
Spans of all documents are joined by hash: every occurrence but the first (smallest document, then place) is repeated, and
the sentences that it covers are removed.

That finds passages of whole sentences. A passage that begins or ends inside sentences, or has long ones, may hold too few
whole ones, so a second path (`runs=True`, the default) hashes runs of RUN words too. A run starts where the hash of four
words is the least of WINDOW in a row, a choice that depends on these words alone, so two texts choose alike in what they
share: any passage of WINDOW + RUN - 1 = 48 words has a run, wherever it stands and whatever stands around it, and the runs
that start in a longer one cover it without gaps but for 23 words at either end at most.

Places are numbers of words, so both paths go through one join, and one row a span crosses one shuffle, once. Within a
batch of documents, all but the first occurrence of a span are repeated whatever other batches hold; they travel by their
place, and only the first one travels by its hash. What a partition's earlier batches had is remembered in a table of
SEEN spans (a later span takes the slot of an older one), so a very common span sends about a row a partition to one task,
not a row an occurrence. Hashes have 64 bits: of n spans about n * n / 2 ** 65 pairs are taken for equal that are not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import free_name, release, text_batches, width
from tessera.llm.shingles import WordHashes, mixed, runs as word_runs

SENTENCES, LEAST_WORDS = 3, 20
RUN, WINDOW, GRAM = 25, 24, 4
#: Characters of text that are handled at once, more only where one document is longer.
GROUP_CHARS = 1_000_000
#: Spans that a partition remembers, a power of two.
SEEN = 1 << 17

_WORD = re.compile(r"\S+")
_LINE, _END = "\x01", np.uint64(1)
_CLOSERS = "\"')]}»”’"


class _Words(WordHashes):
    """Hash of each word; its lowest bit says whether the word ends a sentence."""

    def __missing__(self, word: str) -> int:
        ends = word.rstrip(_CLOSERS)[-1:] in (".", "!", "?")
        h = self[word] = xxhash.xxh3_64_intdigest(word) & ~1 | ends
        return h


@lru_cache(maxsize=1)
def _words() -> _Words:
    return _Words()


def _cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts one after the other: each word's hash, the number of its text, and whether a sentence ends with it."""
    held, sizes = [], []
    for t in texts:
        # A line end is a word of its own for now; a text that has that very word is cut line by line.
        parts = t.replace("\n", f" {_LINE} ").split() if _LINE not in t else [w for line in t.split("\n") for w in (*(_LINE + w if w == _LINE else w for w in line.split()), _LINE)]
        held += parts
        sizes.append(len(parts))
    known = _words()
    line = np.uint64(known[_LINE])
    hashes, owner = known.of(held), np.repeat(np.arange(len(texts)), sizes)
    real = hashes != line
    ends = (hashes & _END).astype(bool)
    # The last real word before a line end, and of each text.
    at = np.maximum.accumulate(np.where(real, np.arange(len(hashes)), -1))
    marks = at[~real]
    ends[marks[(marks >= 0) & (owner[marks] == owner[~real])]] = True
    hashes, owner, ends = hashes[real], owner[real], ends[real]
    if len(ends):
        ends[np.concatenate([owner[1:] != owner[:-1], [True]])] = True
    return hashes, owner, ends


class _Powers:
    """Powers of a number modulo 2^64 and of its inverse, as many as were asked for."""

    def __init__(self, prime: int) -> None:
        self.prime, self.inverse = np.uint64(prime), np.uint64(pow(prime, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, x, np.uint64))]) for x in (self.prime, self.inverse))
        return self.up[:n], self.down[:n]


@lru_cache(maxsize=1)
def _powers() -> tuple[_Powers, _Powers]:
    return _Powers(0x9E3779B97F4A7C15), _Powers(0xC2B2AE3D27D4EB4F)


def _hash(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A number for the words from each first up to each last (exclusive): differences of prefixes of two polynomials."""
    out = (last - first).astype(np.uint64)
    for p in _powers():
        up, down = p.of(len(hashes) + 1)
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes ^ p.prime) * up[:-1])])
        out = mixed(out ^ ((total[last] - total[first]) * down[first]))
    return out


def sentence_spans(owner: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, word after the last) of the span from every sentence that has one."""
    cuts = np.concatenate([[0], np.flatnonzero(ends) + 1])
    i = np.arange(len(cuts) - 1)
    j = np.maximum(np.searchsorted(cuts, cuts[:-1] + LEAST_WORDS), i + SENTENCES)
    i, j = i[j < len(cuts)], j[j < len(cuts)]
    first, last = cuts[i], cuts[j]
    one = owner[first] == owner[last - 1] if len(first) else np.empty(0, bool)
    return first[one], last[one]


def run_spans(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, word after the last) of every run that is chosen."""
    grams = word_runs(hashes, GRAM)
    if len(grams) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(grams, WINDOW).argmin(axis=1) + np.arange(len(grams) - WINDOW + 1)
    inside = owner[: len(least)] == owner[WINDOW + GRAM - 2 :]
    first = np.unique(least[inside])
    first = first[first + RUN <= len(owner)]
    first = first[owner[first] == owner[first + RUN - 1]]
    return first, first + RUN


def spans(texts: list[str], runs: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, first word in it, words, hash) of each span of each text."""
    hashes, owner, ends = _cut(texts)
    if not len(hashes):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    first, last = sentence_spans(owner, ends)
    if runs:
        first, last = (np.concatenate(x) for x in zip((first, last), run_spans(hashes, owner), strict=True))
    # A run may be a span of sentences too: once is enough.
    _, once = np.unique((first << 32) | (last - first), return_index=True)
    first, last = first[once], last[once]
    begin = np.searchsorted(owner, np.arange(len(texts)))
    of = owner[first]
    return of, first - begin[of], last - first, _hash(hashes, first, last)


def _order(keys: pa.Array, marks: pa.Array) -> np.ndarray:
    """The place of each row among (key, mark), nulls first; equal ones share it."""
    at = pc.sort_indices(pa.table({"k": keys, "m": marks}), sort_keys=[("k", "ascending"), ("m", "ascending")], null_placement="at_start").to_numpy()
    rows = list(zip(keys.to_pylist(), marks.to_pylist(), strict=True))
    new = np.array([i > 0 and rows[at[i]] != rows[at[i - 1]] for i in range(len(at))])
    out = np.empty(len(at), np.int64)
    out[at] = np.cumsum(new)
    return out


def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most GROUP_CHARS characters, or of one row."""
    sizes = np.asarray(pc.fill_null(pc.utf8_length(batch.column(2)), 0))
    start = held = 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > GROUP_CHARS:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


class _Seen:
    """The first occurrences that a partition has sent, by a slot for each hash: what is forgotten is only sent again."""

    def __init__(self) -> None:
        self.span, self.place, self.mark = (np.zeros(SEEN, np.int64) for _ in range(3))
        self.key, self.used = np.full(SEEN, None, object), np.zeros(SEEN, bool)

    def later(self, span: np.ndarray, row: np.ndarray, place: np.ndarray, keys: list, marks: list) -> np.ndarray:
        """Which occurrences of spans come after one that was sent; the others are remembered."""
        slot, out = span & (SEEN - 1), np.zeros(len(span), bool)
        key, mark = np.array([*keys, None], object)[:-1], np.array(marks, np.int64)
        known = self.used[slot] & (self.span[slot] == span)
        told = lambda k, m, p: ((k is not None, k), m, p)  # noqa: E731 - nulls first
        for i in np.flatnonzero(known).tolist():
            s, r = slot[i], row[i]
            out[i] = told(self.key[s], self.mark[s], self.place[s]) < told(key[r], mark[r], place[i])
        new = ~out
        s, r = slot[new], row[new]
        self.span[s], self.place[s], self.mark[s], self.key[s], self.used[s] = span[new], place[new], mark[r], key[r], True
        return out


def _span_rows(batches: Iterator[pa.RecordBatch], runs: bool) -> Iterator[pa.RecordBatch]:
    seen = _Seen()
    for batch in batches:
        for b in _groups(batch):
            row, first, size, span = spans([t or "" for t in b.column(2).to_pylist()], runs)
            if not len(row):
                continue
            place, span = (first << 32) | size, span.view(np.int64)
            rank = _order(b.column(0), b.column(1))[row]
            order = np.lexsort((place, rank, span))
            row, place, span, rank = row[order], place[order], span[order], rank[order]
            start = np.concatenate([[True], span[1:] != span[:-1]])
            head = np.maximum.accumulate(np.where(start, np.arange(len(span)), 0))
            again = (rank != rank[head]) | (place != place[head])
            heads = np.flatnonzero(~again)
            again[heads] = seen.later(span[heads], row[heads], place[heads], b.column(0).to_pylist(), b.column(1).to_pylist())
            route = np.where(again, mixed((row.astype(np.uint64) << np.uint64(40)) ^ place.view(np.uint64) ^ span.view(np.uint64)).view(np.int64), span)
            at = pa.array(row)
            for i in range(0, len(row), 10_000):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at[i : i + 10_000]), b.column(1).take(at[i : i + 10_000]), *(pa.array(x[i : i + 10_000]) for x in (place, route, again))],
                    ["key", "mark", "place", "route", "again"],
                )
    release()


def repeated(rows: DataFrame, runs: bool = True) -> DataFrame:
    """key, mark, gone for rows of key, mark (tells rows of one key apart), text: of each document with repeated spans, an
    array of places, each the number of words before it times 2^32 plus its words."""
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), *T._parse_datatype_string("mark long, place long, route long, again boolean").fields])
    found = rows.select("key", "mark", "text").mapInArrow(lambda b: _span_rows(b, runs), schema).repartition(width(rows), "route")
    first = F.rank().over(Window.partitionBy("route", "again").orderBy("key", "mark", "place")) == 1
    return found.withColumn("first", first).filter("again or not first").groupBy("key", "mark").agg(F.collect_list("place").alias("gone"))


def without(text: str, places: list[int]) -> tuple[str, int]:
    """A text less the words at these places and the white space after each, and how many words those are. A line that ended
    with removed words ends all the same; a text without a word left is empty."""
    at = [m.span() for m in _WORD.finditer(text)]
    ranges: list[list[int]] = []
    for p in sorted(set(places)):
        a, b = p >> 32, (p >> 32) + (p & 0xFFFFFFFF)
        if ranges and a <= ranges[-1][1]:
            ranges[-1][1] = max(ranges[-1][1], b)
        else:
            ranges.append([a, b])
    out, done = [], 0
    for a, b in ranges:
        start, stop = at[a][0], at[b][0] if b < len(at) else len(text)
        out.append(text[done:start])
        if "\n" in text[at[b - 1][1] : stop] and not out[-1].rstrip(" \t").endswith("\n"):
            out.append("\n")
        done = stop
    kept = "".join(out) + text[done:]
    return kept if kept.strip() else "", sum(b - a for a, b in ranges)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", runs: bool = True) -> DataFrame:
    """docs with `text` less what is repeated, and n_removed (words), chars_removed.

    One row per row of docs. A null text stays null; an empty one stays empty; a text without a word left becomes empty.
    A span that overlaps its own first occurrence (a word said over and over) is repeated too, so little of such a text
    stays. Rows with one key and one text are one document: all of them keep what it keeps. Null keys come before all
    others. Columns named n_removed or chars_removed are replaced. runs=False leaves the second path out.
    """
    text_batches(docs.sparkSession)
    names = [c for c in docs.columns if c.lower() not in ("n_removed", "chars_removed")]
    # Where no key repeats, as in a table of documents, the mark is constant and costs the shuffle nothing.
    repeats = not docs.groupBy(F.col(key)).agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    mark = F.xxhash64(text) if repeats else F.lit(0).cast("long")
    k, m, g, c = (free_name(docs, x) for x in ("span_key", "span_mark", "span_gone", "span_cut"))
    gone = repeated(docs.select(F.col(key).alias("key"), mark.alias("mark"), F.col(text).alias("text")), runs)
    gone = gone.select(F.col("key").alias(k), F.col("mark").alias(m), F.col("gone").alias(g))

    @F.pandas_udf("kept string, n int")
    def cut(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([without(t, p.tolist()) for t, p in zip(texts, places, strict=True)], columns=["kept", "n"])

    # Only documents with repeated spans reach Python, with nothing of the others queued beside them. Both joins name the
    # same columns, so that Spark shuffles either side once for both.
    held, same = docs.select(*names), F.col(key).eqNullSafe(F.col(k)) & (mark == F.col(m)) & (F.size(g) > 0)
    touched = held.join(gone, same).withColumn(c, cut.asNondeterministic()(F.col(text), F.col(g)))
    removed = (F.length(text) - F.length(f"{c}.kept")).cast("long")
    done = touched.select(*[F.col(f"{c}.kept").alias(x) if x == text else F.col(x) for x in names], F.col(f"{c}.n").alias("n_removed"), removed.alias("chars_removed"))
    rest = held.join(gone, same, "left_anti").withColumns({"n_removed": F.lit(0), "chars_removed": F.lit(0).cast("long")})
    return done.unionByName(rest).coalesce(width(docs))
