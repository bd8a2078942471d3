"""Filter interaction audit: what each filter of a sequence removes, in every order of the filters.

Every document gets a mask, a bit for each filter that it fails. All but one of the filters look at one text; the last says
whether the table has the same text under a smaller key. For that, documents are routed by the xxhash of their text:

- Before the shuffle each partition keeps a chain a hash of (whole text, smallest key). A document whose key is not the smallest
  of its text is a duplicate for sure, so its key goes on without the text; what is left is one row a text and partition (or
  a row each time that CHAIN_BYTES of texts are held), however many copies there are.
- Partitions are dealt by hash and sorted by (hash, key), so a task holds the chain of one hash at a time: the different texts
  that share all 64 bits. The first row of each text has its smallest key; rows with a larger key are duplicates.

A mask takes 5 bits, so a part (a language) is a vector of 32 counts of documents, good ones and toxic ones. Partitions count
into vectors, combineByKey adds them up, and every order of the filters is read from a part's vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations
from typing import NamedTuple

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import release, scoped, width

#: Bytes of texts that a partition holds in chains before the shuffle; beyond it they go on and new chains begin.
CHAIN_BYTES = 48 << 20


class Facts(NamedTuple):
    """What the filters on one text ask for."""

    words: int
    distinct: int
    capitals: int
    chars: int
    marked: bool


_CAPITALS, _MARKS = bytes(range(65, 91)), b"#$%&*|"

#: The filters on one text by letter, as failure conditions; the letter of the filter on repeated texts comes after them.
FILTERS: dict[str, Callable[[Facts], bool]] = {
    "A": lambda f: f.words < 100,
    "B": lambda f: 100 * f.distinct < 80 * f.words,
    "C": lambda f: 100 * f.capitals > 10 * f.chars,
    "D": lambda f: f.marked,
}
DUPLICATE = "E"


def facts(text: str, raw: bytes) -> Facts:
    """Of a text and its UTF-8 bytes. Words are what ASCII white space (space, tab, LF, VT, FF, CR) parts, as bytes.split has it."""
    words = raw.split()
    return Facts(len(words), len(set(words)), len(raw) - len(raw.translate(None, _CAPITALS)), len(text), len(raw.translate(None, _MARKS)) < len(raw))


def digest(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw)


def _routed(rows: Iterator[tuple], filters: list[Callable], hashed: Callable[[bytes], int], most: int) -> Iterator[tuple]:
    """((hash, 1, key), (text, key, parts, mask)) for each text held, ((hash, 0, 0), (None, key, parts, mask)) for what is decided."""
    held: dict[int, list[list]] = {}
    weight, again = 0, 1 << len(filters)

    def flushed() -> Iterator[tuple]:
        for h, chain in held.items():
            for raw, key, parts, mask in chain:
                yield (h, 1, key), (raw, key, tuple(parts.items()), mask)

    for key, text, part in rows:
        text, part = text or "", part or ""
        raw = text.encode()
        f = facts(text, raw)
        mask = sum(1 << i for i, fails in enumerate(filters) if fails(f))
        h = hashed(raw)
        if key is None:  # neither smaller nor larger than any key
            yield (h, 0, 0), (None, None, ((part, 1),), mask)
            continue
        chain = held.setdefault(h, [])
        link = next((x for x in chain if x[0] == raw), None)
        if link is None:
            chain.append([raw, key, {part: 1}, mask])
            weight += len(raw) + 400
            if weight > most:
                yield from flushed()
                held, weight = {}, 0
        elif key > link[1]:
            yield (h, 0, 0), (None, key, ((part, 1),), mask | again)
        elif key < link[1]:
            yield (h, 0, 0), (None, link[1], tuple(link[2].items()), mask | again)
            link[1], link[2] = key, {part: 1}
        else:
            link[2][part] = link[2].get(part, 0) + 1
    yield from flushed()
    release()


def _decided(rows: Iterator[tuple], again: int) -> Iterator[tuple]:
    """(key, part, mask, rows), of rows sorted by hash and key."""
    at, chain = None, []
    for (h, open_, _), (raw, key, parts, mask) in rows:
        if open_:
            if h != at:
                at, chain = h, []
            least = next((k for text, k in chain if text == raw), None)
            if least is None:
                chain.append((raw, key))
            elif key > least:
                mask |= again
        for part, n in parts:
            yield key, part, mask, n
    release()


def masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang", filters: dict[str, Callable[[Facts], bool]] | None = None, hashed: Callable[[bytes], int] = digest, chain_bytes: int = CHAIN_BYTES) -> DataFrame:
    """key, part, mask, n for documents: a bit of mask for each filter that they fail, the last for repeated texts.

    n counts rows that repeat key, part and text (a document may take several rows of the result). A null text is empty, so
    is a null part. Rows of one key don't make one another duplicates; a null key is no duplicate and makes none.
    """
    spark, each = docs.sparkSession, list((FILTERS if filters is None else filters).values())
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *T._parse_datatype_string("part string, mask int, n long").fields])
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(part).cast("string").alias("part"))
    routed = rows.rdd.mapPartitions(lambda it: _routed(it, each, hashed, chain_bytes))
    sorted_ = routed.repartitionAndSortWithinPartitions(width(rows), lambda k: k[0])
    return spark.createDataFrame(sorted_.mapPartitions(lambda it: _decided(it, 1 << len(each))), schema)


def _vectors(rows: Iterator[tuple], size: int) -> Iterator[tuple[str, np.ndarray]]:
    """(part, counts by mask of documents, good, toxic) of a partition."""
    held: dict[str, np.ndarray] = {}
    for part, mask, n, good, toxic in rows:
        v = held.get(part)
        if v is None:
            v = held[part] = np.zeros((3, size), np.int64)
        v[0, mask] += n
        v[1, mask] += good
        v[2, mask] += toxic
    yield from held.items()


def orders(vector: np.ndarray, letters: str) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order and step."""
    mask = np.arange(vector.shape[1])
    out, shapley = [], dict.fromkeys(letters, 0)
    for order in permutations(letters):
        before = np.zeros(len(mask), bool)
        for step, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            fails = (mask & bit) > 0
            here = fails & ~before
            removed, good, toxic = (int(v[here].sum()) for v in vector)
            redundant, alone = int(vector[0][fails & before].sum()), int(vector[0][bit])
            before |= fails
            shapley[letter] += removed
            out.append(("".join(order), step, int(vector[0][~before].sum()), removed, redundant, alone, good, toxic))
    return [(*row, shapley[row[0][row[1] - 1]]) for row in out]


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang", filters: dict[str, Callable[[Facts], bool]] | None = None, duplicate: str = DUPLICATE, **how) -> DataFrame:
    """For each value of `part`, each order of the filters and each step of it (from 1): documents kept after the step, removed
    by it, redundant (failing its filter, removed earlier), failing its filter alone, good and toxic ones that it removes, and
    what its filter removes summed over all orders.

    labels has doc_id, quality, toxic: a document is good or toxic if any of its rows says 1. A null part is ''; other nulls
    as in `masks`. A table without rows gives none. Columns of docs beyond the three are not read. Documents are counted again
    afterwards, as an audit is to account for all: other rows than at first (a table that changes meanwhile) raise an error.
    """
    spark = docs.sparkSession
    letters = "".join(FILTERS if filters is None else filters) + duplicate
    with scoped(spark) as scope:
        rows = scope.keep(masks(docs, key, text, part, filters, **how))
    told, there = rows.agg(F.sum("n").alias("n")).first()["n"] or 0, docs.count()
    if told != there:
        raise RuntimeError(f"{told} of {there} documents have a mask: the table changed while it was read")
    says = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    told = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("key")).agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    none = F.lit(0).cast("long")
    # Labels join narrow rows, and only those that have a key.
    counted = rows.select("part", "mask", "n", none.alias("good"), none.alias("toxic"))
    labelled = rows.join(told, "key").select("part", "mask", none.alias("n"), (F.col("n") * F.col("good")).alias("good"), (F.col("n") * F.col("toxic")).alias("toxic"))
    size = 1 << len(letters)
    vectors = counted.union(labelled).rdd.mapPartitions(lambda it: _vectors(it, size)).combineByKey(lambda v: v, lambda a, b: a + b, lambda a, b: a + b, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return spark.createDataFrame(vectors.flatMap(lambda kv: ((kv[0], *row) for row in orders(kv[1], letters))), schema)
