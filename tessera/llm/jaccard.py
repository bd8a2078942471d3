"""Near-duplicate join: word n-gram Jaccard similarity, candidates pruned by Bayesian inference.

1. Every text has N_HASHES MinHash values of its set of word shingles; equal texts are one text from here on.
2. Texts that agree on all values of one of BANDS bands share a bucket. At the threshold of 0.8 a pair misses all of the
   20 bands of 3 values with probability (1 - 0.8 ** 3) ** 20 = 6e-7.
3. Within a bucket, pairs are compared value by value, STEP at a time: with k of m values equal and a uniform prior, the
   similarity has the posterior Beta(k + 1, m - k + 1), and a pair is dropped once the probability that it reaches the
   threshold is under TOLERANCE. A pair that shares several buckets counts in that of its first common band only.
4. What is left is verified on the shingle sets themselves. Only counts of links and edges of a forest leave a task, never
   pairs; components of the forest are the classes.

A bucket of more than CHUNK texts, or of CHUNK_BYTES of shingles, is cut into chunks by hash, and each pair of chunks is a
task's group of its own: all pairs are compared, none is emitted, and no bucket is held in one place. Comparing many different texts with one another
grows with their number squared, as the links themselves do; copies of one text cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batched, scoped, stored, text_batches, width
from tessera.llm.shingles import mixed, runs, word_hashes
from tessera.operators.components import components

THRESHOLD, WORDS = 0.8, 5
BANDS, ROWS = 20, 3
N_HASHES = BANDS * ROWS
STEP, TOLERANCE = 12, 1e-6
CHUNK, CHUNK_BYTES = 1024, 16 << 20


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    """The hash functions' parameters, from the numbers 1, 2, 3 ...: odd multipliers and masks."""
    x = mixed(np.arange(1, 2 * N_HASHES + 1, dtype=np.uint64))
    return (x[:N_HASHES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (x[N_HASHES:] >> np.uint64(32)).astype(np.uint32)


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """The set of a text's runs of n words (of all its words, if fewer), sorted; empty without a word."""
    hashes = word_hashes().of((text or "").split())
    return np.unique(runs(hashes, min(n, len(hashes)))) if len(hashes) else hashes


def signature(grams: np.ndarray) -> np.ndarray:
    factor, mask = _functions()
    low = (grams ^ (grams >> np.uint64(32))).astype(np.uint32)
    out = np.full(N_HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 4096):  # keeps the products in the processor's cache
        out = np.minimum(out, ((low[None, at : at + 4096] ^ mask[:, None]) * factor[:, None]).min(axis=1))
    return out


@lru_cache(maxsize=4)
def least_equal(threshold: float, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(m, k): of the first m values at least k must be equal, or the posterior P(similarity >= threshold) < tolerance."""
    out = []
    for m in range(STEP, N_HASHES + 1, STEP):
        total, k = 0.0, 0
        while True:  # 1 - I_t(k + 1, m - k + 1) = P(Binomial(m + 1, t) <= k)
            total += comb(m + 1, k) * threshold**k * (1 - threshold) ** (m + 1 - k)
            if total >= tolerance:
                break
            k += 1
        out.append((m, k))
    return out


def _sketches(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple]:
    for b in batches:
        for text, text_id in zip(b.column(0), b.column(1).to_pylist(), strict=True):
            grams = shingles(text.as_py(), n)
            yield text_id, len(grams), signature(grams).tobytes() if len(grams) else None


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of a sorted partition by their first three columns."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for k, g in groupby(rows, key=lambda r: r[:3]):
        yield k, list(g)


def _survivors(group: tuple, rows: list[tuple], threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For row i, the later rows j that may be similar to it and have this bucket's band as their first common one."""
    band, x, y = group
    sigs = np.frombuffer(b"".join(r[5] for r in rows), np.uint32).reshape(len(rows), N_HASHES)
    sizes = np.array([r[6] for r in rows])
    own = np.array([r[7] for r in rows])
    at = rows[0][8]
    for i in range(len(rows) - 1):
        j = np.arange(i + 1, len(rows))
        if x != y:
            j = j[own[j] != own[i]]
        small = np.minimum(sizes[j], sizes[i])
        j = j[small >= threshold * np.maximum(sizes[j], sizes[i]) - 1e-9]
        seen = 0
        for m, k in least_equal(threshold):
            if not len(j):
                break
            seen = seen + (sigs[j, m - STEP : m] == sigs[i, m - STEP : m]).sum(axis=1)
            j, seen = j[seen >= k], seen[seen >= k]
        if len(j):
            common = (sigs[j] == sigs[i]).reshape(len(j), BANDS, ROWS).all(axis=2)
            j = j[common.argmax(axis=1) == at]
        if len(j):
            yield i, j


def _needed(batches, threshold: float) -> Iterator[tuple]:
    for group, rows in _groups(batches):
        need = {x for i, js in _survivors(group, rows, threshold) for x in (i, *js.tolist())}
        for i in need:
            yield (*group, *rows[i][3:])


def _verified(batches, threshold: float) -> Iterator[tuple]:
    for group, rows in _groups(batches):
        sets = [np.frombuffer(r[9], np.uint64) for r in rows]
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        names, flat = np.unique(np.concatenate(sets), return_inverse=True)
        mark, links, root = np.zeros(len(names), bool), [0] * len(rows), list(range(len(rows)))

        def find(i: int, root=root) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        for i, js in _survivors(group, rows, threshold):
            mine = flat[starts[i] : starts[i + 1]]
            mark[mine] = True
            for j in js.tolist():
                both = int(np.count_nonzero(mark[flat[starts[j] : starts[j + 1]]]))
                if both / (len(mine) + len(sets[j]) - both) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[find(j)] = find(i)
            mark[mine] = False
        for i, n in enumerate(links):
            if n:
                yield rows[i][4], n, rows[find(i)][4]


def _grams(batches, n: int) -> Iterator[tuple]:
    for b in batches:
        for text, text_id in zip(b.column(0), b.column(1).to_pylist(), strict=True):
            yield text_id, shingles(text.as_py(), n).tobytes()


def text_digest(text: Column) -> Column:
    """What tells texts apart here: the MD5 of a text, null counting as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def members(texts: DataFrame) -> DataFrame:
    """band, x, y, at, text_id, own for texts (text_id, size, sig): a row for every pair of chunks x <= y that a text is compared
    in, of the buckets that hold more than one; own is its chunk. A pair of chunks is what one task holds at a time."""
    bands = F.array(*[F.struct(F.xxhash64(F.lit(j), F.substring("sig", 4 * ROWS * j + 1, 4 * ROWS)).alias("band"), F.lit(j).alias("at")) for j in range(BANDS)])
    placed = texts.filter("sig is not null").select("text_id", "size", F.explode(bands).alias("b")).select("b.band", "b.at", "text_id", "size")
    crowded = placed.groupBy("band", "at").agg(F.count("*").alias("m"), F.sum("size").alias("grams")).filter("m > 1")
    # Texts of a bucket at most: with two very long ones, a chunk each.
    chunks = F.ceil(F.least(F.col("m"), F.greatest(F.col("m") / CHUNK, 8 * F.col("grams") / CHUNK_BYTES))).cast("int")
    member = placed.join(crowded, ["band", "at"]).withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("text_id"), F.col("chunks")).cast("int"))
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return member.select("band", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "at", "text_id", "own")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, n: int = WORDS) -> DataFrame:
    """key, class_id, text_id, n_links, digest, class_digest for each row of docs.

    text_id is the smallest key with the very same text, n_links the number of other texts whose sets of word shingles have
    a Jaccard similarity of threshold or more to it, class_id the smallest key in the component of such links. Words are
    parted by white space; a text of fewer than n words has one shingle, of all of them. Texts without words (null counts
    as empty) have no links, and their copies are one class as those of any text are. Repeated rows are answered each;
    null keys are never the smallest unless a text has no other.

    Keys may be null or stand for several texts, so class_id does not tell classes apart; class_digest does. digest is that
    of the row's text (see text_digest), class_digest that of the class's text with the smallest key, then digest.
    """
    text_batches(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), body.alias("text"), text_digest(F.col(text)).alias("text_id"))
    wide = width(rows)
    with scoped(docs.sparkSession) as scope:
        schema = pa.schema([("text_id", pa.binary()), ("size", pa.int32()), ("sig", pa.binary())])
        sketched = rows.select("text", "text_id").mapInArrow(batched(lambda b: _sketches(b, n), schema), "text_id binary, size int, sig binary")
        texts = stored(sketched.groupBy("text_id").agg(F.first("size").alias("size"), F.first("sig").alias("sig")))
        names = stored(rows.groupBy("text_id").agg(F.min("key").alias("first_key")))

        member = members(texts)
        columns = ["band", "x", "y", "at", "text_id", "sig", "size", "own", F.col("at").alias("at_band")]
        kinds = "band long, x int, y int, at int, text_id binary, sig binary, size int, own int, at_band int"
        need_schema = pa.schema([("band", pa.int64()), ("x", pa.int32()), ("y", pa.int32()), ("at", pa.int32()), ("text_id", pa.binary()), ("sig", pa.binary()), ("size", pa.int32()), ("own", pa.int32()), ("at_band", pa.int32())])
        grouped = member.join(texts, "text_id").select(*columns).repartition(wide, "band", "x", "y").sortWithinPartitions("band", "x", "y")
        need = stored(grouped.mapInArrow(batched(lambda b: _needed(b, threshold), need_schema), kinds))

        # One row stands for all copies of a text, found by its key: a text with very many copies is no large partition.
        wanted = need.select("text_id").distinct().join(names, "text_id").select(F.col("text_id").alias("wanted_id"), "first_key")
        held = rows.join(wanted, F.col("key").eqNullSafe(F.col("first_key")) & (F.col("text_id") == F.col("wanted_id")), "left_semi")
        gram_schema = pa.schema([("text_id", pa.binary()), ("grams", pa.binary())])
        grams = held.dropDuplicates(["key", "text_id"]).select("text", "text_id").mapInArrow(batched(lambda b: _grams(b, n), gram_schema), "text_id binary, grams binary")
        ready = need.join(grams, "text_id").select(*columns[:-1], "at_band", "grams").repartition(wide, "band", "x", "y").sortWithinPartitions("band", "x", "y")
        link_schema = pa.schema([("text_id", pa.binary()), ("n", pa.int64()), ("root", pa.binary())])
        links = stored(ready.mapInArrow(batched(lambda b: _verified(b, threshold), link_schema), "text_id binary, n long, root binary"))

        roots = components(links.select(F.col("text_id").alias("a"), F.col("root").alias("b")))
        counts = links.groupBy("text_id").agg(F.sum("n").alias("n_links"))
        linked = counts.join(roots.withColumnRenamed("node", "text_id"), "text_id")
        named = names.join(linked, "text_id", "left").select("text_id", "first_key", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "text_id").alias("root"))
        named = scope.keep(named)
    least = F.min(F.struct(F.col("first_key").isNull(), "first_key", "text_id"))
    classes = named.groupBy("root").agg(least.alias("least")).select("root", F.col("least.first_key").alias("class_id"), F.col("least.text_id").alias("class_digest"))
    info = named.join(classes, "root").select("text_id", "class_id", F.col("first_key"), "n_links", "class_digest")
    return rows.select("key", "text_id").join(info, "text_id").select(F.col("key").alias(key), "class_id", F.col("first_key").alias("text_id"), "n_links", F.col("text_id").alias("digest"), "class_digest")
