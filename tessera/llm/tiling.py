"""Benchmark decontamination by greedy string tiling.

A document leaks a benchmark item if enough of the item's words are covered by tiles: non-overlapping runs of MIN_TILE or
more words that stand in both, taken greedily from the longest on (running Karp-Rabin matching over word hashes). Tiles
may stand in any order, so an item whose sentences are shuffled, or interleaved with other text, is caught.

The items' word runs (seeds) are cut into blocks of at most SEED_BLOCK; each is broadcast to one pass over the documents,
so what is broadcast has a fixed bound and the documents are never shuffled. A document meets an item only through a join
on shared seeds, and is tiled with it only if the seeds that they share could cover enough of the item.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import batched, stored, text_batches
from tessera.llm.shingles import WordHashes, mixed, runs

MIN_TILE, COVERAGE = 4, 0.6
#: Word runs of benchmark items in a broadcast block, at most (or one item, if it alone has more).
SEED_BLOCK = 1_000_000

_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: A number in place of a word that is in no item.
_STRANGER = np.uint64(0)


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class _Rolling:
    """Hashes of all runs of one length of a sequence (Karp-Rabin: differences of prefix sums), and which members are used."""

    def __init__(self, members: np.ndarray) -> None:
        self.used = np.zeros(len(members), bool)
        self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(members), _BASE, np.uint64))])
        self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(members), _INVERSE, np.uint64))])
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(members) * self.up[:-1])])

    def free(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of the runs of n members none of which is used."""
        taken = np.concatenate([[0], np.cumsum(self.used)])
        at = np.flatnonzero(taken[n:] == taken[: len(taken) - n])
        return at, (self.sums[at + n] - self.sums[at]) * self.down[at]


def tiles(a, b, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of numbers: (place in a, place in b, length), longest first, then by place in a
    and b.

    Again and again the longest run of unused members that both have is sought, by bisection over its length: a longer
    common run has all shorter ones in it. Runs are met by their hashes, of all places at once; a match is compared member
    by member before its members are marked as used. So a length costs time in proportion to the two sequences, however
    often members repeat.
    """
    a, b = (np.asarray(x).astype(np.uint64) for x in (a, b))
    out, left, right = [], _Rolling(a), _Rolling(b)
    most = min(len(a), len(b))

    def common(n: int) -> bool:
        return bool(np.isin(left.free(n)[1], right.free(n)[1]).any())

    while most >= least and common(least):
        low, high = least, most + 1
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if common(mid) else (low, mid)
        starts, hashes = left.free(low)
        places, found = right.free(low)
        order = np.argsort(found, kind="stable")
        found, places = found[order], places[order]
        for i, h in zip(starts.tolist(), hashes, strict=True):
            if left.used[i : i + low].any():
                continue
            for j in places[np.searchsorted(found, h, "left") : np.searchsorted(found, h, "right")].tolist():
                if not right.used[j : j + low].any() and np.array_equal(a[i : i + low], b[j : j + low]):
                    left.used[i : i + low] = right.used[j : j + low] = True
                    out.append((i, j, low))
                    break
        most = low - 1
    return out


def covered(target: np.ndarray, own: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """`tiles` of an item and a document (places in the document are those of its members that the item has in runs)."""
    hit = np.isin(runs(own, size), runs(target, size))
    near = np.zeros(len(own) + 1, np.int64)
    np.add.at(near, np.flatnonzero(hit), 1)
    np.add.at(near, np.flatnonzero(hit) + size, -1)
    near = np.cumsum(near[:-1]) > 0
    # Runs lie within the stretches of the document that matching runs cover; one stranger parts these.
    at = np.flatnonzero(near)
    cuts = np.flatnonzero(np.diff(at) > 1) + 1
    return tiles(target, np.insert(own[at], cuts, _STRANGER), size)


@dataclass
class Block:
    """Items with their words' hashes, and their seeds in order: hash, item (position), place in the item; a table by the low
    bits of hashes says which may be a seed, so that most runs of a document are passed over by one lookup."""

    ids: list
    items: list[np.ndarray]
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray

    def __post_init__(self) -> None:
        bits = min(24, max(10, int(len(self.seeds) * 16).bit_length()))  # 16 MB at most
        self.mask = np.uint64((1 << bits) - 1)
        self.may = np.zeros(1 << bits, bool)
        self.may[self.seeds & self.mask] = True


def _seeds_of(hashes: np.ndarray, least: int) -> np.ndarray:
    """Seeds of an item; one shorter than a tile is one seed, of all its words."""
    return runs(hashes, min(least, len(hashes))) if len(hashes) else np.empty(0, np.uint64)


def _block(ids: list, texts: list[str], least: int) -> list[Block]:
    """Blocks by item length class: an item shorter than a tile is sought by its own length."""
    known, out = WordHashes(), []
    for short in range(1, least + 1):
        rows = [(k, known.of(w)) for k, w in zip(ids, map(words, texts), strict=True) if (len(w) == short if short < least else len(w) >= least)]
        if rows:
            seeds = [_seeds_of(h, least) for _, h in rows]
            flat, item = np.concatenate(seeds), np.repeat(np.arange(len(rows)), [len(s) for s in seeds])
            place, order = np.concatenate([np.arange(len(s)) for s in seeds]), np.argsort(flat, kind="stable")
            out.append((short, Block([k for k, _ in rows], [h for _, h in rows], flat[order], item[order], place[order])))
    return out


def _found(batches: Iterator[pa.RecordBatch], shared, least: int, coverage: float) -> Iterator[tuple]:
    known = WordHashes()
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = known.of(words(text.as_py()))
            for size, block in shared.value:
                yield from _leaks(key, own, size, block, coverage)


def _leaks(key, own: np.ndarray, size: int, block: Block, coverage: float) -> Iterator[tuple]:
    grams = runs(own, size)
    grams = np.unique(grams[block.may[grams & block.mask]])
    lo, hi = np.searchsorted(block.seeds, grams, "left"), np.searchsorted(block.seeds, grams, "right")
    hit = hi > lo
    if not hit.any():
        return
    at = np.concatenate([np.arange(x, y) for x, y in zip(lo[hit], hi[hit], strict=True)])
    item, place = block.item[at], block.place[at]
    order = np.lexsort((place, item))
    item, place = item[order], place[order]
    cuts = np.flatnonzero(np.diff(item)) + 1
    for i, places in zip(item[np.concatenate([[0], cuts])], np.split(place, cuts), strict=True):
        target = block.items[i]
        most = int(np.minimum(np.diff(places, append=places[-1] + size), size).sum())  # words that shared seeds could cover
        if most < coverage * len(target):
            continue
        made = covered(target, own, size)
        words_in = sum(n for _, _, n in made)
        if words_in >= coverage * len(target):
            yield key, block.ids[i], words_in / len(target), len(made)


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", least: int = MIN_TILE, coverage: float = COVERAGE) -> DataFrame:
    """key, item_id, coverage, n_tiles: each pair of a document and an item of which it covers enough.

    Words are runs of letters, digits and underscores, lower-cased. Items with fewer words than a tile must stand whole in the
    document; items without words (null, empty) leak nowhere, documents without words leak nothing. Repeated rows of either
    side are answered each; keys may be null. Only pairs that leak are rows, so a clean corpus gives an empty result.
    """
    spark = docs.sparkSession
    text_batches(spark)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kinds = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("item", items.schema[item_key].dataType), T.StructField("coverage", T.DoubleType()), T.StructField("n_tiles", T.IntegerType())])
    schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in kinds])
    sized = items.select(F.col(item_key).alias("id"), F.col(item_text).alias("text")).withColumn("n", F.octet_length(F.coalesce("text", F.lit(""))))
    total = sized.agg(F.sum("n")).first()[0] or 0
    n_blocks = max(1, -(-total // (2 * SEED_BLOCK)))  # a word takes two bytes at least
    if n_blocks > 1:
        sized = stored(sized.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)).cast("int")))
    done = []
    for i in range(n_blocks):
        part = (sized.filter(F.col("block") == i) if n_blocks > 1 else sized).select("id", "text").toArrow()
        shared = spark.sparkContext.broadcast(_block(part.column(0).to_pylist(), [x or "" for x in part.column(1).to_pylist()], least))
        found = rows.mapInArrow(batched(lambda b, s=shared: _found(b, s, least, coverage), schema), kinds)
        done.append(stored(found) if n_blocks > 1 else found)
    return reduce(DataFrame.unionByName, done).withColumnsRenamed({"key": key, "item": item_key})
