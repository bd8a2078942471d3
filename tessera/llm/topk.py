"""Exact top-k inner-product search by a three-phase uniform threshold.

The coordinates, those in which the queries have most weight first, are dealt into m groups; a row's score is the sum of its
m partial scores. For a block of queries:

1. every partition of the candidates takes, from its list of partial scores in the first group, the k best and resolves
   them; the k-th best score gathered over all partitions is a safe cutoff t of that query (the true k-th is t or more);
2. t is broadcast with the block. Partial scores are taken group by group, and a candidate is dropped once its scores so far
   and the most that the other groups can add (the products of the norms) stay below t, or once it has t / m or more in no
   group and can't have it in the ones to come: who scores t has t / m in some group, whatever the signs;
3. once few are left, those are collected, and only their other groups are multiplied, pair by pair, with the same limits;
   the best k of all partitions are ranked.

Queries come in blocks of at most about QUERY_BLOCK vectors, one pass over the candidates each: a broadcast is bounded by
that, and candidates are never paired by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import batched, stored

#: Vectors of a broadcast block, at most about; a block of 64 coordinates is 16 MB.
QUERY_BLOCK = 32_768
#: Groups of coordinates, that is lists of partial scores.
GROUPS = 4
#: Pairs scored at once: bounds the matrices of scores. Pairs whose coordinates are gathered at once.
CELLS, PAIRS = 2_000_000, 50_000
#: Share of the pairs from which on a group is multiplied for all of them: a matrix product costs less a pair.
DENSE = 1 / 3
_LEAST = np.iinfo(np.int64).min // 2


def quantized(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """key and floor(scale * x) of each component as longs, without vectors that are null or hold null or non-finite components."""
    x = F.col("v")
    sound = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf"))
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("v")).filter(x.isNotNull() & F.col("key").isNotNull() & F.forall(x, sound))
    return rows.select("key", F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


def _stack(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length of vector in the column."""
    lens = np.asarray(column.value_lengths())
    flat, ends = np.asarray(column.flatten()), np.cumsum(lens)
    out = []
    for n in np.unique(lens):
        rows = np.flatnonzero(lens == n)
        out.append((rows, flat[(ends[rows] - n)[:, None] + np.arange(n)[None, :]] if n else np.empty((len(rows), 0), np.int64)))
    return out


@dataclass
class Asked:
    """The queries of a block that have one length: place in the block, keys, matrix by group, norms of what follows a group."""

    at: np.ndarray
    keys: np.ndarray
    order: np.ndarray  # of the coordinates
    cuts: list[np.ndarray]
    groups: list[np.ndarray]
    rest: list[np.ndarray]

    @classmethod
    def of(cls, at: np.ndarray, keys: np.ndarray, q: np.ndarray) -> Asked:
        order = np.argsort(-(q.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        cuts = np.array_split(np.arange(q.shape[1]), min(GROUPS, max(1, q.shape[1])))
        groups = _grouped(q, order, cuts)
        return cls(at, keys, order, cuts, groups, _norms(groups))


def _grouped(x: np.ndarray, order: np.ndarray, cuts: list[np.ndarray]) -> list[np.ndarray]:
    return [np.ascontiguousarray(x[:, order[g]]) for g in cuts]


def _norms(groups: list[np.ndarray]) -> list[np.ndarray]:
    """By group: the norm of all groups after it, rounded up."""
    squares = [(g.astype(np.float64) ** 2).sum(axis=1) for g in groups]
    return [np.sqrt(sum(squares[i + 1 :], np.zeros(len(squares[0])))) * (1 + 1e-9) for i in range(len(groups))]


def _scores(q: np.ndarray, c: np.ndarray, count: list[int]) -> np.ndarray:
    """Integer products; in floats where those are exact, as they are faster."""
    count[0] += len(q) * len(c) * q.shape[1]
    most = int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * q.shape[1]
    return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64) if most < 1 << 52 else q @ c.T


def _pairs(q: list[np.ndarray], c: list[np.ndarray], rows: np.ndarray, cols: np.ndarray, count: list[int]) -> np.ndarray:
    """The sum over some groups of the scores of pairs of a query and a candidate."""
    out = np.zeros(len(rows), np.int64)
    for a, b in zip(q, c, strict=True):
        count[0] += len(rows) * a.shape[1]
        for i in range(0, len(rows), PAIRS):
            out[i : i + PAIRS] += np.einsum("ij,ij->i", a[rows[i : i + PAIRS]], b[cols[i : i + PAIRS]])
    return out


def _each(batches, shared, cells: int) -> Iterator[tuple[Asked, np.ndarray, list[np.ndarray]]]:
    """(queries, candidates' keys, their matrix by group), never more than `cells` pairs at once."""
    for b in batches:
        keys = np.asarray(b.column(0))
        for rows, c in _stack(b.column(1)):
            if (asked := shared.value.get(c.shape[1])) is None:
                continue
            size = max((int(np.abs(g).max(initial=0)) for g in asked.groups), default=0)
            if size * int(np.abs(c).max(initial=0)) * c.shape[1] >= 1 << 62:
                raise OverflowError("scores of more than 64 bits: use a smaller scale")
            step = max(1, cells // max(1, len(asked.keys)))
            for i in range(0, len(rows), step):
                yield asked, keys[rows[i : i + step]], _grouped(c[i : i + step], asked.order, asked.cuts)


def _gather(batches, shared, k: int, cells: int, count: list[int] | None = None) -> Iterator[tuple]:
    """Phase 1: this partition's k best scores of each query, of candidates that are among the k best of the first group."""
    best: dict[int, np.ndarray] = {}
    count = [0] if count is None else count
    for asked, keys, c in _each(batches, shared, cells):
        head = _scores(asked.groups[0], c[0], count)
        own = asked.keys[:, None] == keys[None, :]
        head[own] = _LEAST
        n = min(k, head.shape[1])
        cols = np.argpartition(-head, n - 1, axis=1)[:, :n] if n < head.shape[1] else np.broadcast_to(np.arange(n), (len(head), n))
        rows, cols = np.repeat(np.arange(len(head)), n), cols.ravel()
        exact = head[rows, cols] + _pairs(asked.groups[1:], c[1:], rows, cols, count)
        exact = np.where(own[rows, cols], _LEAST, exact).reshape(len(head), n)
        held = best.setdefault(c_len := sum(g.shape[1] for g in c), np.full((len(head), k), _LEAST))
        best[c_len] = np.sort(np.concatenate([held, exact], axis=1), axis=1)[:, ::-1][:, :k]
    for size, scores in best.items():
        for i, row in zip(shared.value[size].at.tolist(), scores.tolist(), strict=True):
            yield i, [x for x in row if x > _LEAST]


def _resolve(batches, shared, cutoffs, k: int, cells: int, count: list[int] | None = None) -> Iterator[tuple]:
    """Phases 2 and 3: collects by the uniform threshold, resolves, and keeps this partition's k best of each query."""
    count, found = [0] if count is None else count, np.empty((0, 3), np.int64)
    for asked, keys, c in _each(batches, shared, cells):
        t, m = cutoffs.value[asked.at], len(c)
        share, rest, own = -(-t // m), _norms(c), asked.keys[:, None] == keys[None, :]  # share in whole numbers: p * m >= t
        sums, live, reached, g = np.zeros(own.shape, np.int64), ~own, np.zeros(own.shape, bool), 0
        while g < m and live.mean() > DENSE:  # phase 2: whole groups
            part = _scores(asked.groups[g], c[g], count)
            sums += part
            reached |= part >= share[:, None]
            most = asked.rest[g][:, None] * rest[g][None, :]
            live &= (sums + most >= t[:, None]) & (reached | (most >= share[:, None]))
            g += 1
        rows, cols = np.nonzero(live)
        score, had = sums[rows, cols], reached[rows, cols]
        for h in range(g, m):  # phase 3: what was collected
            part = _pairs(asked.groups[h : h + 1], c[h : h + 1], rows, cols, count)
            score, had = score + part, had | (part >= share[rows])
            most = asked.rest[h][rows] * rest[h][cols]
            keep = (score + most >= t[rows]) & (had | (most >= share[rows]))
            rows, cols, score, had = rows[keep], cols[keep], score[keep], had[keep]
        good = score >= t[rows]
        found = _least(np.concatenate([found, np.stack([asked.at[rows[good]], -score[good], keys[cols[good]]], axis=1)]), k)
    for i, score, key in found.tolist():
        yield i, key, -score


def _least(rows: np.ndarray, k: int) -> np.ndarray:
    """The k least rows of each first member."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    starts = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
    rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))
    return rows[rank < k]


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best rows of vectors by the product of floor(scale * x) components.

    Ties go to the smaller vec_id. A query's own row (same key) is no candidate. Vectors that are null, or hold null or
    non-finite components, or have a null key, take no part; vectors of another length than the query's are no candidates.
    Rows of vectors that repeat a key are candidates each; repeated query keys are asked once. Fewer than k candidates
    give fewer rows. Scores over 2^52 are computed in 64-bit integers; scores that could need more are an error.
    """
    spark, cells = vectors.sparkSession, CELLS
    rows = quantized(vectors, key, vector, scale)
    asked = quantized(queries, key, vector, scale).dropDuplicates(["key"])
    n_blocks = -(-asked.count() // QUERY_BLOCK)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n_blocks:
        return empty
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks)).cast("int"))) if n_blocks > 1 else asked.withColumn("block", F.lit(0))
    done = []
    for block in range(n_blocks):
        held = asked.filter(F.col("block") == block).select("key", "v").toArrow()  # at most about QUERY_BLOCK rows
        if not held.num_rows:
            continue
        keys, blocks = np.asarray(held.column(0)), {}
        for at, q in _stack(held.column(1).combine_chunks()):
            blocks[q.shape[1]] = Asked.of(at, keys[at], q)
        shared = spark.sparkContext.broadcast(blocks)
        gathered = rows.mapInArrow(batched(lambda b, s=shared: _gather(b, s, k, cells), pa.schema([("q", pa.int32()), ("scores", pa.list_(pa.int64()))])), "q int, scores array<long>")
        kth = gathered.groupBy("q").agg(F.slice(F.sort_array(F.flatten(F.collect_list("scores")), asc=False), 1, k).alias("s")).filter(F.size("s") == k).select("q", F.element_at("s", -1).alias("t")).toArrow()
        limits = np.full(len(keys), _LEAST)
        limits[np.asarray(kth.column(0))] = np.asarray(kth.column(1))
        cutoffs = spark.sparkContext.broadcast(limits)
        found = rows.mapInArrow(batched(lambda b, s=shared, c=cutoffs: _resolve(b, s, c, k, cells), pa.schema([("q", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])), "q int, vec_id long, score long")
        names = spark.createDataFrame(pa.table({"q": pa.array(np.arange(len(keys), dtype=np.int32)), "query_id": pa.array(keys)}))
        rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
        ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k)
        part = ranked.join(F.broadcast(names), "q").select("query_id", "rank", "vec_id", "score")
        done.append(part if n_blocks == 1 else stored(part))
    return reduce(DataFrame.unionByName, done) if done else empty
