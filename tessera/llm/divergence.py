"""Source divergence audit: how far the word use of each (language, source) group lies from its language and from other sources.

A language keeps the terms that at least LEAST_DOCS of its documents have. With c occurrences of a term in a group, N of all
kept terms there and V kept terms, p = 1 + floor(10^9 (c + 1) / (N + V)), and a term adds f(p, q) = floor((p - q)^2 / q) to what
parts one distribution from another. All of it is in whole numbers, so sums may be taken in any order and in parts.

Every pair of sources of a language sums f over all kept terms, also those that both lack. That sum is split:

- All terms as if neither source had them: one number for each pair, times the terms.
- Heavy terms, which more than HEAVY sources have, are dense matrices (sources by terms) in tiles of TILE sources by about BLOCK
  terms; a task adds up what the pairs of two tiles have beyond that over one block with numpy.
- Light terms add a correction for each source that has one (it depends on the count alone, so counts are weighed by the terms
  that have them), and one for each two sources of one posting list, which has HEAVY sources at most.

Texts are read once. Partitions count terms in memory and let them go when MOST_TERMS are held; what crosses the shuffle is a row
a (partition, group, term), narrow, by (language, term), so that a hot source is spread over its terms. Nothing is collected but
what a task counts, and groups are broadcast only if their counted rows are few.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, pairs, release, scoped, stored, text_batches, width

LEAST_DOCS, TOP_TERMS = 3, 200
HEAVY, TILE, BLOCK = 16, 64, 512
#: Different terms that a partition holds before it lets them go; bytes of a text that are cut into words at once, about.
MOST_TERMS, PIECE = 300_000, 4 << 20

_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in lists: runs of ASCII letters and all other letters beyond ASCII; only A-Z are lower-cased."""
    raw, start = (text or "").encode().translate(_TERMS), 0
    while start < len(raw):
        end = raw.find(b" ", start + PIECE)
        end = len(raw) if end < 0 else end
        yield raw[start:end].split()
        start = end


def _counted(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n (occurrences), docs of rows of lang, source, text; an empty term for every group that occurs."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def flushed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            keys = [b"", *n]
            columns = [pa.array(keys, pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs[k] for k in n)], pa.int64())]
            whole = pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array([source] * len(keys)), *columns], ["lang", "source", "term", "n", "docs"])
            for i in range(0, len(keys), 20_000):
                yield whole.slice(i, 20_000)
        held.clear()

    for batch in batches:
        for lang, source, text in pairs(batch):
            n, docs = held.setdefault((lang or "", source or ""), (Counter(), Counter()))
            size -= len(n)
            seen: set[bytes] = set()
            for words in terms(text):
                n.update(words)
                seen.update(words)
            docs.update(seen)
            size += len(n)
            if size > most:
                yield from flushed()
                size = 0
    yield from flushed()
    release()


def _share(n: Column, total: Column, kept: Column) -> Column:
    """p of a count; 1 where a language keeps no term."""
    exact = F.call_function("div", (n + 1).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)"), (total + kept).cast("decimal(20,0)"))
    return F.when(kept > 0, 1 + exact).otherwise(F.lit(1).cast("long"))


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS, most: int = MOST_TERMS) -> DataFrame:
    """lang, source, term, n for every group's kept terms, and an empty term for every group; lang_n: occurrences in the
    language; sources: how many have the term; first: whether the source is the first of those."""
    text_batches(docs.sparkSession)
    rows = docs.select(*[F.col(c).cast("string").alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    found = rows.mapInArrow(lambda b: _counted(b, most), "lang string, source string, term string, n long, docs long").repartition(width(rows), "lang", "term")
    summed = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    w = Window.partitionBy("lang", "term")
    named = summed.withColumns({"docs": F.sum("docs").over(w), "lang_n": F.sum("n").over(w), "sources": F.count("*").over(w), "first": F.min("source").over(w) == F.col("source")})
    return named.filter((F.col("docs") >= least_docs) | (F.col("term") == "")).drop("docs")


def groups(kept: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """lang, source, g (its number in the language), n (of kept terms), lang_n, terms, light (terms that are), p0, of counts."""
    real = F.col("term") != ""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    head = real & F.col("first")
    per = kept.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count_if(head).alias("terms"), F.count_if(head & (F.col("sources") <= heavy)).alias("light"))
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("g")
    return own.join(per, "lang").select("*", number).withColumn("p0", _share(F.lit(0).cast("long"), F.col("n"), F.col("terms")))


def _dense(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sums of f over terms (columns) for each row of p (the group) and of q (the other)."""
    return np.stack([((row - q) ** 2 // q).sum(axis=1) for row in p]) if len(p) else np.zeros((0, len(q)), np.int64)


def _tile(key: tuple, table: pa.Table, tile: int) -> pa.Table:
    """The partial sums of two tiles of sources over one block: of dense terms, less what they were if neither source had them, or
    of light ones by their counts. The first block of these has what all terms were if neither source had them."""
    dense, block, a, b, count = (k.as_py() for k in key[1:])
    g, p, weight = (table.column(c).to_numpy() for c in ("g", "p", "weight"))
    mark = weight == 0
    order = np.argsort(g[mark])
    known, p0 = g[mark][order], p[mark][order]
    at = np.searchsorted(known, g[~mark])
    left, right = known // tile == a, known // tile == b
    total = np.zeros((len(known), len(known)), np.int64)
    # Both directions of a pair: rows are the group, columns the other.
    sides = ((left, right), (right, left)) if a != b else ((left, right),)
    if dense:
        coded = table.column("term").filter(pa.array(~mark)).combine_chunks().dictionary_encode()
        matrix = np.repeat(p0[:, None], len(coded.dictionary), axis=1)
        matrix[at, coded.indices.to_numpy()] = p[~mark]
        for x, y in sides:
            total[np.ix_(x, y)] += _dense(matrix[x], matrix[y]) - matrix.shape[1] * _dense(p0[x][:, None], p0[y][:, None])
    else:
        if block == 0:
            for x, y in sides:
                total[np.ix_(x, y)] += count * _dense(p0[x][:, None], p0[y][:, None])
        for i, own, w in zip(at.tolist(), p[~mark].tolist(), weight[~mark].tolist(), strict=True):
            none = int(p0[i])
            others = (right if left[i] else left) if a != b else left
            q = p0[others]
            total[i, others] += w * ((own - q) ** 2 // q - (none - q) ** 2 // q)
            total[others, i] += w * ((q - own) ** 2 // own - (q - none) ** 2 // none)
    np.fill_diagonal(total, 0)
    rows, columns = np.nonzero((left[:, None] & right[None, :]) | (right[:, None] & left[None, :]))
    off = rows != columns
    rows, columns = rows[off], columns[off]
    return pa.table({"lang": pa.array([key[0].as_py()] * len(rows), pa.string()), "g": pa.array(known[rows]), "h": pa.array(known[columns]), "value": pa.array(total[rows, columns])})


def _tiled(kept: DataFrame, known: DataFrame, heavy: int, tile: int, block: int) -> DataFrame:
    """lang, g, h, value: partial sums of heavy terms, and of light ones but for their posting pairs."""
    size = known.groupBy("lang").agg(F.count("*").alias("sources"))
    # A source's mark (weight 0) is in every block of its language, so that a tile knows all its sources.
    marks = broadcast_if_small(known.join(size, "lang").withColumns({"tiles": F.ceil(F.col("sources") / tile), "heavy_blocks": F.ceil((F.col("terms") - F.col("light")) / block)}).drop("sources"))
    facts = marks.select("lang", "source", "g", F.col("n").alias("total"), "terms", "tiles", "heavy_blocks")
    entries = kept.filter("term <> ''").join(facts, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))
    many = F.col("sources") > heavy
    thick = entries.filter(many).select("lang", "g", "term", "p", F.lit(1).cast("long").alias("weight"), F.lit(True).alias("dense"), F.pmod(F.xxhash64("term"), F.col("heavy_blocks")).alias("block"), "terms", "tiles")
    thin = stored(entries.filter(~many).groupBy("lang", "g", "n").agg(F.count("*").alias("weight"), F.first("p").alias("p"), F.first("terms").alias("terms"), F.first("tiles").alias("tiles")))
    thin_blocks = broadcast_if_small(thin.groupBy("lang").agg(F.ceil(F.count_distinct("n") / block).alias("thin_blocks")))
    thin = thin.join(thin_blocks, "lang").select("lang", "g", F.lit(None).cast("string").alias("term"), "p", "weight", F.lit(False).alias("dense"), F.pmod(F.xxhash64("n"), F.col("thin_blocks")).alias("block"), "terms", "tiles")
    mark = marks.join(thin_blocks, "lang", "left").select("lang", "g", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), F.lit(0).cast("long").alias("weight"), "terms", "tiles", "heavy_blocks", "thin_blocks")
    dense_marks = mark.filter("heavy_blocks > 0").withColumns({"dense": F.lit(True), "block": F.explode(F.sequence(F.lit(0).cast("long"), F.col("heavy_blocks") - 1))})
    thin_marks = mark.withColumns({"dense": F.lit(False), "block": F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("thin_blocks") - 1, F.lit(0).cast("long"))))})
    columns = ["lang", "g", "term", "p", "weight", "dense", "block", "terms", "tiles"]
    every = thick.unionByName(thin).unionByName(dense_marks.select(columns)).unionByName(thin_marks.select(columns))
    mine = F.floor(F.col("g") / tile)
    other = F.transform(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1), lambda x: F.struct(F.least(x, mine).alias("a"), F.greatest(x, mine).alias("b")))
    dealt = every.withColumn("pair", F.explode(other)).select("*", "pair.a", "pair.b")
    return dealt.groupBy("lang", "dense", "block", "a", "b", "terms").applyInArrow(lambda key, rows: _tile(key, rows, tile), "lang string, g int, h int, value long")


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, g, h, value of posting lists (lang, array of g, p, p0): what two sources of one list add beyond either alone."""
    for batch in batches:
        lists = batch.column(1)
        lang = batch.column(0).dictionary_encode()
        size = np.asarray(lists.value_lengths())
        start = np.asarray(lists.offsets)[:-1] - lists.offsets[0].as_py()
        g, p, p0 = (f.to_numpy(zero_copy_only=False).astype(np.int64) for f in lists.flatten().flatten())
        keys, values = [], []
        for d in np.unique(size):
            rows = np.flatnonzero(size == d)
            cells = start[rows][:, None] + np.arange(d)
            of = lang.indices.to_numpy()[rows].astype(np.int64)
            for i in range(d):
                for j in range(d):
                    if i != j:
                        x, y = cells[:, i], cells[:, j]
                        f = lambda u, v: (u - v) ** 2 // v
                        values.append(f(p[x], p[y]) - f(p[x], p0[y]) - f(p0[x], p[y]) + f(p0[x], p0[y]))
                        keys.append(np.stack([of, g[x], g[y]]))
        if not keys:
            continue
        of, x, y = np.concatenate(keys, axis=1)
        known = np.unique(np.concatenate([x, y]))
        pair = (of * len(known) + np.searchsorted(known, x)) * len(known) + np.searchsorted(known, y)
        order = np.argsort(pair, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(pair[order]) != 0]))
        total, at = np.add.reduceat(np.concatenate(values)[order], first), order[first]
        yield pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(of[at])), pa.array(x[at].astype(np.int32)), pa.array(y[at].astype(np.int32)), pa.array(total)], ["lang", "g", "h", "value"])
    release()


def _posted(kept: DataFrame, known: DataFrame, heavy: int) -> DataFrame:
    facts = broadcast_if_small(known.select("lang", "source", "g", F.col("n").alias("total"), "terms", "p0"))
    light = kept.filter((F.col("term") != "") & F.col("sources").between(2, heavy)).join(facts, ["lang", "source"])
    cell = F.struct("g", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "p0")
    lists = light.groupBy("lang", "term").agg(F.collect_list(cell).alias("cells")).select("lang", "cells")  # of `heavy` cells at most
    return lists.mapInArrow(_corrections, "lang string, g int, h int, value long")


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, heavy: int = HEAVY, tile: int = TILE, block: int = BLOCK, most: int = MOST_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank for every (lang, source) that occurs.

    part `pair`: every other source of the language, with the sum of f over all kept terms (0 if there are none). part `term`:
    the terms that the group uses more than its language does, the first `top` by f. Ranks go from 1, largest value first, ties
    by the item's UTF-8 bytes. Null lang, source and text are ''. Rows that repeat are documents of their own. A table
    without rows gives none; other columns are not read. Counts may go up to 9 * 10^18, sources of a language up to 2^31.
    """
    with scoped(docs.sparkSession) as scope:
        kept = stored(counts(docs, lang, source, text, least_docs, most))
        known = stored(groups(kept, heavy))
        summed = _tiled(kept, known, heavy, tile, block).unionByName(_posted(kept, known, heavy)).groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
        named = broadcast_if_small(known.select("lang", "g", "source"))
        other = broadcast_if_small(known.select("lang", F.col("g").alias("h"), F.col("source").alias("item")))
        pair = summed.join(named, ["lang", "g"]).join(other, ["lang", "h"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
        facts = broadcast_if_small(known.select("lang", "source", F.col("n").alias("total"), F.col("lang_n").alias("lang_total"), "terms"))
        use = kept.filter("term <> ''").join(facts, ["lang", "source"]).withColumns({"p": _share(F.col("n"), F.col("total"), F.col("terms")), "q": _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))})
        term = use.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
        rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
        return scope.keep(pair.select("*", rank).unionByName(term.select("*", rank).filter(F.col("rank") <= top)))
