"""First-wins dedup within a batch, against what is stored, and by two keys; saving a batch."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.url import url_fingerprint
from tessera.operators.components import components
from tessera.operators.state import scoped, staged

#: Rows that one task passes over in order at most, by two_keys; rounds before what is left is cut into components.
ONE_TASK, ROUNDS = 250_000, 4


def first_wins(df: DataFrame, keys: str | list[str], order: str | list[str]) -> DataFrame:
    """The first row of each key in order. A null key is a key. Spark keeps one row a key before the shuffle."""
    n = F.row_number().over(Window.partitionBy(*([keys] if isinstance(keys, str) else keys)).orderBy(*([order] if isinstance(order, str) else order)))
    return df.withColumn("_n", n).filter("_n = 1").drop("_n")


def new_rows(df: DataFrame, stored: DataFrame, keys: str | list[str]) -> DataFrame:
    """Rows whose key is not stored yet; rows with a null key are new."""
    keys = [keys] if isinstance(keys, str) else keys
    return df.join(stored.select(*keys), keys, "left_anti")


def _seen_before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pass in order over rows of (order, a, b): the order of each row that is kept."""
    had: tuple[set, set] = (set(), set())
    for batch in batches:
        keep = []
        for pair in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            ok = not any(v is not None and v in known for v, known in zip(pair, had, strict=True))
            keep.append(ok)
            if ok:
                for v, known in zip(pair, had, strict=True):
                    known.add(v)
        yield batch.select([0]).filter(pa.array(keep, pa.bool_()))


def _plain(v):
    """A value that Python sorts as Spark does: of a struct the tuple of its members."""
    return tuple(map(_plain, v.values())) if isinstance(v, dict) else v


def _round(rows: DataFrame, a: str, b: str, order: str) -> tuple[DataFrame, DataFrame]:
    """(rows that are first for both their values, rows that share no value with one of them)."""
    first_a = rows.filter(F.col(a).isNotNull()).groupBy(a).agg(F.min(order).alias("_fa"))
    first_b = rows.filter(F.col(b).isNotNull()).groupBy(b).agg(F.min(order).alias("_fb"))
    own = lambda first: F.col(first).isNull() | (F.col(first) == F.col(order))
    win = staged(rows.join(first_a, a, "left").join(first_b, b, "left").filter(own("_fa") & own("_fb")).select(order, a, b))
    left = rows.join(win.select(order), order, "left_anti")
    for c in (a, b):
        left = left.join(win.filter(F.col(c).isNotNull()).select(c), c, "left_anti")
    return win, staged(left.select(order, a, b))


def _by_component(rows: DataFrame, a: str, b: str, order: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(what the pass keeps of components of at most `most` rows, the rows of larger components)."""
    node = lambda c: F.concat(F.lit(f"{'ab'[c == b]}:"), F.col(c).cast("string"))
    roots = components(rows.select(node(a).alias("a"), node(b).alias("b")))
    one = rows.withColumn("node", F.coalesce(node(a), node(b), F.lit("")))
    in_one = staged(one.join(roots, "node", "left").select(order, a, b, F.coalesce("root", "node").alias("_root")))
    large = in_one.groupBy("_root").agg(F.count("*").alias("n")).filter(F.col("n") > most).select("_root")

    def kept(table: pa.Table) -> pa.Table:
        keys = [_plain(v) for v in table.column(order).to_pylist()]
        batches = table.select([order, a, b]).take(sorted(range(len(keys)), key=keys.__getitem__)).combine_chunks().to_batches()
        return pa.Table.from_batches(_seen_before(batches), schema=pa.schema([table.schema.field(order)]))

    small = in_one.join(large, "_root", "left_anti").groupBy("_root").applyInArrow(kept, rows.select(order).schema)
    return staged(small), staged(in_one.join(large, "_root", "left_semi").select(order, a, b))


def two_keys(df: DataFrame, a: str, b: str, order: str) -> DataFrame:
    """The rows that a pass in order keeps which drops a row if a kept row has its value of a or of b.

    At most ONE_TASK rows are passed over in order by one task. More go through ROUNDS rounds first: a row that is first
    for both its values is kept, rows that share a value with it are dropped, which leaves little unless values form long
    chains. What is still more than ONE_TASK then is cut into connected components (their rounds grow with the logarithm of
    a chain's length), each of which is passed over by a task of its own; only components of more than ONE_TASK rows go
    through rounds again. Null values match nothing. order must be unique and without nulls.
    """
    spark, kind = df.sparkSession, df.select(order).schema
    with scoped(spark) as scope:
        rows, kept = staged(df.select(order, a, b)), []
        while (n := rows.count()) > ONE_TASK:
            for _ in range(ROUNDS):
                win, rows = _round(rows, a, b, order)
                kept.append(win.select(order))
            if rows.count() > ONE_TASK:
                small, rows = _by_component(rows, a, b, order, ONE_TASK)
                kept.append(small)
        if n:
            kept.append(rows.repartition(1).sortWithinPartitions(order).mapInArrow(_seen_before, kind))
        found = scope.keep(reduce(DataFrame.unionByName, kept) if kept else rows.select(order))
    return df.join(found, order, "left_semi")


def with_fingerprint(df: DataFrame, url: str, name: str = "url_fingerprint") -> DataFrame:
    return df.withColumn(name, url_fingerprint(F.col(url)))


def batch_to_save(rows: DataFrame, stored: DataFrame | None, order: str, name: str | None = None, key: str = "url_fingerprint") -> DataFrame:
    """What of a batch is inserted: first wins within it (by key, and by name too if given), less what is stored."""
    inner = first_wins(rows, key, order) if name is None else two_keys(rows, key, name, order)
    if stored is None:
        return inner
    inner = new_rows(inner, stored, key)
    return inner if name is None else new_rows(inner, stored, name)


def save_batch(rows: DataFrame, path: str, order: str, name: str | None = None, key: str = "url_fingerprint", dry_run: bool = False) -> tuple[int, int]:
    """(inserted, duplicates) of appending a batch to a Parquet table; a dry run writes nothing and counts the same."""
    from tessera.operators.state import read_or_none

    spark = rows.sparkSession
    held = read_or_none(spark, path)
    new = staged(batch_to_save(rows, held, order, name, key))
    inserted, total = new.count(), rows.count()
    if not dry_run and inserted:
        new.write.mode("append").parquet(path)
    return inserted, total - inserted


def exists(df: DataFrame, stored: DataFrame, key: str = "url_fingerprint") -> DataFrame:
    """df with `is_stored`: whether its key is in stored, by one join for all rows."""
    return df.join(stored.select(key).distinct().withColumn("is_stored", F.lit(True)), key, "left").fillna(False, ["is_stored"])
