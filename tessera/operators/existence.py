"""Whether rows are stored already, by any of several kinds of keys: one equi join on (kind, key) in place of a join with `or`."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: By kind, the columns that hold a key of that kind. A row may have several keys of one kind.
Keys = Mapping[str, Sequence[str | Column]]


def tagged(rows: DataFrame, keys: Keys, *carried: str) -> DataFrame:
    """carried columns, kind, key (as a string): a row for each key of each row; null and blank keys are none."""
    each = [F.struct(F.lit(kind).alias("kind"), (F.col(c) if isinstance(c, str) else c).cast("string").alias("key")) for kind, columns in keys.items() for c in columns]
    real = F.filter(F.array(*each), lambda k: F.length(F.trim(k["key"])) > 0)
    return rows.select(*carried, F.explode(F.array_distinct(real)).alias("_k")).select(*carried, "_k.kind", "_k.key")


def found(rows: DataFrame, stored: DataFrame, own: Keys, row: str, held: Keys | None = None) -> DataFrame:
    """The values of `row` (unique in rows, not null) whose row shares a key of one kind with a stored row.

    Only (row, kind, key) is shuffled; stored keys are on the right of a semi join, so they need not be distinct, and a
    frequent key of the left is a skew that Spark splits. held names the columns of stored, if they are others.
    """
    return tagged(rows, own, row).join(tagged(stored, own if held is None else held), ["kind", "key"], "left_semi").select(row).distinct()


def exists(rows: DataFrame, stored: DataFrame, own: Keys, row: str, held: Keys | None = None) -> DataFrame:
    """rows with `is_stored`: whether a stored row has any of its keys."""
    hit = found(rows, stored, own, row, held).withColumn("is_stored", F.lit(True))
    return rows.join(hit, row, "left").fillna(False, ["is_stored"])


def new_rows(rows: DataFrame, stored: DataFrame, own: Keys, row: str, held: Keys | None = None) -> DataFrame:
    """rows of which no stored row has any key; rows without a key are new."""
    return rows.join(found(rows, stored, own, row, held), row, "left_anti")
