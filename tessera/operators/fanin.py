"""Union of sources with limits and offsets, and counts by source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.state import staged


def numbered(df: DataFrame, order: str | list[str], name: str = "n") -> DataFrame:
    """df with the place of each row in order, from 0: as row_number over all rows, without taking them to one task.

    Rows are dealt by range of the order, as many partitions as the session shuffles to, sorted there and written; rows of a
    partition are counted, and what partitions before it hold is added to its own numbers. Only those counts, one a
    partition, go through a single task. Rows that tie in order are numbered in any order among themselves.
    """
    keys = [order] if isinstance(order, str) else order
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The partition is kept as a column, as written files may be read in other splits.
    dealt = staged(df.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))  # a row a partition
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*keys)) - 1
    return dealt.withColumn("_own", own).join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_own")).drop("_part", "_start", "_own")


def sliced(df: DataFrame, limit: int, offset: int = 0, order: str = "ord", by: str | None = None) -> DataFrame:
    """Rows offset + 1 to offset + limit in order (within each value of `by`, if given); past the end there are none."""
    if by is None and offset:
        return numbered(df, order, "_n").filter((F.col("_n") >= offset) & (F.col("_n") < offset + limit)).drop("_n")
    if by is None:
        return df.orderBy(order).limit(limit)  # each partition keeps `limit` rows
    n = F.row_number().over(Window.partitionBy(by).orderBy(order))
    return df.withColumn("_n", n).filter((F.col("_n") > offset) & (F.col("_n") <= offset + limit)).drop("_n")


def from_place(df: DataFrame, offset: int, order: str = "ord") -> DataFrame:
    """All rows after the first `offset` in order."""
    return numbered(df, order, "_n").filter(F.col("_n") >= offset).drop("_n") if offset else df


def share(limit: int, sources: int, least: int = 1) -> int:
    """Rows that each source may give: its part of the limit, rounded up."""
    return max(least, -(-limit // max(1, sources)))


def fan_in(sources: dict[str, DataFrame], limit: int, offset: int | dict[str, int] = 0, least: int = 1, order: str = "ord") -> DataFrame:
    """The union of sources (by key, in this order) with source_key, each from its own offset and by its share, then the limit."""
    k = share(limit, len(sources), least)
    at = lambda name: offset.get(name, 0) if isinstance(offset, dict) else offset
    parts = [sliced(df, k, at(name), order).withColumns({"source_key": F.lit(name), "_source": F.lit(i)}) for i, (name, df) in enumerate(sources.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).orderBy("_source", order).limit(limit).drop("_source")


def source_metrics(rows: DataFrame, requested: dict[str, int], source: str = "source_key", failed: str | None = None) -> DataFrame:
    """requested, discovered and failed of every source that was asked, also of those without rows."""
    spark = rows.sparkSession
    asked = spark.createDataFrame(list(requested.items()), f"{source} string, requested int")
    bad = F.count_if(F.col(failed)) if failed else F.lit(0).cast("long")
    found = rows.groupBy(source).agg(F.count("*").alias("discovered"), bad.alias("failed"))
    return asked.join(found, source, "left").fillna(0, ["discovered", "failed"])
