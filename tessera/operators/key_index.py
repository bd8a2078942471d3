"""An index of stored keys that a small batch probes without reading all of them.

Keys (kind, key) lie in BUCKETS folders by a hash. Every batch adds, for each bucket it touches, Bloom filters of 32,768 bits over
at most about KEYS_A_FILTER of its keys each. A probe tests its keys against the filters, which are a byte or so a key, and reads the
keys of only those buckets that may hold one of them (partition pruning); there a semi join decides exactly, so a filter that
is wrong costs a read and never a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.existence import Keys, tagged
from tessera.operators.sink import BatchSink
from tessera.operators.state import broadcast_if_small, read_or_none

BUCKETS, KEYS_A_FILTER, PROBES = 64, 3000, 5
_BITS = 32_768


def _hashes() -> tuple[Column, Column]:
    """The hash that places a key and the one that gives its bits."""
    return F.xxhash64("kind", "key"), F.xxhash64("key", "kind")


def bucket(buckets: int = BUCKETS) -> Column:
    return F.pmod(_hashes()[0], F.lit(buckets)).cast("int")


def _part(filters: Column) -> Column:
    """Which of the filters of a bucket a key belongs to."""
    return F.pmod(F.shiftright(_hashes()[0], 20), filters)


def _bits() -> list[Column]:
    """The bits of a key."""
    return [F.pmod(F.shiftright(_hashes()[1], 12 * i), F.lit(_BITS)) for i in range(PROBES)]


def filters(keys: DataFrame) -> DataFrame:
    """bucket, filters (of that bucket in this batch), part, bits for keys (kind, key, bucket)."""
    sizes = keys.groupBy("bucket").agg(F.ceil(F.count("*") / KEYS_A_FILTER).alias("filters"))
    set_ = keys.join(F.broadcast(sizes), "bucket").withColumn("part", _part(F.col("filters"))).select("bucket", "filters", "part", F.explode(F.array(*_bits())).alias("bit"))
    return set_.groupBy("bucket", "filters", "part").agg(F.bitmap_construct_agg("bit").alias("bits"))


def may_hold(asked: DataFrame, held: DataFrame) -> DataFrame:
    """Keys (kind, key, bucket) that some filter may hold: all that are stored, and few others."""
    byte = lambda b: F.conv(F.hex(F.substring(F.col("bits"), (F.floor(b / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    test = F.lit(True)
    for b in _bits():
        test = test & (byte(b).bitwiseAND(F.call_function("shiftleft", F.lit(1), F.pmod(b, F.lit(8)).cast("int"))) != 0)
    other = held.withColumnRenamed("bucket", "_bucket")
    same = (F.col("bucket") == F.col("_bucket")) & (F.col("part") == _part(F.col("filters")))
    return asked.join(broadcast_if_small(other, 5000), same).filter(test).select("kind", "key", "bucket").distinct()


class KeyIndex:
    """The keys of a table that a sink writes: tables <name>/keys and <name>/filters of the same sink, so that they are
    committed with the rows. buckets stays as it was at first."""

    def __init__(self, sink: BatchSink, name: str, buckets: int = BUCKETS) -> None:
        self.sink, self.name, self.buckets = sink, name, buckets

    @staticmethod
    def tables(name: str) -> list[str]:
        return [f"{name}/keys", f"{name}/filters"]

    def stored(self, asked: DataFrame) -> DataFrame | None:
        """The stored keys of the buckets that may hold one of the asked keys (kind, key); none: there is no such bucket."""
        spark = asked.sparkSession
        held = read_or_none(spark, f"{self.sink.folder}/{self.name}/filters")
        if held is None:
            return None
        maybe = may_hold(asked.distinct().withColumn("bucket", bucket(self.buckets)), held)
        hit = [r["bucket"] for r in maybe.select("bucket").distinct().collect()]  # at most `buckets`
        if not hit:
            return None
        return spark.read.parquet(f"{self.sink.folder}/{self.name}/keys").filter(F.col("bucket").isin(sorted(hit))).select("kind", "key")

    def new_rows(self, rows: DataFrame, own: Keys, row: str) -> DataFrame:
        """rows of which no key is stored; `row` is unique and not null."""
        asked = tagged(rows, own, row)
        stored = self.stored(asked.select("kind", "key"))
        return rows if stored is None else rows.join(asked.join(stored, ["kind", "key"], "left_semi").select(row).distinct(), row, "left_anti")

    def add(self, token: str, rows: DataFrame, own: Keys) -> None:
        """Adds the keys of a batch's rows."""
        keys = tagged(rows, own).distinct().withColumn("bucket", bucket(self.buckets))
        self.sink.write(f"{self.name}/keys", token, keys.repartition("bucket"), ["bucket"])
        self.sink.write(f"{self.name}/filters", token, filters(self.sink.read(f"{self.name}/keys", token)).coalesce(1))
