"""Keyed tables on plain Parquet: upserts, sets, deletes, checkpoints of runs, uniqueness. A change writes a new version of
the table beside the old one and then moves a pointer, so a reader sees one version or the other."""

from __future__ import annotations

import contextlib
import re
import tempfile
import threading
import time
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SCOPES = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it (spark.checkpoint.dir).

    Where it names none, a new local folder is set, but only in local mode, as in tests: on a cluster that is an error, as
    executors would write where nobody else reads.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        made = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = made.get() if made.isDefined() else None
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder; the innermost open scope, if there is one, deletes what is there when it ends."""
    path = f"{shared_folder(spark)}/tessera/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    if open_ := getattr(_SCOPES, "open", None):
        open_[-1].append(path)
    return path


def staged(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """df as a table in the shared folder: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def broadcast_if_small(df: DataFrame, row_bytes: int = 128, most: int = 16 << 20) -> DataFrame:
    """df, staged, with a broadcast hint if its rows, counted, take at most so many bytes; else Spark shuffles it."""
    df = staged(df)
    return F.broadcast(df) if df.count() * row_bytes <= most else df


def deleted(spark: SparkSession, paths: list[str]) -> None:
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unstaged(df: DataFrame) -> None:
    """Deletes the table of a frame that `staged` gave, once nothing is computed from it any more."""
    if path := getattr(df, "_staged_at", None):
        deleted(df.sparkSession, [path])


class Scope:
    """What is staged inside is deleted at the end, but for what `keep` returns: that is staged outside."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def keep(self, df: DataFrame) -> DataFrame:
        mine = _SCOPES.open.pop()
        try:
            return staged(df)
        finally:
            _SCOPES.open.append(mine)


@contextlib.contextmanager
def scoped(spark: SparkSession) -> Iterator[Scope]:
    """A scope of staged tables: results of an iteration or an operator outlive it, its intermediate tables do not."""
    if not hasattr(_SCOPES, "open"):
        _SCOPES.open = []
    _SCOPES.open.append([])
    try:
        yield Scope(spark)
    finally:
        deleted(spark, _SCOPES.open.pop())


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None if there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


class VersionedTable:
    """A table in versions below a path; the newest committed version is the table."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def versions(self) -> list[int]:
        fs, path = self._fs()
        if not fs.exists(path(self.path)):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path(self.path))]
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and fs.exists(path(f"{self.path}/{n}/_SUCCESS")))

    def read(self) -> DataFrame | None:
        v = self.versions()
        return self.spark.read.parquet(f"{self.path}/v{v[-1]}") if v else None

    def overwrite(self, df: DataFrame, keep: int = 2) -> DataFrame:
        """Writes a new version; versions before the last `keep` go."""
        before = self.versions()
        new = max([*before, time.time_ns() // 1000 - 1]) + 1
        df.write.parquet(f"{self.path}/v{new}")
        fs, path = self._fs()
        for v in [*before, new][:-keep]:
            fs.delete(path(f"{self.path}/v{v}"), True)
        return self.read()

    def upsert(self, rows: DataFrame, keys: str | list[str]) -> DataFrame:
        held = self.read()
        return self.overwrite(rows if held is None else upserted(held, rows, keys))

    def delete(self, condition: Column | str) -> int:
        """Deletes rows; how many."""
        held = self.read()
        if held is None:
            return 0
        gone = held.filter(condition).count()
        if gone:
            self.overwrite(held.filter(~F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))))
        return gone


def upserted(held: DataFrame, rows: DataFrame, keys: str | list[str]) -> DataFrame:
    """held with rows in place of those that have their keys; rows have one row a key."""
    keys = [keys] if isinstance(keys, str) else keys
    return held.join(rows.select(*keys), keys, "left_anti").unionByName(rows, allowMissingColumns=True)


def latest(rows: DataFrame, keys: str | list[str], order: str | list[str]) -> DataFrame:
    """The last row of each key in order, by an aggregate that sums on the map side."""
    keys = [keys] if isinstance(keys, str) else keys
    order = [order] if isinstance(order, str) else order
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*").select(*rows.columns)


def added_to_set(held: DataFrame, additions: DataFrame, key: str, values: str, value: str) -> DataFrame:
    """held with each addition (key, value) in its array `values`: trimmed, blank ones left out, once each, old ones first."""
    new = additions.select(key, F.trim(value).alias("_v")).filter("_v <> ''").groupBy(key).agg(F.array_sort(F.collect_set("_v")).alias("_new"))
    joined = held.join(new, key, "left")
    return joined.withColumn(values, F.array_union(F.coalesce(values, F.array().cast("array<string>")), F.coalesce("_new", F.array().cast("array<string>")))).select(*held.columns)


def violations(df: DataFrame, keys: str | list[str]) -> DataFrame:
    """Keys that more than one row has (rows with a null in the key are free): the check of a unique index."""
    keys = [keys] if isinstance(keys, str) else keys
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


CHECKPOINT = "vertical string, source string, cursor string, segment int, page int, processed long, valid long, inserted long, duplicates long, invalid long, failed long, last_item string, status string, updated_at timestamp"


class Checkpoints:
    """Progress of runs by (vertical, source)."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.table = spark, VersionedTable(spark, path)

    def save(self, vertical: str, source: str, **more) -> None:
        row = {"vertical": vertical, "source": source, "status": "running", **{k: 0 for k in ("processed", "valid", "inserted", "duplicates", "invalid", "failed")}, **more}
        names = [c.split()[0] for c in CHECKPOINT.split(", ")]
        df = self.spark.createDataFrame([tuple(row.get(n) for n in names)], CHECKPOINT).withColumn("updated_at", F.coalesce("updated_at", F.current_timestamp()))
        self.table.upsert(df, ["vertical", "source"])

    def get(self, vertical: str, source: str):
        held = self.table.read()
        return None if held is None else held.filter((F.col("vertical") == vertical) & (F.col("source") == source)).first()

    def resume(self, vertical: str, source: str):
        """The checkpoint to go on from; a completed run starts anew."""
        row = self.get(vertical, source)
        return row if row is not None and row["status"] != "completed" else None

    def all(self) -> DataFrame | None:
        return self.table.read()

    def reset(self, vertical: str | None = None, source: str | None = None) -> int:
        where = F.lit(True)
        if vertical:
            where = where & (F.col("vertical") == vertical)
        if source:
            where = where & (F.col("source") == source)
        return self.table.delete(where)
