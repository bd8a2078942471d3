"""What the operators of this subpackage share: scratch tables, Arrow helpers, shuffle width."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.operators.state import scoped, scratch, staged as stored, unstaged  # noqa: F401 - shared with the operators


#: Rows of an Arrow batch between the JVM and Python: texts are long, and both sides hold a batch.
BATCH_ROWS = 1000


def hash_bound(share: float) -> int:
    """The 64-bit number up to which a share (0 to 1) of all signed 64-bit hashes lies: no positive share is empty."""
    return max(-(1 << 63), min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63) - 1))


def text_batches(spark: SparkSession) -> None:
    """Sets the session to batches of at most BATCH_ROWS rows, unless it has smaller ones.

    Spark reads the setting when a plan runs, which is after an operator has returned its frame, so it stays set: an
    operator that runs its Python stages at once could set it back, one that returns a lazy frame can't. Batches are bounded
    in bytes too, by Spark's own spark.sql.execution.arrow.maxBytesPerBatch.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


#: Partitions of a shuffle, at most: files of a shuffle grow with their square. 100 TB are 2.5 GB a partition then, which sorts and spills.
MOST_PARTITIONS = 40_000


def width(df: DataFrame) -> int:
    """Partitions for a shuffle that carries what df reads: as many as a scan of it has, up to MOST_PARTITIONS, or the
    session's number if that is larger.

    Asks the optimised plan for the sizes of its sources; it runs nothing, which asking for an RDD's partitions may.
    """
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    scans = max([-(-n // split) for n in sizes if n < 1 << 60], default=1)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(scans, MOST_PARTITIONS), 1)


def batched(build: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]], schema: pa.Schema, rows: int = 4096, size: int = 16 << 20):
    """A mapInArrow function from one that yields tuples; a batch goes out at so many rows or bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = [], 0
        for row in build(batches):
            held.append(row)
            weight += sum(len(x) if isinstance(x, (bytes, str, list)) else 8 for x in row)
            if len(held) >= rows or weight >= size:
                yield to_batch(held, schema)
                held, weight = [], 0
        if held:
            yield to_batch(held, schema)
        release()

    return run


def release() -> None:
    """Gives freed memory back to the system: a Python worker that waits for its next task keeps it else."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores before it until df has no such column (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def pairs(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch as tuples of Python values."""
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def broadcast_if_small(df: DataFrame, row_bytes: int = 128, most: int = 16 << 20) -> DataFrame:
    """df, stored, with a broadcast hint if its rows, counted, take at most so many bytes; else Spark shuffles it."""
    from pyspark.sql import functions as F

    df = stored(df)
    return F.broadcast(df) if df.count() * row_bytes <= most else df
