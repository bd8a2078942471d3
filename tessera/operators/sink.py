"""Adding batches to plain Parquet tables once each, however often a batch is taken.

A batch writes below <table>/batch=<run>-<number>, into as many tables as it has, and is committed by a record of its counts that
appears at once. A batch that has a record is not written again; what a batch without one has left (its writer died between the
two) is deleted before it, or another run, reads or writes. So after a repeated batch tables are as after one, and its counts
are those of the first time.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.state import deleted


class BatchSink:
    """Tables below a folder, and the commits of a writer of them."""

    def __init__(self, spark: SparkSession, folder: str, writer: str, tables: list[str]) -> None:
        self.spark, self.folder, self.tables = spark, folder.rstrip("/"), tables
        self.commits = f"{self.folder}/commits/{writer}"

    def _path(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        at, fs = self._path(path)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    @staticmethod
    def token(run: str, batch: int) -> str:
        return f"{run}-{batch:09d}"

    def where(self, table: str, token: str) -> str:
        return f"{self.folder}/{table}/batch={token}"

    def committed(self, token: str) -> dict | None:
        """The counts of a committed batch."""
        at, fs = self._path(f"{self.commits}/{token}.json")
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def recover(self) -> list[str]:
        """Deletes what batches without a commit have left; their tokens."""
        done = {n.removesuffix(".json") for n in self._names(self.commits) if n.endswith(".json")}
        gone = set()
        for table in self.tables:
            left = [n.removeprefix("batch=") for n in self._names(f"{self.folder}/{table}") if re.match(r"batch=", n)]
            for token in set(left) - done:
                deleted(self.spark, [self.where(table, token)])
                gone.add(token)
        return sorted(gone)

    def begin(self, token: str) -> dict | None:
        """The counts of a batch that is committed; else none, after what an earlier try has left is deleted."""
        counts = self.committed(token)
        if counts is None:
            deleted(self.spark, [self.where(t, token) for t in self.tables])
        return counts

    def write(self, table: str, token: str, rows: DataFrame, by: list[str] | None = None) -> None:
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(self.where(table, token))

    def read(self, table: str, token: str) -> DataFrame:
        """What a batch wrote."""
        return self.spark.read.parquet(self.where(table, token))

    def drop(self, table: str, token: str) -> None:
        deleted(self.spark, [self.where(table, token)])

    def commit(self, token: str, counts: dict) -> None:
        """Makes the batch count: the record is written beside its place and then renamed."""
        part, fs = self._path(f"{self.commits}/_{uuid.uuid4().hex}")
        stream = fs.create(part, True)
        try:
            stream.write(bytearray(json.dumps(counts).encode()))
        finally:
            stream.close()
        if not fs.rename(part, self._path(f"{self.commits}/{token}.json")[0]):
            fs.delete(part, False)
            if self.committed(token) is None:
                raise OSError(f"{token} could not be committed")
