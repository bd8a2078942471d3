"""Paged, segmented sources as a Spark data source: `spark.read.format(...)` and `spark.readStream.format(...)`.

A source is a list of segments (queries) of numbered pages. A task asks for a range of pages of one segment, one after the other,
and stops at the first that fails or has no items; every answer is a row, a failure too. The batch reader deals all ranges out
at once. The stream reader's offset is a position (segment, page): a batch takes the next pages of its segment; at the page cap,
and after a page that ended a segment, the next batch begins the next segment.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tessera.sources.crawl import CrawlPolicy, fetch_one, urllib_transport
from tessera.sources.fetching import Paged

SCHEMA = "source string, segment int, page int, url string, payload string, items int, status int, error string"

#: Tasks of a batch read, about, where nobody says how many pages a task takes.
TASKS = 512


@dataclass
class Pages(InputPartition):
    """Pages of one segment, both ends included."""

    segment: int
    first: int
    last: int


def items_of(payload: str | None) -> int:
    """How many items a payload lists: the longest array of a JSON document (itself, or a member of its object), or the items and
    entries of an XML feed; 0 if it cannot be read."""
    text = (payload or "").lstrip()
    if text.startswith("<"):
        return len(re.findall(r"<(?:\w+:)?(?:item|entry)[\s>]", text))
    try:
        doc = json.loads(text)
    except ValueError:
        return 0
    found = [doc] if isinstance(doc, list) else list(doc.values()) if isinstance(doc, dict) else []
    return max((len(x) for x in found if isinstance(x, list)), default=0)


def folder_transport(url: str, headers: dict, timeout: float) -> tuple:
    """Answers from files: a URL is a folder on any file system that pyarrow knows, its answer what the files in it hold."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(url)
    files = [f for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.is_file and not f.base_name.startswith(("_", "."))]
    if not files:
        return 404, None, None, None
    parts = []
    for f in sorted(files, key=lambda f: f.base_name):
        with system.open_input_stream(f.path) as stream:
            parts.append(stream.read().decode("utf-8", "replace"))
    return 200, "".join(parts), "text/plain", None


class _State:
    """Small files in the shared folder by which tasks and the driver of a stream tell one another where it stands."""

    def __init__(self, folder: str) -> None:
        from pyarrow import fs

        self.system, self.path = fs.FileSystem.from_uri(folder)

    def put(self, name: str, text: str) -> None:
        self.system.create_dir(self.path, recursive=True)
        with self.system.open_output_stream(f"{self.path}/{name}.part") as out:
            out.write(text.encode())
        self.system.move(f"{self.path}/{name}.part", f"{self.path}/{name}")

    def get(self, name: str) -> str | None:
        try:
            with self.system.open_input_stream(f"{self.path}/{name}") as stream:
                return stream.read().decode()
        except FileNotFoundError:
            return None


def asked(name: str, source: Paged, part: Pages, policy: CrawlPolicy, transport: Callable, ended: Callable[[int, int], None] | None = None) -> Iterator[tuple]:
    """Rows of SCHEMA for a range of pages, up to the first that fails or has no items; that one is told to `ended`."""
    for page in range(part.first, part.last + 1):
        url = source.url(source.queries[part.segment], page)
        got = fetch_one(url, policy, transport)
        n = items_of(got["content"]) if got["success"] else 0
        yield name, part.segment, page, url, got["content"], n, got["status_code"], got["error"]
        if not n:
            if ended:
                ended(part.segment, page)
            return


class _Batch(DataSourceReader):
    def __init__(self, name: str, source: Paged, policy: CrawlPolicy, transport: Callable, options: dict) -> None:
        self.name, self.source, self.policy, self.transport = name, source, policy, transport
        self.segment, self.page = int(options.get("segment", 0)), int(options.get("page", 1))
        most = source.pages if source.pages is not None else int(options["pages"])
        self.last = min(most, int(options.get("pages", most)))
        asked = self.last * max(1, len(source.queries) - self.segment)
        self.task = int(options.get("pagesATask", max(4, -(-asked // TASKS))))

    def partitions(self) -> Sequence[Pages]:
        out = []
        for segment in range(self.segment, len(self.source.queries)):
            first = self.page if segment == self.segment else 1
            out += [Pages(segment, p, min(p + self.task - 1, self.last)) for p in range(first, self.last + 1, self.task)]
        return out

    def read(self, partition: Pages) -> Iterator[tuple]:
        return asked(self.name, self.source, partition, self.policy, self.transport)


class _Stream(DataSourceStreamReader):
    """Where it stands is kept in the folder of the option `state`, beside the checkpoint of the query: the end of the last batch
    that was planned, and the page that ended a segment. Spark's own log says which pages a repeated batch has."""

    def __init__(self, name: str, source: Paged, policy: CrawlPolicy, transport: Callable, options: dict) -> None:
        self.name, self.source, self.policy, self.transport = name, source, policy, transport
        self.start = {"segment": int(options.get("segment", 0)), "page": int(options.get("page", 1))}
        self.state, self.pages = options["state"], int(options.get("pagesABatch", 8))
        self.task = int(options.get("pagesATask", 4))
        held = _State(self.state).get("position")
        self.at = json.loads(held) if held else self.start

    def initialOffset(self) -> dict:
        return self.start

    def latestOffset(self) -> dict:
        segment, page = self.at["segment"], self.at["page"]
        most = self.source.pages
        if segment >= len(self.source.queries):
            return self.at
        if (most is not None and page > most) or _State(self.state).get(f"ended-{segment}"):
            segment, page = segment + 1, 1
            if segment >= len(self.source.queries):
                return {"segment": segment, "page": 1}
        end = page + self.pages
        return {"segment": segment, "page": end if most is None else min(end, most + 1)}

    def partitions(self, start: dict, end: dict) -> Sequence[Pages]:
        """A batch has pages of one segment: from where the last one ended, or from the first of the next segment."""
        self.at = max(self.at, end, key=lambda o: (o["segment"], o["page"]))
        _State(self.state).put("position", json.dumps(self.at))
        if end["segment"] >= len(self.source.queries):
            return []
        first = start["page"] if start["segment"] == end["segment"] else 1
        return [Pages(end["segment"], p, min(p + self.task, end["page"]) - 1) for p in range(first, end["page"], self.task)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        state = self.state
        return asked(self.name, self.source, partition, self.policy, self.transport, lambda segment, page: _State(state).put(f"ended-{segment}", str(page)))

    def commit(self, end: dict) -> None:
        _State(self.state).put("committed", json.dumps(end))


def register(spark: SparkSession, name: str, source: Paged, policy: CrawlPolicy | None = None, transport: Callable | None = None) -> str:
    """Registers a source as a format; its name.

    Options of a batch: segment and page to begin at, pages (the last page of every segment; needed where the source has no
    cap), pagesATask (by default 4, or more where that were over TASKS tasks). Of a stream: segment, page, pagesABatch, pagesATask and state, a folder that driver and executors share.
    """
    how = (name, source, policy or CrawlPolicy(), transport or urllib_transport)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return _Batch(*how, self.options)

        def streamReader(self, schema) -> DataSourceStreamReader:
            return _Stream(*how, self.options)

    spark.dataSource.register(Source)
    return name


def contiguous(rows: DataFrame) -> DataFrame:
    """Pages with items of each source and segment up to its first page without: what lies beyond that was asked for side by side
    and does not belong to it."""
    ends = rows.filter("items = 0").groupBy("source", "segment").agg(F.min("page").alias("_end"))
    return rows.filter("items > 0").join(F.broadcast(ends), ["source", "segment"], "left").filter(F.col("_end").isNull() | (F.col("page") < F.col("_end"))).drop("_end")
