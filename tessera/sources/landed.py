"""Landed payloads: one file a payload, read as a table or as a stream; positions of paged and segmented sources."""

from __future__ import annotations

from urllib.parse import urlencode

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """path, modified, payload of every file of a folder; a source lands in the folder of its key."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("payload"))


#: Bytes of a batch: a batch has a fixed cost, so many small files go together.
BATCH_BYTES = 64 << 20


def payload_stream(spark: SparkSession, path: str, files_a_batch: int | None = None) -> DataFrame:
    """The same as a stream that takes so many new files a batch, by default those of BATCH_BYTES."""
    most = ("maxBytesPerTrigger", BATCH_BYTES) if files_a_batch is None else ("maxFilesPerTrigger", files_a_batch)
    files = spark.readStream.schema("value string").option("wholetext", True).option("recursiveFileLookup", True).option(*most).text(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload"))


def source_key(path, vertical: str | None = None):
    """The source of a payload: the folder below that of the vertical, or without one the folder that the file is in."""
    return F.regexp_extract(path, f"^.*/{vertical}/([^/]+)/", 1) if vertical else F.element_at(F.split(path, "/"), -2)


def paper_query(query: str = "cat:cs.AI", start: int = 0, most: int = 50) -> str:
    """URL of a page of the paper search, newest first."""
    return "http://export.arxiv.org/api/query?" + urlencode({"search_query": query, "start": start, "max_results": most, "sortBy": "submittedDate", "sortOrder": "descending"})


def organisation_segment(offset: int, queries: int = 10, pages: int = 10, size: int = 50) -> tuple[int, int, int]:
    """(query, page from 1, rows to skip on it) of a flat offset into a segmented search."""
    return offset // (pages * size) % queries, offset % (pages * size) // size + 1, offset % size


def repository_segment(segment: int, page: int, returned: int, segments: int = 20, size: int = 50, most: int = 10) -> tuple[int, int, bool]:
    """(segment, page, exhausted) that follow a page: the next page, or the next segment after a short page or the last one."""
    if returned >= size and page < most:
        return segment, page + 1, False
    return (segment + 1) % segments, 1, segment + 1 >= segments


def organisation_position(offset, queries: int = 10, pages: int = 10, size: int = 50):
    """`organisation_segment` of a column of offsets: struct<segment, page, skip>."""
    return F.struct((F.floor(offset / (pages * size)) % queries).alias("segment"), (F.floor(offset % (pages * size) / size) + 1).alias("page"), (offset % size).alias("skip"))


def repository_position(segment, page, returned, segments: int = 20, size: int = 50, most: int = 10):
    """`repository_segment` of columns: struct<segment, page, exhausted>."""
    stays = (returned >= size) & (page < most)
    return F.struct(F.when(stays, segment).otherwise((segment + 1) % segments).alias("segment"), F.when(stays, page + 1).otherwise(1).alias("page"), (~stays & (segment + 1 >= segments)).alias("exhausted"))


def paper_queries(start, query: str = "cat:cs.AI", most: int = 50):
    """`paper_query` of a column of first rows."""
    head, tail = paper_query(query, 0, most).split("start=0")
    return F.concat(F.lit(f"{head}start="), start.cast("string"), F.lit(tail))
