"""WARC archives as seekable Zstandard bundles.

A bundle is the whole of a .warc.zst file: independent frames that hold whole records, and at its end a skippable frame
with the seek table (sizes of every frame, as in the seekable format of Zstandard). The index maps each record to its
bundle, frame, and offset inside the frame, so one record is read by decompressing one frame.

Bundles are rows of a table in the shared folder: written by Spark's own committer, they survive lost executors and need
no file system but Spark's. `export` turns them into files where a folder is mounted on all machines.
Payloads that are equal are stored once: the record of the smallest id is the response, the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batched, stored, text_batches

#: Bytes of records in a frame and of frames in a bundle, more only where one record is larger.
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 4 << 20
DATE = "1970-01-01T00:00:00Z"
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(key, number: int, url: str | None, payload: bytes, refers_to=None, refers_to_url: str | None = None, date: str = DATE) -> bytes:
    """One WARC record. Its id is the key and a number that no other row has, as keys may be null or repeat.

    refers_to, if not None, makes it a revisit, which carries no payload: it names the response by its key (in a field of
    this format's own) and by its target URI and date, as a record id that is not unique could not.
    """
    own = "" if key is None else key
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{own}:{number}>"), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", _uri(url)))
    head.append(("WARC-Payload-Digest", f"sha1:{digest(payload)}"))
    block = _HTTP % len(payload)
    if refers_to is None:
        block += payload
    else:
        head += [("X-Refers-To-Page", str(refers_to)), *([("WARC-Refers-To-Target-URI", _uri(refers_to_url))] if refers_to_url is not None else []), ("WARC-Refers-To-Date", date), ("WARC-Profile", _PROFILE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *[f"{k}: {v}\r\n" for k, v in head], "\r\n"]).encode() + block + b"\r\n\r\n"


def parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and payload of the record at this offset, and where the next one begins."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError(f"no WARC record at {at}")
    head = dict(x.split(": ", 1) for x in lines)
    start, size = end + 4, int(head["Content-Length"])
    block = data[start : start + size]
    return head, block[block.index(b"\r\n\r\n") + 4 :], start + size + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *x) for x in sizes) + struct.pack("<IBI", len(sizes), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


def frames(archive: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, size) of each frame, from the seek table at the archive's end."""
    n, _, magic = struct.unpack("<IBI", archive[-9:])
    if magic != _SEEKABLE:
        raise ValueError("no seek table")
    at, out = 0, []
    for i in range(n):
        packed, size = struct.unpack_from("<II", archive, len(archive) - 9 - 8 * (n - i))
        out.append((at, packed, size))
        at += packed
    return out


def read_frame(archive: bytes, frame: int) -> bytes:
    at, packed, size = frames(archive)[frame]
    return zstandard.ZstdDecompressor().decompress(archive[at : at + packed], max_output_size=max(1, size))


def read_record(archive: bytes, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry: decompresses one frame."""
    return parse(read_frame(archive, frame), offset)[:2]


def _bundles(batches: Iterator[pa.RecordBatch], date: str, frame_bytes: int, bundle_bytes: int) -> Iterator[tuple]:
    from pyspark import TaskContext

    packer, number = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId() << 40
    raw, archive, sizes, index = bytearray(), bytearray(), [], []

    def close() -> None:
        packed = packer.compress(bytes(raw))
        archive.extend(packed)
        sizes.append((len(packed), len(raw)))
        raw.clear()

    for b in batches:
        for key, url, html, refers, at, revisit in zip(*(b.column(i) for i in range(6)), strict=True):
            key, number = key.as_py(), number + 1
            one = record(key, number, url.as_py(), (html.as_py() or "").encode(), refers.as_py() if revisit.as_py() else None, at.as_py(), date)
            index.append({"key": key, "frame": len(sizes), "offset": len(raw), "length": len(one)})
            raw.extend(one)
            if len(raw) >= frame_bytes:
                close()
            if len(archive) >= bundle_bytes:
                yield bytes(archive) + seek_table(sizes), index
                archive.clear()
                sizes, index = [], []
    if raw:
        close()
    if sizes:
        yield bytes(archive) + seek_table(sizes), index


def write(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0, date: str = DATE) -> DataFrame:
    """A stored table of bundles: name, archive, index (array of key, frame, offset, length).

    key must be a long. A null html is an empty payload, a null url leaves its header out, control characters in a url are
    percent-encoded. Payloads of at least `least` bytes are stored once: rows of the smallest key hold them (if that key
    occurs more than once with one payload, each of its rows does), rows with a larger or null key revisit that key; if all
    keys of a payload are null, all are responses. Equality is that of the SHA-1 and the length.
    """
    text_batches(pages.sparkSession)
    d, n, first, of = "digest", "bytes", "first", "of"
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"), F.sha1(body).alias(d), F.octet_length(body).alias(n))
    firsts = rows.filter(F.col(n) >= least).groupBy(d, n).agg(F.min(F.when(F.col("key").isNotNull(), F.struct("key", "url"))).alias(first), F.count("*").alias(of)).filter((F.col(of) > 1) & F.col(first).isNotNull()).drop(of)
    firsts = stored(firsts)
    joined = rows.join(firsts, [d, n], "left")
    revisit = F.col(first).isNotNull() & ~F.col("key").eqNullSafe(F.col(f"{first}.key"))
    ready = joined.select("key", "url", "html", F.when(revisit, F.col(f"{first}.key")).alias("refers"), F.when(revisit, F.col(f"{first}.url")).alias("at"), revisit.alias("revisit"))
    entry = pa.struct([("key", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])
    schema = pa.schema([("archive", pa.binary()), ("index", pa.list_(entry))])
    frame, bundle = FRAME_BYTES, BUNDLE_BYTES
    made = ready.mapInArrow(batched(lambda b: _bundles(b, date, frame, bundle), schema, rows=1), "archive binary, index array<struct<key: long, frame: int, offset: long, length: long>>")
    return stored(made.select(F.concat(F.sha1("archive"), F.lit(".warc.zst")).alias("name"), "archive", "index"))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    opener = zstandard.ZstdDecompressor()
    number = lambda x: int(x) if (x := x[len("<urn:page:") : x.rindex(":")]) else None
    for b in batches:
        for name, archive in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            archive = archive.as_py()
            for frame, (start, packed, size) in enumerate(frames(archive)):
                data, at = opener.decompress(archive[start : start + packed], max_output_size=max(1, size)), 0
                while at < len(data):
                    offset = at
                    head, payload, at = parse(data, at)
                    kind, said = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and digest(payload) != said:
                        raise ValueError(f"{name}, frame {frame}, offset {offset}: the payload has another digest")
                    refers = int(head["X-Refers-To-Page"]) if "X-Refers-To-Page" in head else None
                    yield number(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), kind, said, len(payload) if kind == "response" else None, refers, name, frame, offset


def read(bundles: DataFrame) -> DataFrame:
    """A row per record of the bundles, every payload checked against its digest: key, url, record_type, payload_digest,
    payload_bytes, refers_to, name, frame, offset. A revisit has the payload_bytes of the response with its digest."""
    schema = pa.schema([("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("name", pa.string()), ("frame", pa.int32()), ("offset", pa.int64())])
    rows = bundles.select("name", "archive").mapInArrow(batched(_records, schema), "key long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, name string, frame int, offset long")
    rows = stored(rows)
    revisits = rows.filter("record_type = 'revisit'")
    wanted = revisits.select(F.col("refers_to").alias("key")).distinct()
    held = rows.filter("record_type = 'response'").join(wanted, "key", "left_semi")
    sizes = held.groupBy(F.col("key").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("size"))
    joined = revisits.join(sizes, ["refers_to", "payload_digest"], "left").withColumn("payload_bytes", F.col("size")).select(*rows.columns)
    return rows.filter("record_type = 'response'").unionByName(joined)


def export(bundles: DataFrame, folder: str) -> int:
    """Writes every bundle as a file of a folder that all machines mount; how many. Run again, it gives the same files."""

    def put(rows: Iterator) -> Iterator:
        for r in rows:
            part = os.path.join(folder, f".{r['name']}.{os.getpid()}")
            with open(part, "wb") as f:
                f.write(r["archive"])
            os.replace(part, os.path.join(folder, r["name"]))
            yield 1

    os.makedirs(folder, exist_ok=True)
    return bundles.select("name", "archive").rdd.mapPartitions(put).sum()
