import hashlib
import base64

import zstandard

from tessera.llm import queries, warc

ROWS = [
    (5, "http://a/1", "<p>x</p>", "d"), (3, "http://a/2", "<p>x</p>", "d"), (9, None, "<p>x</p>", "d"), (1, "http://b/ä b\r\nEvil: 1", "é" * 300_000, "d"),
    (2, "http://c", None, "d"), (4, "http://d", "", "d"), (7, "http://e", "WARC/1.1\r\n\r\nfake\r\n\r\n", "d"), (3, "http://a/2", "<p>x</p>", "d"), (None, "http://n", "<p>x</p>", "d"),
    (None, "http://n", "only null", "d"), (None, "http://n", "only null", "d"),
]


def expected(rows, least=0):
    firsts = {}
    for k, _, h, *_ in rows:
        b = (h or "").encode()
        if k is not None:
            firsts[b] = min(firsts.get(b, k), k)
    out = []
    for k, _, h, *_ in rows:
        b = (h or "").encode()
        again = len(b) >= least and firsts.get(b) is not None and firsts[b] != k
        out.append((k, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", firsts[b] if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 300)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 400)
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string, digest string").repartition(2)
    for least in (0, 5):
        bundles = warc.write(pages, least=least)
        got = warc.read(bundles).collect()
        assert sorted(((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == expected(ROWS, least)
    archives = {r.name: r for r in bundles.collect()}
    payloads = {(k, h or "") for k, _, h, _ in ROWS}
    n, ids, found = 0, set(), {}
    for b in archives.values():
        for e in b["index"]:
            head, payload = warc.read_record(bytes(b.archive), e.frame, e.offset)
            assert head["WARC-Record-ID"].startswith(f"<urn:page:{'' if e.key is None else e.key}:") and "Evil" not in head
            ids.add(head["WARC-Record-ID"])
            found.setdefault((head.get("WARC-Target-URI"), head["WARC-Payload-Digest"]), set()).add(head["WARC-Type"])
            if head["WARC-Type"] == "revisit" and "WARC-Refers-To-Target-URI" in head:
                assert head["WARC-Refers-To-Target-URI"] in ("http://a/2", "http://c")
            assert head["WARC-Type"] == "revisit" or (e.key, payload.decode()) in payloads
            n += 1
        # A plain reader that knows nothing of the seek table gets all records.
        whole = b"".join(warc.read_frame(bytes(b.archive), i) for i in range(len(warc.frames(bytes(b.archive)))))
        assert zstandard.ZstdDecompressor().stream_reader(bytes(b.archive), read_across_frames=True).read() == whole
    assert n == len(ROWS) == len(ids), "every record has an id of its own, also rows that repeat a key or have none"
    assert any("response" in kinds for (uri, _), kinds in found.items() if uri == "http://a/2")


def test_export(spark, tmp_path):
    bundles = warc.write(spark.createDataFrame(ROWS, "page_id long, url string, html string, digest string"))
    assert warc.export(bundles, str(tmp_path)) == bundles.count() == warc.export(bundles, str(tmp_path))
    assert {p.name: p.read_bytes() for p in tmp_path.iterdir()} == {r.name: bytes(r.archive) for r in bundles.collect()}


def test_empty(spark):
    assert warc.read(warc.write(spark.createDataFrame([], "page_id long, url string, html string"))).collect() == []


def test_query(spark, sf):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = queries.op5_warc(spark, sf).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == expected(rows)
