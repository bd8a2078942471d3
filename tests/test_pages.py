"""The paged data source: batch, stream, position, rotation."""

import json

from pyspark.sql import functions as F

from tessera.sources import pages
from tessera.sources.crawl import CrawlPolicy
from tessera.sources.fetching import Paged

POLICY = CrawlPolicy(backoff_base=0.0, jitter=False, retries=1)


def _write(folder, segment, page, items):
    at = folder / f"{segment}" / f"{page}"
    at.mkdir(parents=True)
    (at / "part-0").write_text(json.dumps({"items": items}))


def _source(folder, queries, cap=None):
    return Paged(lambda q, page: f"file://{folder}/{q}/{page}", 50, cap, queries)


def test_items_of():
    assert [pages.items_of(x) for x in ('{"data": [1, 2], "meta": [1]}', "[]", "[1]", None, "", "{broken", "<rss><item>a</item><item/></rss>", '<a:feed xmlns:a="x"><a:entry>1</a:entry></a:feed>', "3")] == [2, 0, 1, 0, 0, 0, 1, 1, 0]


def test_batch_reader(spark, tmp_path):
    """A task a range of pages; failures are rows; pages beyond the end of a segment don't count."""
    for page in (1, 2, 3, 5):
        _write(tmp_path, "a", page, [page, page])
    _write(tmp_path, "b", 1, [])
    name = pages.register(spark, "pages_batch", _source(tmp_path, ["a", "b", "none"]), POLICY, pages.folder_transport)
    rows = spark.read.format(name).option("pages", 6).option("pagesATask", 2).load()
    assert rows.rdd.getNumPartitions() == 9
    got = {(r.segment, r.page): (r.items, r.status) for r in rows.collect()}
    assert got == {(0, 1): (2, 200), (0, 2): (2, 200), (0, 3): (2, 200), (0, 4): (0, 404), (0, 5): (2, 200), (0, 6): (0, 404), (1, 1): (0, 200), (1, 3): (0, 404), (1, 5): (0, 404), (2, 1): (0, 404), (2, 3): (0, 404), (2, 5): (0, 404)}
    assert sorted((r.segment, r.page) for r in pages.contiguous(rows).collect()) == [(0, 1), (0, 2), (0, 3)]
    late = spark.read.format(name).option("pages", 6).option("segment", 0).option("page", 5).load()
    assert (0, 5) in {(r.segment, r.page) for r in late.collect()} and late.filter("segment = 0 and page < 5").isEmpty()


def test_stream_goes_on_at_its_page(spark, tmp_path):
    """Rotation at the page cap and after an empty page; a stopped stream resumes at its page and asks for none twice."""
    web, out = tmp_path / "web", tmp_path / "out"
    for page in range(1, 6):
        _write(web, "a", page, [page])
    _write(web, "b", 1, ["x"])
    for page in (1, 2, 3):
        _write(web, "c", page, [page])
    name = pages.register(spark, "pages_stream", _source(web, ["a", "b", "c"], 4), POLICY, pages.folder_transport)

    def go(stop_after=None):
        stream = spark.readStream.format(name).option("state", f"file://{out}/state").option("pagesABatch", 2).option("pagesATask", 1).load()
        seen = []

        def take(df, n):
            rows = [(r.segment, r.page, r.items) for r in df.collect()]
            if stop_after is not None and len(seen) >= stop_after:
                raise OSError("stopped")
            seen.append(sorted(rows))

        q = stream.writeStream.foreachBatch(take).option("checkpointLocation", str(out / "progress")).start()
        try:
            q.processAllAvailable()
        except Exception as e:  # noqa: BLE001
            assert "stopped" in str(e) or stop_after is not None
        finally:
            q.stop()
        return seen

    first, rest = go(1), go()
    assert first == [[(0, 1, 1), (0, 2, 1)]]
    got = [r for batch in rest for r in batch]
    # The batch that failed is taken again; page 5 of a is beyond the cap; b ends at its second page.
    assert [r for r in got if r[2]] == [(0, 3, 1), (0, 4, 1), (1, 1, 1), (2, 1, 1), (2, 2, 1), (2, 3, 1)]
    assert {r[:2] for r in got if not r[2]} == {(1, 2), (2, 4)}
    assert go() == [] or all(not b for b in go())
    assert json.loads((out / "state" / "position").read_text())["segment"] == 3


def test_tasks_of_a_batch_are_bounded():
    """However many pages there are, they are dealt to about as many tasks, each page once."""
    source = Paged(lambda query, page: f"{query}/{page}", 20, None, ["a", "b", "c"])
    parts = pages._Batch("x", source, CrawlPolicy(), None, {"pages": "100001"}).partitions()
    assert len(parts) <= pages.TASKS + 3 and sum(p.last - p.first + 1 for p in parts) == 3 * 100001
    assert {p.last - p.first + 1 for p in pages._Batch("x", source, CrawlPolicy(), None, {"pages": "8"}).partitions()} == {4}
