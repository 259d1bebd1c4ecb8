import gzip
import hashlib
import zlib

from pyspark.sql import functions as F

from tidemark.llm import op9_warc

BIG = "é" * 600
PAGES = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, "http://a/3", BIG), (4, "http://b/1", "short"),
         (5, "http://b/2", "short"), (6, None, None), (7, "http://c/ x\r\ny", ""), (None, "http://d", BIG),
         (8, "http://e", "a" * 300_000), (3, "http://a/3", BIG), (9, "http://f", "b" * 1000), (10, "http://g", "b" * 1000),
         (11, "http://h", "c" * 999), (12, "http://i", "c" * 999)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "page_id long, url string, html string, digest string, `offset` int")


def brute(rows):
    top = {}
    for i, _, h in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        ref = top[h or ""] if len(data) >= 1000 and top[h or ""] not in (-1, i) else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if ref is None else "revisit", ref))
    return sorted(out, key=str)


COLS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_round_trip(spark):
    index = op9_warc.write_archives(pages(spark), archive_bytes=2000)
    rows = op9_warc.read_records(index).collect()
    assert sorted([tuple(r[x] for x in COLS) for r in rows], key=str) == brute(PAGES)
    html = {i: (h or "").encode() for i, _, h in PAGES}
    assert all(bytes(r["payload"]) == html[r["page_id"]] for r in rows if r["record_type"] == "response")


def test_index_points_at_whole_records(spark):
    index = op9_warc.write_archives(pages(spark)).collect()
    for r in index:
        with open(r["file"].removeprefix("file:"), "rb") as f:
            f.seek(r["offset"])
            assert zlib.decompress(f.read(r["length"]), 31).startswith(b"WARC/1.1\r\n")
    whole = b"".join(gzip.open(f.removeprefix("file:")).read() for f in {r["file"] for r in index})
    assert whole.count(b"WARC/1.1\r\n") == len(PAGES)


def test_reading_a_selection(spark):
    index = op9_warc.write_archives(pages(spark))
    some = op9_warc.read_records(index.where(F.col("url").like("http://b/%"))).collect()
    assert sorted(r["page_id"] for r in some) == [4, 5]
    assert op9_warc.read_records(index.limit(0)).collect() == []


def test_ranges_are_coalesced():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 200, 5), ("b", 0, 4)]
    got = [(f, [x[1] for x in run]) for f, run in op9_warc._ranges(rows, 8, 1000)]
    assert got == [("a", [0, 10, 25]), ("a", [200]), ("b", [0])]


def test_empty_table(spark):
    assert op9_warc.write_archives(pages(spark).limit(0)).collect() == []
