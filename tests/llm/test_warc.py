import base64
import gzip
import hashlib

from treeline.llm import warc

SCHEMA = "page_id long, url string, html string, d string, offset int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip_with_revisits(spark):
    rows = [(i, f"http://e.org/{i}?q=a b", None if i in (5, 9) else "" if i == 7 else f"<p>page {i % 6} é</p>\r\n\r\nx" * (1 + 400 * (i == 3))) for i in range(40)]
    index = warc.write_archives(pages(spark, rows))
    found = {r["record_id"]: r for r in warc.read_records(index, payloads=True).collect()}
    first = {}
    for i, url, html in rows:
        first.setdefault(html or "", i)
        r = found[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len((html or "").encode()), digest(html))
        assert r["record_type"] == ("response" if first[html or ""] == i else "revisit")
        assert r["refers_to"] == (None if first[html or ""] == i else first[html or ""])
        assert r["payload"] == ((html or "").encode() if r["record_type"] == "response" else b"")
        assert r["url"] == url.replace(" ", "%20")


def test_selected_ranges_and_small_payloads(spark):
    rows = [(i, None, "same" if i % 2 else f"longer payload {i % 4}") for i in range(20)]
    index = warc.write_archives(pages(spark, rows), min_revisit_bytes=10)
    some = warc.read_records(index.filter("record_id in (3, 4, 8)")).collect()
    assert sorted((r["record_id"], r["record_type"], r["refers_to"]) for r in some) == [(3, "response", None), (4, "revisit", 0), (8, "revisit", 0)]


def test_index_gives_whole_members(spark):
    rows = [(None, "u", "x"), (1, "u", "x"), (1, "u", "x"), (2, "u", "x")]
    index = warc.write_archives(pages(spark, rows)).collect()
    assert len(index) == 4 and sum(r["record_type"] == "response" for r in index) == 2  # both rows of the smallest id
    for r in index:
        with open(r["file"].removeprefix("file:"), "rb") as f:
            f.seek(r["offset"])
            assert gzip.decompress(f.read(r["length"])).startswith(b"WARC/1.1\r\n")
    assert warc.read_records(warc.write_archives(pages(spark, []))).count() == 0


def test_coalesced():
    g = warc.GAP
    got = list(warc.coalesced([("a", 0, 10), ("a", 10, 5), ("a", 16 + g, 5), ("b", 0, 1), ("b", warc.SPAN, 1)]))
    assert got == [("a", 0, 15, [(0, 10), (10, 5)]), ("a", 16 + g, 21 + g, [(16 + g, 5)]), ("b", 0, 1, [(0, 1)]), ("b", warc.SPAN, warc.SPAN + 1, [(warc.SPAN, 1)])]
