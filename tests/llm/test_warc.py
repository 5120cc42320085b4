from __future__ import annotations

import hashlib

import pyarrow.fs as pafs

from pitchflow.llm import warc

PAGES = "page_id long, url string, html string"


def brute(rows):
    last = {}
    for i, _, h in rows:
        raw = (h or "").encode()
        if len(raw) >= 1000 and i is not None:
            last[raw] = max(last.get(raw, i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        to = last.get(raw)
        again = to is not None and to != i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def rows_with_edges():
    big, other = "<p>é " + "x" * 1200, "y" * 1000
    return [(1, "http://a/1", big), (5, "http://a/5", big), (3, "http://a/ b\r\nX: y", big), (7, None, other), (8, "u", other), (8, "u", other), (9, "u", "y" * 999), (10, "u", "y" * 999),
            (11, "u", None), (12, "u", ""), (None, "u", big), (None, "n", "z" * 2000), (None, "n", "z" * 2000), (13, "u", "\r\n\r\nWARC/1.1\r\n" * 100), (14, "ünï", "q" * 3_000_000), (2**40, "u", "last")]


def test_round_trip(spark, docs):
    rows = rows_with_edges()
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 as digest", "2 as payload", "3 as size").repartition(3)
    index = warc.write_archives(df)
    back = warc.read_records(index)
    assert got(back) == brute(rows)
    payloads = {r.page_id: bytes(r.payload) for r in back.collect() if r.payload is not None}
    assert all(payloads[i] == (h or "").encode() for i, _, h in rows if i in payloads and i is not None)
    assert {r.url for r in back.where("page_id = 3").collect()} == {"http://a/%20b%0D%0AX:%20y"}


def test_index_locates_every_record(spark, docs):
    index = warc.write_archives(spark.createDataFrame(rows_with_edges(), PAGES).repartition(2)).collect()
    spans = sorted((r.file, r.offset, r.length) for r in index)
    for (f, a, n), (g, b, _) in zip(spans, spans[1:]):
        assert b == a + n if f == g else b == 0
    for f in {s[0] for s in spans}:
        fs, path = pafs.FileSystem.from_uri(f)
        assert fs.get_file_info(path).size == max(a + n for g, a, n in spans if g == f)


def test_selected_records_only(spark, docs):
    index = warc.write_archives(spark.createDataFrame(rows_with_edges(), PAGES).coalesce(1))
    assert {r.page_id for r in warc.read_records(index.where("record_type = 'revisit'")).collect()} == {1, 3, 7, None}


def test_given_pages_and_empty_table(spark, docs):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert got(warc.read_records(warc.write_archives(pages))) == brute([(r.page_id, r.url, r.html) for r in pages.collect()])
    assert warc.read_records(warc.write_archives(pages.limit(0))).count() == 0


def test_ranges_are_coalesced():
    gap, most = warc.GAP_BYTES, warc.READ_BYTES
    rows = [("a", 0, 10), ("a", 10, 20), ("a", 30 + gap, 5), ("a", 36 + 2 * gap, 5), ("b", 0, most + 1), ("b", most + 1, 1)]
    assert [len(x) for x in warc.ranges(rows)] == [3, 1, 1, 1]
    assert warc.ranges([]) == []
