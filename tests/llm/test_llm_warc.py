"""WARC archives: round trips, ranges and revisits; the whole query has a SQL twin."""

import gzip

from pyspark.sql import functions as F

from claimloom.llm import warc
from claimloom.sources.shared import new_folder

ROWS = [
    (5, "http://a", "same"), (3, "http://b", "same"), (9, "http://c", "same"), (9, "http://c", "same"),
    (1, "http://d\r\nX-Evil: 1", "é日\r\n\r\nWARC/1.1\r\n\r\n"), (2, None, None), (4, "http://e", ""),
    (None, "http://f", "same"), (None, "http://g", "only nameless"), (None, None, "only nameless"),
    (7, "http://h", "x" * 300_000),
]


def pages(spark):
    full = [(*r, "x", 1) for r in ROWS]
    return spark.createDataFrame(full, "page_id long, url string, html string, file string, offset long")


def expected():
    out = []
    for page_id, _, html in ROWS:
        same = [p for p, _, h in ROWS if (h or "") == (html or "") and p is not None]
        revisit = bool(same) and page_id != min(same)
        payload = (html or "").encode()
        out.append(
            (page_id, len(payload), warc.payload_digest(payload), "revisit" if revisit else "response",
             min(same) if revisit else None)
        )
    return sorted(out, key=str)


def test_pages_come_back(spark):
    got = warc.archived_pages(pages(spark)).drop("url").collect()
    assert sorted(map(tuple, got), key=str) == expected()


def test_small_archives_and_reads(spark):
    folder = new_folder(spark, "warc")
    index = warc.write_warc(pages(spark), folder, archive_bytes=500)
    assert index.count() == len(ROWS) and index.select("file").distinct().count() > 2
    for gap, most in ((0, 1), (0, 1 << 20), (1 << 20, 1 << 20)):
        got = warc.read_warc(index, folder, gap_bytes=gap, read_bytes=most, payloads=True).collect()
        assert sorted((tuple(r)[:5] for r in got), key=str) == expected()
        held = {r.page_id: r.payload for r in got if r.record_type == "response" and r.page_id}
        assert bytes(held[1]).decode() == ROWS[4][2] and bytes(held[2]) == b""
    some = warc.read_warc(index.where("record_type = 'revisit'"), folder).collect()
    assert sorted(r.page_id or 0 for r in some) == [0, 4, 5, 9, 9]


def test_archives_are_readable_as_gzip(spark):
    folder = new_folder(spark, "warc")
    index = warc.write_warc(pages(spark), folder)
    raw = b""
    for (name,) in index.select("file").distinct().collect():
        with gzip.open(f"{folder.removeprefix('file://')}/{name}") as archive:
            raw += archive.read()
    assert raw.count(b"WARC-Type: response\r\n") + raw.count(b"WARC-Type: revisit\r\n") == len(ROWS)
    assert b"\r\nX-Evil" not in raw


def test_small_payloads_are_never_revisits(spark):
    folder = new_folder(spark, "warc")
    index = warc.write_warc(pages(spark), folder, min_bytes=5)
    got = warc.read_warc(index, folder)
    assert got.where((F.col("payload_bytes") < 5) & (F.col("record_type") == "revisit")).count() == 0


def test_empty_table(spark):
    assert warc.archived_pages(pages(spark).limit(0)).count() == 0
