import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import warc
from corpusmill.session import scratch_path

ROWS = [
    (1, "http://b.org/x?q=1#frag", "<p>é</p>"), (2, "http://a.b.org/", "<p>é</p>"), (3, None, None), (4, "http://a.b.org/", ""),
    (5, "no scheme\r\nat all", "x" * 200_000), (6, "http://b.org/x?q=1", "body\r\n\r\nwith breaks"), (None, "http://n.org", "no id"),
    (0, "http://z.org/", "<p>é</p>"), (7, "http://b.org/\t", "tab"),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(
        [(*r, "clash", i) for i, r in enumerate(rows)], "page_id bigint, url string, html string, sha string, size int"
    ).repartition(3)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(spark):
    got = {r["page_id"]: tuple(r)[1:] for r in warc.archive_round_trip(spark, pages(spark)).collect()}
    assert len(got) == len(ROWS)
    first = {}
    for page, _, html in sorted((r for r in ROWS if r[0] is not None)):
        first.setdefault(html or "", page)
    for page, _, html in ROWS:
        refers = first.get(html or "", page)
        revisit = page is not None and refers != page
        assert got[page] == (
            len((html or "").encode()), digest(html), "revisit" if revisit else "response", refers if revisit else None
        )


def test_small_payloads_are_never_revisits(spark):
    rows = warc.archive_round_trip(spark, pages(spark), min_revisit_bytes=9).collect()
    assert {r["page_id"] for r in rows if r["record_type"] == "revisit"} == {1, 2}  # the payload has nine bytes
    rows = warc.archive_round_trip(spark, pages(spark), min_revisit_bytes=10).collect()
    assert {r["record_type"] for r in rows} == {"response"}


def test_index_blocks_and_look_ups(spark):
    rows = [(i, f"http://h{i % 7}.org/{i % 50}", f"p{i}") for i in range(500)]
    folder = scratch_path(spark, "test-archives")
    captures = warc.write_archives(pages(spark, rows), folder)
    directory = warc.build_index(captures, folder, block_lines=9)
    assert directory.count() >= 500 / 9
    wanted = captures.where("page IN ('3', '77', '499')").select("url_key", "page").union(
        spark.createDataFrame([("org,h1)/999", "3"), ("zzz", "1"), ("", "")], "a string, b string")
    )
    found = warc.read_records(warc.look_up(wanted, directory, folder), folder)
    assert {(r["page"], bytes(r["payload"])) for r in found.collect()} == {(str(i), f"p{i}".encode()) for i in (3, 77, 499)}
    assert captures.select(F.countDistinct("page")).first()[0] == 500


def test_repeated_rows_and_empty_table(spark):
    assert warc.archive_round_trip(spark, pages(spark, [ROWS[0], ROWS[0]])).count() == 2
    assert warc.archive_round_trip(spark, pages(spark).limit(0)).count() == 0


def test_members_are_whole_records():
    data = warc.record("9", "http://x.org/", b"abc", digest("abc"), 3, None)
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"abc\r\n\r\n")
    assert warc.parse(gzip.decompress(gzip.compress(data)))["payload"] == b"abc"


@pytest.mark.parametrize(
    ("url", "key"),
    [("http://A.b.org/x?y#z", "org,b,a)/x?y"), ("http://b.org", "org,b)/"), ("http://b.org?q", "org,b)?q"), (None, ")/")],
)
def test_keys(url, key):
    assert warc.surt(url) == key
