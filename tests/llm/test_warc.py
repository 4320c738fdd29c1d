from __future__ import annotations

import hashlib

import pytest

from docketworks.llm import warc
from docketworks.llm.files import reopen

PAGES = "page_id long, url string, html string, refers_to string"


def pages(spark):
    rows = [
        (1, "http://a/x", "<p>same</p>", "z"), (5, "http://a/y", "<p>same</p>", "z"), (3, None, "<p>same</p>", "z"),
        (2, "http://b/\r\nevil", None, None), (4, "http://b/", "", None), (6, "u", "é\r\n\r\n漢" * 9000, ""),
        (7, "u", "only", ""), (7, "u", "only", ""), (None, "u", "only", ""), (None, None, "none", ""),
    ]
    return spark.createDataFrame(rows, PAGES).repartition(3)


def test_round_trip_of_awkward_pages(spark, scratch):
    index = warc.write_archives(pages(spark), scratch, frame_bytes=2000, file_bytes=20_000)
    rows = warc.read_archives(index).collect()
    source = [(r["page_id"], (r["html"] or "").encode()) for r in pages(spark).collect()]
    largest = {}
    for page_id, payload in source:
        largest[payload] = max(largest.get(payload, -1), -1 if page_id is None else page_id)
    found = sorted((r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] or -1)
                   for r in rows)
    expected = sorted(
        (p or -1, len(x), warc.base32_digest(x), "revisit" if (p or -1) < largest[x] else "response",
         largest[x] if (p or -1) < largest[x] else -1)
        for p, x in source
    )
    assert found == expected
    held = {hashlib.sha1(bytes(r["payload"])).digest() for r in rows if r["record_type"] == "response"}
    assert held == {hashlib.sha1(x).digest() for _, x in source}
    assert {r["url"] for r in rows if r["page_id"] == 2} == {"http://b/%0D%0Aevil"}


def test_a_record_is_found_by_its_place(spark, scratch):
    index = warc.write_archives(pages(spark), scratch, frame_bytes=1500).collect()
    row = next(r for r in index if r["page_id"] == 5)
    with reopen(row["path"]) as source:
        data = warc.read_frame(source, warc.seek_table(source)[row["frame"]])
    assert warc.parse_record(data[row["offset"]:row["offset"] + row["size"]])[6] == b"<p>same</p>"
    assert row["record_id"] == warc.record_id(5)


def test_small_payloads_may_be_left_out_of_the_comparison(spark):
    rows = warc.with_references(pages(spark), least_bytes=12).collect()
    assert not any(r["revisit"] for r in rows)


def test_empty_table(spark, scratch):
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], PAGES), scratch)).collect() == []


def test_a_changed_payload_is_noticed():
    data = warc.build_record(1, "u", b"payload", None, False, "2024-01-01T00:00:00Z")
    assert warc.parse_record(data)[6] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(data.replace(b"payload", b"payl0ad"))
