"""Operator 8: round trip through ARC and WARC files, and the version-specific header lines."""

import hashlib

from llm_helpers import SF_SMALL, as_rows
from refillscope.llm import archives as ar


def brute_force(rows):
    payloads = [(p, (h or "").encode()) for p, _, h in rows]
    keep = {}
    for p, raw in payloads:
        if p is not None:
            keep[raw] = max(keep.get(raw, p), p)
    out = []
    for p, raw in payloads:
        revisit = len(raw) >= 1000 and raw in keep and keep[raw] != p
        out.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", keep[raw] if revisit else None))
    return sorted(out, key=repr)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert as_rows(ar.pages_to_warc(pages), *COLUMNS) == brute_force(rows)


def test_edge_cases(spark):
    big, odd = "é" * 600, "a\r\n\r\nWARC/1.1\r\nhttp://x 0.0.0.0 2 text/html 5\n" * 30
    rows = [(1, "http://a b/c", big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (None, "u", big),
            (7, "http://x", odd), (8, "http://y", odd), (9, "u", "z" * 300_000)]
    pages = frame(spark, rows).selectExpr("*", "1 as record", "2 as digest", "3 as kept", "4 as archive")
    assert as_rows(ar.pages_to_warc(pages), *COLUMNS) == brute_force(rows)
    assert as_rows(ar.pages_to_warc(frame(spark, []))) == []


def test_repeated_rows_leave_one_response(spark):
    rows = [(5, "u", "q" * 2000)] * 3 + [(4, "v", "q" * 2000)]
    found = ar.pages_to_warc(frame(spark, rows)).collect()
    assert sorted(r["record_type"] for r in found) == ["response", "revisit", "revisit", "revisit"]
    assert {r["refers_to"] for r in found if r["record_type"] == "revisit"} == {5}
    assert [r["page_id"] for r in found if r["record_type"] == "response"] == [5]
    assert len({r["record_id"] for r in found}) == 4


def test_many_files_and_both_versions(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i} ") for i in range(2_500)]
    path = str(tmp_path / "arc")
    ar.write_arc(frame(spark, rows).coalesce(1), path)
    read = ar.read_arc(spark, path).collect()
    assert sorted(r["page_id"] for r in read) == list(range(2_500))
    assert {bytes(r["payload"]) for r in read} == {r[2].encode() for r in rows}
    assert len({r["archive"] for r in read}) == 3


def test_parser_reads_by_version_and_length():
    one = ar.version_block(1, "x") + b"\n" + ar.arc_record(1, 3, "http://u", b"line\nhttp://v 1 2 text/html 4\n") + b"\n"
    two = ar.version_block(2, "x") + b"\n" + ar.arc_record(2, None, "http://w", b"") + b"\n\nnot a header\n" + ar.arc_record(2, 9, "http://z", b"end")
    first, second = list(ar.parse_arc(one)), list(ar.parse_arc(two))
    assert [f["URL"] for _, f, _ in first + second] == ["http://u", "http://w", "http://z"]
    assert first[0][2].endswith(b"text/html 4\n") and second[1][1]["Result-code"] == "200"
    assert ar._iso("20010203") == "2001-02-03T00:00:00Z" and ar._iso("20010203040506") == "2001-02-03T04:05:06Z"
