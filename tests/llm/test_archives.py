"""WARC archives: round trips, revisits, dictionaries."""

import base64
import hashlib
import io
from collections import Counter

import pytest
from namelink.llm.shared import new_folder
from namelink.llm.warc import ArchiveWriter, build_record, mark_revisits, parse_record, read_archive, warc_round_trip, write_archives

PAGES = "page_id bigint, url string, html string, key string, n int"


def pages(spark):
    rows = [(3, "http://a", "<p>same</p>"), (1, "http://b", "<p>same</p>"), (2, None, "<p>é\r\n\r\n</p>"), (4, "u", None), (5, "u", ""),
            (None, "u", "<p>same</p>"), (None, "u", "alone"), (7, "x\r\ny", "twice"), (7, "x\r\ny", "twice"), (8, "u", "z" * 100_000)]
    return rows, spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES)


def test_round_trip(spark):
    rows, frame = pages(spark)
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    expected = []
    for i, _, html in rows:
        raw = (html or "").encode()
        refers = first.get(html or "") if i != first.get(html or "") else None
        expected.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                         "response" if refers is None else "revisit", refers))
    assert Counter(map(tuple, warc_round_trip(frame).collect())) == Counter(expected)
    assert warc_round_trip(frame.limit(0)).collect() == []


def test_small_payloads_are_not_revisited(spark):
    _, frame = pages(spark)
    assert {r["refers_to"] for r in mark_revisits(frame, least_bytes=1000).collect()} == {None}


def test_archive_starts_with_its_dictionary(spark):
    _, frame = pages(spark)
    for row in write_archives(frame, new_folder(spark, "test")).collect():
        with open(row["path"].removeprefix("file://"), "rb") as source:
            assert source.read(4) == (0x184D2A5D).to_bytes(4, "little")
            source.seek(0)
            assert all(parse_record(r)[0]["WARC-Type"] in ("response", "revisit") for r in read_archive(source))


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_records_survive_any_number(n):
    class Kept(io.BytesIO):
        def close(self):
            pass

    out = Kept()
    writer = ArchiveWriter(out)
    records = [build_record(k, f"http://h/{k}", f"<html>{k} {'word ' * (k % 700)}</html>".encode()) for k in range(n)]
    for r in records:
        writer.add(r)
    writer.close()
    assert list(read_archive(io.BytesIO(out.getvalue()), chunk=777)) == records
    with pytest.raises(Exception):
        list(read_archive(io.BytesIO(b"WARC/1.1 plain")))
