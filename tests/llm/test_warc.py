from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import zlib

import pytest

from winnow.llm import warc

PAGES = "page_id long, url string, html string"


def slow(rows, least=0):
    keeper = {}
    for i, _, html in rows:
        keeper[html or ""] = max(keeper.get(html or "", i), i)
    out = set()
    for i, _, html in rows:
        body = (html or "").encode()
        other = len(body) >= least and keeper[html or ""] != i
        out.add((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if other else "response", keeper[html or ""] if other else None))
    return out


ROWS = [(1, "http://a/", "<p>x</p>"), (2, "http://b/\r\nX: y", None), (3, None, ""), (4, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
        (5, "é", "ü\0\r\n" * 10), (6, "v", "<p>x</p>"), (7, "w", "y" * 3_000_000), (8, "x", "<p>x</p>")]


@pytest.mark.parametrize("least", [0, 1, 9])
def test_round_trip_and_revisits(spark, least):
    df = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "1 AS content", "2 AS `file`").repartition(3)
    got = warc.archive_pages(df, least, file_bytes=1_000)
    assert {tuple(r) for r in got.collect()} == slow(ROWS, least)


def test_files_have_one_member_per_record(spark, tmp_path):
    df = spark.createDataFrame(ROWS, PAGES).coalesce(1)
    archives = warc.write_monolithic(df, f"{tmp_path}/whole", file_bytes=10_000).cache()
    entries = [tuple(e) for e in warc.normalise(archives, f"{tmp_path}/records").collect()]
    names = {a.file for a in archives.collect()}
    assert len(names) == 2 and len(entries) == len(ROWS)
    for name in names:
        whole = open(name, "rb").read()
        engine = zlib.decompressobj(31)
        engine.decompress(whole)
        assert engine.eof and not engine.unused_data  # a single stream over the whole file
        new = f"{tmp_path}/records/{os.path.basename(name)}"
        assert gzip.open(new).read() == gzip.open(name).read()
        own = sorted((o, n) for f, o, n in entries if f == new)
        assert open(f"{new}.idx").read() == "".join(f"{o} {n}\n" for o, n in own)
        data, end = open(new, "rb").read(), 0
        for o, n in own:
            assert o == end and zlib.decompress(data[o:o + n], 31).startswith(b"WARC/1.1\r\n")
            end = o + n
        assert end == len(data)


def test_hot_payload_and_empty_table(spark):
    rows = [(i, "u", "same" if i % 3 else f"own {i}") for i in range(600)]
    got = warc.archive_pages(spark.createDataFrame(rows, PAGES).repartition(8))
    assert {tuple(r) for r in got.collect()} == slow(rows)
    assert warc.archive_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_repeated_rows(spark):
    rows = [(1, "u", "a"), (1, "u", "a"), (2, "u", "a")]
    got = warc.archive_pages(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(1, "revisit"), (1, "revisit"), (2, "response")]


def test_records_are_cut_from_any_chunks():
    records = [warc.record_bytes(i, "u", body) for i, body in enumerate([b"", b"\r\n\r\n", b"x" * 5_000, b"WARC/1.1\r\n\r\n"])]
    data = b"".join(records)
    for size in (1, 7, 100, 10_000):
        assert list(warc.split_records(data[i:i + size] for i in range(0, len(data), size))) == records
    with pytest.raises(ValueError):
        list(warc.split_records([data[:-9]]))
    members = gzip.compress(data[:100]) + gzip.compress(data[100:])
    assert b"".join(warc.inflate(io.BytesIO(members), 13)) == data
    with pytest.raises(ValueError):
        list(warc.inflate(io.BytesIO(members[:-4])))
