import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from stationdw.llm import warc
from stationdw.session import scratch_dir


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, sha string, n int")


ROWS = [(1, "http://a/x y\r\nz", "same", "s", 1), (2, None, "same", "s", 1),
        (3, "http://b", "", "s", 1), (4, None, None, "s", 1), (5, "u", "é中🙂" * 5000, "s", 1),
        (6, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n0\r\n\r\n", "s", 1),
        (7, "u", "x" * 100_000, "s", 1), (None, "u", "same", "s", 1), (None, None, "lone", "s", 1),
        (8, "u", "twice", "s", 1), (8, "u", "twice", "s", 1)]


@pytest.mark.parametrize("options", [{}, {"segment": 40, "chunk": 7, "file_records": 10}])
def test_round_trip(spark, options):
    got = warc.archive_round_trip(pages(spark, ROWS), **options).collect()
    want = []
    for i, _, html, _, _ in ROWS:
        payload = (html or "").encode()
        same = [r[0] for r in ROWS if (r[2] or "") == (html or "") and r[0] is not None]
        keeper = max(same, default=None)
        revisit = keeper is not None and i != keeper
        want.append((i, len(payload), warc.payload_digest(payload),
                     "revisit" if revisit else "response", keeper if revisit else None, "ok"))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.status)
           for r in got]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_small_payloads_are_all_responses(spark):
    got = warc.archive_round_trip(pages(spark, ROWS), least_bytes=5).collect()
    assert {r.page_id for r in got if r.record_type == "revisit"} == set()


def test_empty_table(spark):
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


def test_files_are_warc(spark):
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(pages(spark, ROWS), path, segment=1000)
    files = spark.read.format("binaryFile").load(path).collect()
    records = [r for f in files for r in warc.parse_records(gzip.decompress(f["content"]))]
    ids = [f["warc-record-id"] for f, _ in records]
    assert len(set(ids)) == len(ids)
    assert {f["warc-type"] for f, _ in records} == {"response", "continuation", "revisit"}
    assert all(len(b) <= 1000 for _, b in records)
    origins = {f["warc-record-id"]: f for f, _ in records if f["warc-type"] == "response"}
    for f, _ in records:
        if f["warc-type"] == "continuation":
            assert origins[f["warc-segment-origin-id"]]["warc-segment-number"] == "1"


def test_damage_is_reported(spark):
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(pages(spark, [(i, None, f"{i}" * 500, "", 0) for i in range(1, 5)]), path,
                        segment=200, chunk=64)
    s = warc.read_segments(spark, path)
    big = F.col("number") == 2
    origins = [r["origin"] for r in s.where("page_id in (1, 2, 3, 4) and number = 1")
               .orderBy("page_id").collect()]
    broken = s.where(~((F.col("origin") == origins[0]) & big))
    broken = broken.withColumn("total", F.when(F.col("origin") == origins[1], F.col("total") + 1)
                               .otherwise(F.col("total")))
    swap = F.when((F.col("origin") == origins[2]) & big, F.expr(
        "cast(translate(cast(block as string), '3', '9') as binary)")).otherwise(F.col("block"))
    got = {r["page_id"]: r["status"] for r in warc.reassemble(
        broken.withColumn("block", swap)).collect()}
    assert got == {1: "segment missing", 2: "total length", 3: "digest", 4: "ok"}


@pytest.mark.parametrize("bad", [b"", b"5\r\nabc", b"3\r\nabcd\r\n0\r\n\r\n", b"zz\r\n"])
def test_bad_chunks(bad):
    with pytest.raises(ValueError):
        warc.unchunked(bad)


def test_chunks():
    for n in (0, 1, 6, 7, 8, 100):
        data = hashlib.sha256(b"x").digest() * 4
        assert warc.unchunked(warc.chunked(data[:n], 7)) == data[:n]
    assert warc.unchunked(b"3;name=value\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
