"""Archives: roles, digests, round trips, damage."""

from __future__ import annotations

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from rowcast.llm import warc
from rowcast.plans.scratch import scratch_path


def expected(rows, least=0):
    best = {}
    for page, _, html in rows:
        data = (html or "").encode()
        key = (page is None, page or 0)
        if len(data) >= least and (data not in best or key < best[data]):
            best[data] = key
    out, used = [], set()
    for page, _, html in rows:
        data = (html or "").encode()
        first = data not in best or ((page is None, page or 0) == best[data] and data not in used)
        if first and data in best:
            used.add(data)
        refers = None if first or best[data][0] else best[data][1]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "response" if first else "revisit", refers))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a", "<p>" + "long é " * 500), (1, "u\r\nEvil: 1", "<p>" + "long é " * 500), (1, None, "<p>" + "long é " * 500),
    (2, "u", ""), (3, "u", None), (None, "u", "x"), (None, "u", "x"), (4, "u", "y\r\n\r\n"), (6, "u", "z" * 1000), (7, "u", "z" * 999),
]


@pytest.mark.parametrize("least,chunk", [(0, 100), (0, 1000), (0, 1 << 18), (2, 100)])
def test_round_trip(spark, least, chunk):
    frame = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("record", F.lit(1)).coalesce(2)
    path = scratch_path(spark, "archive")
    warc.write_archive(frame, path, least_bytes=least, chunk_bytes=chunk)
    got = sorted((tuple(r) for r in warc.read_archive(spark, path).collect()), key=str)
    assert got == expected(ROWS, least)
    table = spark.read.parquet(path)
    assert table.filter(F.length("data") > chunk + 2000).count() == 0
    raw = b"".join(bytes(r.data) for r in warc.export_bytes(table).collect())
    at, ids, referred = 0, set(), set()
    for _ in ROWS:
        end = raw.index(b"\r\n\r\n", at)
        fields = dict(line.split(": ", 1) for line in raw[at:end].decode().split("\r\n")[1:])
        assert fields["WARC-Date"] == warc.DATE and fields["WARC-Record-ID"] not in ids
        ids.add(fields["WARC-Record-ID"])
        assert (fields["WARC-Type"] == "revisit") == ("WARC-Refers-To" in fields)
        referred |= {fields["WARC-Refers-To"]} if "WARC-Refers-To" in fields else set()
        at = end + 4 + int(fields["Content-Length"])
        assert raw[at : at + 4] == b"\r\n\r\n"
        at += 4
    assert at == len(raw) and len(ids) == len(ROWS) and referred <= ids


def test_damage_is_found(spark):
    frame = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    path, other = scratch_path(spark, "archive"), scratch_path(spark, "archive")
    warc.write_archive(frame, path, chunk_bytes=100)
    table = spark.read.parquet(path)
    wrong = table.withColumn("data", F.when(F.col("chunk") == 2, F.overlay("data", F.lit(b"?"), 3)).otherwise(F.col("data")))
    wrong.write.parquet(other)
    with pytest.raises(Exception, match="damaged"):
        warc.read_archive(spark, other).collect()


def test_empty(spark):
    path = scratch_path(spark, "archive")
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archive(spark, path).count() == 0
