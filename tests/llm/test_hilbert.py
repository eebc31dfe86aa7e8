"""The curve visits neighbours in turn; shards are even and gapless."""

from __future__ import annotations

import itertools
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowcast.llm import hilbert
from rowcast.llm.hilbert import hilbert_index, hilbert_shards, read_shards, shard_ranges, write_shards
from rowcast.plans.scratch import scratch_path


@pytest.mark.parametrize("bits,dimensions", [(3, 2), (2, 3), (1, 3), (2, 4)])
def test_curve(spark, bits, dimensions):
    cells = [(list(c),) for c in itertools.product(range(2**bits), repeat=dimensions)]
    frame = spark.createDataFrame(cells, "steps array<bigint>").withColumn("number", hilbert_index("steps", bits, dimensions))
    by = {r.number: r.steps for r in frame.collect()}
    assert sorted(by) == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(by[k], by[k + 1])) == 1 for k in range(len(cells) - 1))


@pytest.mark.parametrize("count", [0, 1, 5, 16, 403])
def test_shards(spark, count):
    rows = [(i // 2 if i % 9 else None, None if i % 11 == 0 else "é" * (i % 7), "en" if i % 3 else None, f"s{i % 5}" if i % 4 else "hot", i % 50, i) for i in range(count)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard long")
    result = hilbert_shards(frame)
    got = result.collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    sizes = Counter(r.shard for r in got)
    assert all(0 <= s < 16 for s in sizes)
    if count:
        every = [sizes[s] for s in range(16)]
        assert max(every) - min(every) <= 1
    for shard, size in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(size))
    assert all(r.law == "rows" and r.grown_shard is None for r in got)
    assert shard_ranges(result, 3).count() == len(sizes)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _checked(got, shards=16):
    sizes = Counter(r.shard for r in got)
    every = [sizes[s] for s in range(shards)]
    assert max(every) - min(every) <= 1
    for shard in range(shards):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sizes[shard]))
    ordered = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in ordered] == sorted(r.curve for r in got)
    places = {}
    for r in got:
        places.setdefault((r.text_crc32, r["size"]), set()).add(r.shard)
    assert sum(len(found) - 1 for found in places.values()) <= shards - 1
    # A cut group lies in neighbouring shards, all of it.
    assert all(max(found) - min(found) == len(found) - 1 for found in places.values())


@pytest.mark.parametrize("hot_rows", [10, 100_000])
def test_equal_texts_lie_together(spark, hot_rows):
    """Copies under other ids, languages and sources; one text and one repeated row that hold a third of all rows each."""
    rows = [(i, f"text {i % 90}", ["en", "de", None][i % 3], f"s{i % 7}", i) for i in range(500)]
    rows += [(1000 + i, "hot text", ["en", "fr"][i % 2], f"s{i % 5}", i) for i in range(600)] + [(7, "one row", "en", "s1", 1)] * 600
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    got = hilbert_shards(frame, hot_rows=hot_rows, bucket_rows=50).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t, *_ in rows)
    _checked(got)


def test_hot_texts_are_split_among_tasks(spark, monkeypatch):
    seen = []
    whole = hilbert.stored
    monkeypatch.setattr(hilbert, "stored", lambda df, name: seen.append((name, whole(df, name))) or seen[-1][1])
    frame = spark.range(3000).select("id", spark_text().alias("text"), spark_lang().alias("lang")).withColumnRenamed("id", "doc_id").withColumn("source", spark_lang())
    assert hilbert_shards(frame, hot_rows=100, bucket_rows=20).count() == 3000
    counts = dict(seen)["counts"]
    assert max(r.rows for r in counts.collect()) < 100 and dict(seen)["hot"].count() == 1


def spark_text():
    return F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id").cast("string")))


def spark_lang():
    return F.lit("en")


def test_written_shards_are_skipped(spark):
    rows = [(i, "x" * (i * 7 % 400), f"l{i % 6}", f"s{i % 4}", i) for i in range(800)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    path = scratch_path(spark, "shards")
    write_shards(frame, path)
    assert sorted(map(tuple, spark.read.parquet(f"{path}/rows").select("kept.*").collect())) == sorted(rows)
    read = {}
    for name, asked in {"size": {"sizes": (1, 40)}, "both": {"sizes": (300, 350), "lang": "l2"}, "three": {"lang": "l1", "source": "s3"}, "all": {}}.items():
        found, shards = read_shards(spark, path, **asked)
        low, high = asked.get("sizes", (0, 10**9))
        want = [r for r in rows if low <= len(r[1]) + 1 <= high and asked.get("lang", r[2]) == r[2] and asked.get("source", r[3]) == r[3]]
        assert sorted(map(tuple, found.collect())) == sorted(want)
        assert {f.rpartition("shard=")[2].split("/")[0] for f in found.inputFiles()} <= {str(s) for s in shards}
        read[name] = len(shards)
    assert read["all"] == 16 and read["size"] < 12 and read["both"] < 10 and read["three"] < 16
