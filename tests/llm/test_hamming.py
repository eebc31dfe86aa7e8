"""Exact neighbours against brute force."""

from __future__ import annotations

import random

import pytest

from rowcast.llm import hamming
from rowcast.llm.queries import op6_multi_index_hamming


@pytest.mark.parametrize("k", [1, 4])
def test_neighbours(spark, k, monkeypatch):
    monkeypatch.setattr(hamming, "CELL_CODES", 3)
    draw = random.Random(k)
    centres = [draw.getrandbits(64) for _ in range(4)]
    rows = []
    for i in range(160):
        code = draw.choice(centres)
        for _ in range(draw.randrange(6)):
            code ^= 1 << draw.randrange(64)
        rows.append((i, code - 2**64 if code >= 2**63 else code))
    rows += [(200 + i, rows[0][1]) for i in range(20)] + [(None, 5), (300, None), (0, rows[0][1]), (7, 12345)]
    frame = spark.createDataFrame(rows, "id long, code long")
    got = {(r.query_id, r["rank"]): (r.distance, r.neighbor_id) for r in hamming.nearest(frame, frame.filter("id % 20 = 0"), k).collect()}
    known = sorted({(i, c) for i, c in rows if i is not None and c is not None})
    want = {}
    for query in sorted({i for i, _ in known if i % 20 == 0}):
        near = {}
        for q, a in known:
            if q == query:
                for other, b in known:
                    if other != query:
                        distance = bin((a ^ b) & (2**64 - 1)).count("1")
                        near[other] = min(near.get(other, 65), distance)
        for rank, (other, distance) in enumerate(sorted(near.items(), key=lambda x: (x[1], x[0]))[:k], 1):
            want[query, rank] = (distance, other)
    assert got == want


def test_small_tables(spark):
    frame = spark.createDataFrame([(20, 1), (40, 2), (41, 3)], "id long, code long")
    assert hamming.nearest(frame, frame.filter("id = 20")).count() == 2
    assert hamming.nearest(frame, frame.limit(0)).count() == 0
    assert hamming.nearest(frame.limit(0), frame.limit(0)).count() == 0


def test_sign_code(spark):
    frame = spark.createDataFrame([([0.5, -1.0, 2.0, None],), (None,), ([],), ([1.0] * 64,), ([1.0] * 65,)], "v array<double>")
    assert [r[0] for r in frame.select(hamming.sign_code("v")).collect()] == [5, None, 0, -1, None]


def test_wide_vectors_are_refused(spark, tmp_path):
    rows = [(0, [1.0] * 64), (1, [-1.0] * 64), (20, None)]
    schema = "vec_id long, embedding array<double>"
    for name, more in (("fit", []), ("wide", [(2, [1.0] * 65)])):
        spark.createDataFrame(rows + more, schema).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
    found = op6_multi_index_hamming(spark, f"{tmp_path}/fit").collect()
    assert [(r.query_id, r.neighbor_id, r.distance) for r in found] == [(0, 1, 64)]
    with pytest.raises(Exception, match="a vector has 65"):
        op6_multi_index_hamming(spark, f"{tmp_path}/wide").collect()
