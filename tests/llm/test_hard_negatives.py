"""Hard negatives against brute force: ties, odd rows, blocks of every size, scores beyond doubles."""

from __future__ import annotations

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from rowcast.llm import hard_negatives as hn
from rowcast.llm.queries import op13_secondary_sort_negatives

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, id string"


def whole(value):
    return max(-(1 << 63), min((1 << 63) - 1, math.floor(256 * float(np.float32(value)))))


def brute(rows, positives=5, negatives=10, step=100):
    sound = {}
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        row = (label, [whole(x) for x in vector])
        sound[vec_id] = min(sound.get(vec_id, row), row)
    out = []
    for anchor, (label, code) in sound.items():
        if anchor % step:
            continue
        scored = []
        for other, (own, vector) in sound.items():
            if other != anchor:
                score = sum(a * b for a, b in zip(code, vector))
                scored.append((-max(-(1 << 63), min((1 << 63) - 1, score)), other, own == label))
        scored.sort()
        for score, positive, _ in [s for s in scored if s[2]][:positives]:
            inside = [s for s in scored if not s[2] and 30 * -score <= 100 * -s[0] <= 90 * -score]
            for rank, (value, negative, _) in enumerate(inside[:negatives], 1):
                out.append((anchor, positive, rank, negative, -score, -value))
    return sorted(out)


def table(spark, tmp_path, rows, name="t"):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
    return f"{tmp_path}/{name}"


def rows_of(draw, count, values):
    rows = [(i * 10, [draw.choice(values) for _ in range(3)], draw.randrange(3), "x") for i in range(count)]
    rows += [(None, [1.0], 1, "x"), (5, None, 1, "x"), (15, [1.0, None], 1, "x"), (25, [float("nan")], 1, "x"), (35, [float("inf")], 1, "x")]
    rows += [(45, [1.0, 1.0, 1.0], None, None), (55, [], 1, "x"), (65, [2.0], 1, "x"), (75, [1.0] * 5, 0, "x")]
    return rows + rows[:20] + [(rows[7][0], [9.0, 9.0, 9.0], 2, "other")]


@pytest.mark.parametrize("values", [[-1.0, 0.0, 0.5, 1.0], [0.3, 0.7, 1.1, 0.01], [0.0], [-1.0, -2.0]])
def test_query(spark, tmp_path, values):
    rows = rows_of(random.Random(4), 150, values)
    random.Random(1).shuffle(rows)
    got = op13_secondary_sort_negatives(spark, table(spark, tmp_path, rows))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


@pytest.mark.parametrize("block_rows,block_anchors", [(16, 2), (1000, 1), (40, 3)])
def test_blocks(spark, block_rows, block_anchors):
    draw = random.Random(block_rows)
    rows = [(i, [draw.randrange(-4, 9) for _ in range(4)], draw.randrange(2)) for i in range(120)]
    frame = spark.createDataFrame([(i, label, code) for i, code, label in rows], "id long, label int, code array<long>")
    got = hn.hard_negatives(frame, "id % 20 = 0", positives=3, negatives=4, block_rows=block_rows, block_anchors=block_anchors)
    exact = {i: (code, label) for i, code, label in rows}
    want = []
    for anchor in range(0, 120, 20):
        code, label = exact[anchor]
        scored = sorted((-sum(a * b for a, b in zip(code, v)), i, own == label) for i, (v, own) in exact.items() if i != anchor)
        for score, positive, _ in [s for s in scored if s[2]][:3]:
            inside = [s for s in scored if not s[2] and 30 * -score <= 100 * -s[0] <= 90 * -score]
            want += [(anchor, positive, k, n, -score, -v) for k, (v, n, _) in enumerate(inside[:4], 1)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_large_components(spark, tmp_path):
    rows = [(100 * i, [x, 1.0], i % 2, "x") for i, x in enumerate([1e30, 9e29, 3e20, 1e12, 2.0**24, 2.0**24 + 2, 7e15, -1e30])]
    got = op13_secondary_sort_negatives(spark, table(spark, tmp_path, rows))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_keys_sort_as_pairs():
    draw = random.Random(2)
    edge = [-(1 << 63), -1, 0, 1, (1 << 63) - 1]
    pairs = [(draw.choice(edge), draw.choice(edge), draw.randrange(2), draw.choice(edge)) for _ in range(300)]
    columns = [list(c) for c in zip(*pairs)]
    column = hn._binary(hn.pack_keys(*columns))
    assert list(zip(*hn.unpack_keys(column))) == pairs
    raw = column.to_pylist()
    assert sorted(range(300), key=lambda i: raw[i]) == sorted(range(300), key=lambda i: (pairs[i][0], -pairs[i][1], pairs[i][2], pairs[i][3]))


def test_hot_vector_and_label(spark, tmp_path):
    draw = random.Random(9)
    rows = [(i, [1.0, 1.0] if i % 3 == 0 else [draw.random(), draw.random()], 1 if i % 2 else draw.randrange(10), "x") for i in range(400)]
    got = op13_secondary_sort_negatives(spark, table(spark, tmp_path, rows))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_empty(spark, tmp_path):
    assert op13_secondary_sort_negatives(spark, table(spark, tmp_path, [])).count() == 0
    only = table(spark, tmp_path, [(1, [1.0], 1, "x")], "none")
    assert op13_secondary_sort_negatives(spark, only).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables not present")
def test_sql(spark):
    frame = op13_secondary_sort_negatives(spark, FOLDER)
    assert difference(frame, connect(FOLDER), hn.ORACLE) is None
    assert frame.select(F.countDistinct("anchor_id")).first()[0] == 5
