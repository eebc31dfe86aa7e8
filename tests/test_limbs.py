"""Exact sums against rational arithmetic, and the layout of written tables."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rowcast.functions import limbs
from rowcast.operators import layout


def groups():
    draw = random.Random(1)
    out = {}
    for g in range(40):
        values = [draw.choice([1, -1]) * draw.random() * 10 ** draw.randint(-12, 25) for _ in range(draw.randint(1, 40))]
        if g % 3 == 0:
            values = [round(draw.random() * 1e5, 2) for _ in range(200)]
        if g % 3 == 1:
            values += [-v for v in values[:-1]]
        out[g] = values
    out[100] = [4e-7] * 1000
    out[101] = [1e15, 1e-6, -1e15]
    out[102] = [0.0, -0.0]
    out[103] = [2.0**80, 1.0, -(2.0**60)]
    out[104] = [1e15, 1e-6]
    # Halfway between two doubles, with and without a bit far below.
    out[105] = [2.0**53, 1.0]
    out[106] = [2.0**53, 1.0, 2.0**-60]
    out[107] = [-(2.0**53), -3.0]
    return out


def exact(row):
    return sum(Fraction(d) * Fraction(2) ** e for d, e in zip(row["sum"], limbs.GRID))


def test_sums_are_exact_in_any_order(spark):
    known = groups()
    rows = [(g, v) for g, values in known.items() for v in values] + [(200, None), (200, float("nan")), (200, float("inf"))]
    found = []
    for seed, tasks in ((1, 5), (2, 1)):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "g int, v double").repartition(tasks)
        out = limbs.exact_sums(frame, "v", "g").withColumn("d", limbs.as_double("sum"))
        found.append(sorted(map(tuple, out.collect())))
        for r in out.collect():
            if r.g == 200:
                assert (r.value_count, r["sum"], r.d) == (0, None, None)
                continue
            want = sum(map(Fraction, known[r.g]))
            assert abs(exact(r) - want) <= Fraction(2) ** -96 * len(known[r.g])
            assert r.d == float(exact(r)) and all(0 <= d < 1 << 24 for d in r["sum"][1:])
    assert found[0] == found[1]
    ends = {r[0]: r[3] for r in found[0]}
    assert ends[100] == pytest.approx(0.0004, rel=1e-15) and ends[101] == 1e-6
    assert (ends[105], ends[106], ends[107]) == (2.0**53, 2.0**53 + 2, -(2.0**53) - 4)


def test_parts_of_a_table_add_up(spark):
    frame = spark.createDataFrame([(i % 4, (-1) ** i * 1.1 ** (i - 60)) for i in range(200)], "g int, v double")
    one = limbs.exact_sums(frame.filter("g < 2"), "v").select(F.col("sum").alias("a"))
    two = limbs.exact_sums(frame.filter("g >= 2"), "v").select(F.col("sum").alias("b"))
    both = one.select("a", two.scalar().alias("b")).select(limbs.added(F.col("a"), F.col("b")).alias("sum"))
    whole = limbs.exact_sums(frame, "v").select("sum")
    assert both.collect() == whole.collect()
    row = whole.select(limbs.whole_part("sum").alias("w"), limbs.fraction("sum").alias("f"), "sum").first()
    assert Fraction(int(row.w)) + Fraction(int(row.f)) / 2**72 <= exact(row) < Fraction(int(row.w)) + Fraction(int(row.f) + 1) / 2**72
    less = whole.select(limbs.added(F.col("sum"), limbs.negated(F.col("sum"))).alias("z")).first().z
    assert less == [0] * len(limbs.GRID)


def test_small_parts_of_large_sums_are_kept(spark):
    frame = spark.createDataFrame([(1e15,), (1e-6,)], "v double")
    row = limbs.exact_sums(frame, "v").select(limbs.whole_part("sum").alias("w"), limbs.fraction("sum").alias("f")).first()
    assert int(row.w) == 10**15 and int(row.f) == int(Fraction(1e-6) * 2**72)


def test_values_off_the_grid(spark):
    frame = spark.createDataFrame([(1e300,)], "v double")
    with pytest.raises(Exception, match="cannot be summed exactly"):
        limbs.exact_sums(frame, "v").collect()
    assert limbs.exact_sums(frame.limit(0), "v").collect() == [(0, None)]


def test_layout(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000, numPartitions=4).withColumn("text", F.repeat(F.lit("x"), 50)).write.parquet(path)
    table = spark.read.parquet(path)
    blocks = layout.blocks(table)
    got = layout.files(blocks).collect()
    assert len(got) == 4 and sum(r.rows for r in got) == 1000 and all(r.in_one_piece and r.blocks == 1 for r in got)
    sizes = {f"file:{p}": p.stat().st_size for p in (tmp_path / "t").glob("*.parquet")}
    assert {r.file_path.replace("file:///", "file:/"): r.file_bytes for r in got} == sizes
    assert layout.balance(blocks).collect() == [(4, 4, 1000, 250, 250, 250)]
    overlap = spark.createDataFrame([("f", 10, 0, 6, 1), ("f", 10, 5, 5, 1), ("g", 10, 0, 5, 1), ("g", 10, 5, 5, 2)], "file_path string, file_bytes long, block_start long, block_bytes long, rows long")
    assert {r.file_path: r.in_one_piece for r in layout.files(overlap).collect()} == {"f": False, "g": True}
    assert layout.balance(layout.blocks(table.limit(0))).first().rows == 0
