from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowcast.plans.joins import hot_keys, join_dimension, skew_join, with_position
from rowcast.plans.sizing import plan_bytes


def brute(left, right, how):
    out = Counter()
    for key, a in left:
        found = [b for k, b in right if key is not None and k == key]
        for b in found:
            out[(key, a, b)] += 1
        if not found and how == "left":
            out[(key, a, None)] += 1
    return out


def skewed(seed, rows, hot, copies):
    """A third of the rows on one key, exact copies and null keys included."""
    dice = random.Random(seed)
    out = []
    for i in range(rows):
        if i % 3 == 0:
            out.append((hot, "same" if copies else f"v{i}"))
        elif i % 17 == 0:
            out.append((None, f"n{i}"))
        else:
            out.append((dice.randrange(rows), f"v{i}"))
    return out


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_right", [False, True])
def test_skew_join_equals_brute_force(spark, how, hot_right):
    left = skewed(1, 300, 7, copies=True)
    right = skewed(2, 90, 7 if hot_right else 100_000, copies=True)
    lhs = spark.createDataFrame(left, "k bigint, a string").repartition(5)
    rhs = spark.createDataFrame(right, "k bigint, b string").repartition(4)
    result = skew_join(lhs, rhs, "k", how, salts=4, min_hot_rows=10, force=True)
    assert result.columns == ["k", "a", "b"]
    assert Counter(map(tuple, result.collect())) == brute(left, right, how)


def test_skew_join_spreads_the_hot_key(spark):
    left = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit("x").alias("a")
    )
    right = spark.range(4000).select(F.col("id").alias("k"), F.lit("y").alias("b"))
    plan = skew_join(left, right, "k", "left", salts=8, min_hot_rows=100, force=True)
    assert plan.count() == 4000
    salted = with_position(left).filter("k = 0").select(
        F.pmod("_position", F.lit(8)).alias("salt")
    )
    assert salted.distinct().count() == 8


def test_hot_keys_are_bounded_and_exact(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") < 10_000, -1).otherwise(F.col("id")).alias("k")
    )
    assert [r.k for r in hot_keys(rows, "k", 100).collect()] == [-1]
    assert hot_keys(rows, "k", 10_001).count() == 0


def test_position_is_kept_only_when_given(spark):
    left = with_position(spark.range(10).withColumnRenamed("id", "k"))
    right = spark.range(5).withColumnRenamed("id", "k").withColumn("b", F.lit(1))
    assert "_position" in skew_join(left, right, "k", force=True, min_hot_rows=1).columns


def test_small_dimension_is_broadcast(spark, tmp_path):
    spark.range(100).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "d"))
    dimension = spark.read.parquet(str(tmp_path / "d"))
    assert plan_bytes(dimension) < 100_000
    fact = spark.range(1000).select((F.col("id") % 150).alias("k"))
    plan = join_dimension(fact, dimension, "k", "left")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text
    assert plan.count() == 1000


def test_large_dimension_takes_the_skew_safe_way(spark, monkeypatch):
    import rowcast.plans.sizing as sizing

    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    dimension = spark.range(100).withColumnRenamed("id", "k").withColumn("b", F.col("k") * 2)
    fact = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 150).alias("k")
    )
    plan = join_dimension(fact, dimension, "k", "left", force=True, min_hot_rows=50, salts=4)
    got = Counter((r.k, r.b) for r in plan.collect())
    want = Counter(
        (k, k * 2 if k < 100 else None)
        for k in (5 if i % 3 == 0 else i % 150 for i in range(1000))
    )
    assert got == want


def test_empty_sides(spark):
    empty = spark.range(0).withColumnRenamed("id", "k")
    full = spark.range(4).withColumnRenamed("id", "k")
    left = skew_join(full, empty.withColumn("b", F.lit(1)), "k", "left", force=True, min_hot_rows=1)
    assert sorted(map(tuple, left.collect())) == [(i, None) for i in range(4)]
    assert skew_join(empty, full, "k", "inner", force=True, min_hot_rows=1).count() == 0


def test_many_rows_in_few_bytes_are_not_broadcast(spark, tmp_path, monkeypatch):
    import rowcast.plans.sizing as sizing

    spark.range(5000).select(F.lit(1).alias("k")).write.parquet(str(tmp_path / "d"))
    dimension = spark.read.parquet(str(tmp_path / "d"))
    assert sizing.broadcastable(dimension)
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 4999)
    assert not sizing.broadcastable(dimension)


def test_without_hot_keys_the_join_is_plain(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    plan = skew_join(left, left.withColumn("b", F.lit(1)), "k", "left", force=True)
    assert "_si" not in plan._jdf.queryExecution().analyzed().toString()
    assert plan.count() == 100


ROWS = st.lists(st.tuples(st.sampled_from([None, 0, 0, 0, 1, 2, 3]), st.sampled_from("ab")), max_size=30)


@settings(max_examples=12, deadline=None)
@given(ROWS, ROWS, st.sampled_from(["left", "inner"]), st.integers(1, 6))
def test_skew_join_on_random_rows(spark, left, right, how, min_hot_rows):
    lhs = spark.createDataFrame(left, "k bigint, a string")
    rhs = spark.createDataFrame(right, "k bigint, b string")
    result = skew_join(lhs, rhs, "k", how, salts=3, min_hot_rows=min_hot_rows, force=True)
    assert Counter(map(tuple, result.collect())) == brute(left, right, how)


def test_well_compressed_rows_are_not_broadcast(spark, tmp_path):
    import rowcast.plans.sizing as sizing

    spark.range(2000).select("id", F.repeat(F.lit("text"), 20_000).alias("t")).coalesce(1).write.parquet(str(tmp_path / "d"))
    wide = spark.read.parquet(str(tmp_path / "d"))
    assert plan_bytes(wide) < sizing.BROADCAST_BYTES
    assert not sizing.broadcastable(wide) and sizing.broadcastable(wide.limit(10))
    nested = spark.range(3).select(F.array(F.lit("x")).alias("a"), F.lit(None).cast("string").alias("b"))
    assert sizing.broadcastable(nested)


def test_a_key_of_half_a_thousandth_is_spread_by_its_rows(spark):
    rows = spark.range(200_000).select(F.when(F.col("id") % 2000 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in hot_keys(rows, "k", 50).collect()] == [(-1, 100)]
    other = rows.filter("k < 500").withColumn("b", F.lit(1)).distinct()
    joined = skew_join(rows, other, "k", "left", min_hot_rows=50, force=True)
    assert joined.count() == 200_000 and joined.filter("b = 1").count() == rows.filter("k < 500").count()


def test_a_shuffled_side_is_salted_by_content(spark):
    left = spark.range(300).select((F.col("id") % 3).alias("k"), "id")
    right = spark.range(60).select((F.col("id") % 3).alias("k"), F.lit("same").alias("b"))
    joined = skew_join(left, right.repartition(7), "k", min_hot_rows=5, force=True, right_scan=False)
    assert joined.count() == 300 * 20
