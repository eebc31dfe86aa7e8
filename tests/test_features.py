from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rowcast.operators import features, models
from rowcast.plans.numbering import leading_rows, shuffled_index, take_rows

COLUMNS = ["a", "b", "c"]


def sample(spark, rows=400, seed=3):
    dice = np.random.default_rng(seed)
    a = dice.normal(5, 2, rows)
    b = 0.7 * a + dice.normal(0, 1, rows)
    c = dice.normal(-1, 3, rows)
    data = np.column_stack([a, b, c])
    table = spark.createDataFrame(
        [(i, *map(float, r), "xyz"[i % 3]) for i, r in enumerate(data)],
        "id bigint, a double, b double, c double, target string",
    )
    return data, table


def test_standardized_uses_population_deviation(spark):
    data, table = sample(spark)
    got = np.array(features.standardized(table, COLUMNS).orderBy("id").select(COLUMNS).collect())
    assert np.allclose(got, (data - data.mean(0)) / data.std(0))
    flat = features.standardized(table.withColumn("a", F.lit(2.0)), ["a"])
    assert flat.agg(F.max("a")).first()[0] == 0.0


def test_components_match_an_eigen_decomposition(spark):
    data, table = sample(spark)
    scaled = (data - data.mean(0)) / data.std(0)
    values, vectors = np.linalg.eigh(np.cov(scaled.T))
    order = values.argsort()[::-1][:2]
    vectors = vectors[:, order]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), range(2)])
    loadings, explained = features.components(features.standardized(table, COLUMNS), COLUMNS, 2)
    assert np.allclose(loadings, vectors)
    assert np.allclose(explained, values[order] / values.sum())
    scores = features.principal_components(table, COLUMNS, 2, "id", "target").orderBy("id")
    got = np.array(scores.select("pc1", "pc2").collect())
    assert np.allclose(got, scaled @ vectors)
    assert [r.target for r in scores.limit(3).collect()] == ["x", "y", "z"]
    assert features.of_class(scores, "target", "x").count() == 134
    summary = features.class_summary(scores, "target", ["pc1"]).collect()
    assert sum(r.row_count for r in summary) == 400


def test_packing(spark):
    _, table = sample(spark, 5)
    row = features.pack(table, COLUMNS, "target", "id").orderBy("id").first()
    assert row.label == "x" and row.features.size == 3
    arrays = spark.createDataFrame([(1, [1.0, 2.0])], "label int, v array<float>")
    packed = features.pack_array(arrays, "v", "label").select(vector_to_array("features")).first()
    assert packed[0] == [1.0, 2.0]


@pytest.mark.parametrize("bins", [1, 7, 101])
def test_histogram_equals_numpy(spark, bins):
    dice = np.random.default_rng(5)
    data = dice.normal(0, 1, (200, 6))
    table = spark.createDataFrame([(r.tolist(),) for r in data], "v array<double>")
    rows = features.histogram(table, "v", bins).orderBy("bin").collect()
    counts, edges = np.histogram(data.flatten(), bins=bins)
    assert [r["count"] for r in rows] == counts.tolist()
    assert np.allclose([r.left_edge for r in rows], edges[:-1])


def test_histogram_covers_all_parts_of_a_split(spark):
    dice = np.random.default_rng(6)
    data = dice.normal(0, 1, (60, 3))
    rows = [(i, r.tolist()) for i, r in enumerate(data)] + [(None, [0.0])]
    table = spark.createDataFrame(rows, "id bigint, v array<double>")
    parted = features.with_part(table, "id", validation=5, train=20)
    got = features.histogram(parted, "v", 7, by="part", groups=features.PARTS).collect()
    edges = np.histogram(data.flatten(), bins=7)[1]
    rest = np.append(data[25:].flatten(), 0.0)
    for part, own in zip(features.PARTS, (data[:5], data[5:25], rest)):
        counts = [r["count"] for r in sorted(got, key=lambda r: r.bin) if r.part == part]
        assert counts == np.histogram(own, bins=edges)[0].tolist()
    assert sum(r["count"] for r in got) == 60 * 3 + 1
    few = features.histogram(features.with_part(table, "id", 100, 100), "v", 7, by="part", groups=features.PARTS)
    assert few.filter("part <> 'validation'").groupBy("part").sum("count").orderBy("part").collect() == [("rest", 1), ("train", 0)]


def test_histogram_of_a_constant(spark):
    table = spark.createDataFrame([([2.0, 2.0],), ([2.0],)], "v array<double>")
    rows = features.histogram(table, "v", 4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == np.histogram([2.0] * 3, bins=4)[0].tolist()


def test_split_is_exact_and_disjoint(spark):
    table = spark.range(1000).repartition(6)
    validation, train = features.split(table, "id", 100, 250)
    assert sorted(r.id for r in validation.collect()) == list(range(100))
    assert sorted(r.id for r in train.collect()) == list(range(100, 350))


def test_leading_rows_cut_keeps_all_wanted_rows(spark):
    table = spark.range(50_000).select((F.col("id") * 37 % 50_000 * 3).alias("id"))
    cut = leading_rows(table, "id", 500, force=True)
    assert cut.count() < 600
    got = [r.id for r in take_rows(table, "id", 100, skip=400, force=True).collect()]
    assert got == [3 * i for i in range(400, 500)]
    everything = take_rows(table, "id", 60_000, force=True)
    assert everything.count() == 50_000


def test_shuffled_index_and_batches(spark):
    table = spark.range(1234).repartition(5)
    indexed = shuffled_index(table, "id", 1, digits=2)
    order = [r.id for r in indexed.orderBy("row_index").collect()]
    assert sorted(order) == list(range(1234)) and order != sorted(order)
    assert [r.row_index for r in indexed.orderBy("row_index").collect()] == list(range(1234))
    again = [r.id for r in shuffled_index(table.repartition(3), "id", 1).orderBy("row_index").collect()]
    assert again == order
    other = [r.id for r in shuffled_index(table, "id", 2).orderBy("row_index").collect()]
    assert other != order
    sizes = {r.batch_id: r["count"] for r in features.batches(table, "id", 500).groupBy("batch_id").count().collect()}
    assert sizes == {0: 500, 1: 500, 2: 234}


def classified(spark, rows=240):
    table = spark.range(rows).select(
        "id",
        (F.col("id") % 2).cast("double").alias("label"),
        F.array(
            F.col("id") % 2 + F.sin(F.col("id") * 1.7) * 0.8, F.cos(F.col("id") * 0.9)
        ).alias("v"),
    )
    return features.pack_array(table, "v", "label", "id")


def test_holdout_uses_every_row_once(spark):
    validation, train = models.holdout(classified(spark), "id", 0.2)
    assert validation.count() + train.count() == 240
    assert validation.join(train, "id").count() == 0 and validation.count() > 0


def test_sweeps_score_both_splits(spark):
    validation, train = models.holdout(classified(spark), "id", 0.3)
    sizes = models.capacity_sweep(train, validation, 2, ("tiny", "small"), iterations=8).collect()
    assert {(r.model, r.split) for r in sizes} == {
        (m, s) for m in ("tiny", "small") for s in ("train", "validation")
    }
    tiny = next(r for r in sizes if r.model == "tiny")
    assert tiny.parameters == 2 * 16 + 16 + 16 * 2 + 2
    assert all(np.isfinite(r.log_loss) and 0 <= r.accuracy <= 1 for r in sizes)
    rows = models.regularization_sweep(train, validation, penalty=0.5, iterations=20).collect()
    loss = {(r.model, r.split): r.log_loss for r in rows}
    assert loss["none", "train"] < loss["l2", "train"] <= loss["l1", "train"] + 1e-9


def test_scores_equal_the_library_evaluator(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    table = classified(spark).withColumn("split", F.lit("train"))
    predicted = LogisticRegression(maxIter=5).fit(table).transform(table)
    row = models.score(predicted).first()
    for metric, value in (("logLoss", row.log_loss), ("accuracy", row.accuracy)):
        evaluator = MulticlassClassificationEvaluator(metricName=metric)
        assert value == pytest.approx(evaluator.evaluate(predicted))


def test_copies_of_one_key_are_numbered_without_gaps(spark):
    """A third of the rows are copies of one row."""
    table = spark.range(3000, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id")
    )
    indexed = shuffled_index(table, "id", 1, digits=2, salts=8, min_hot_rows=100, force=True)
    rows = indexed.orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(3000))
    assert sorted(r.id for r in rows) == sorted(r.id for r in table.collect())
    plain = shuffled_index(table, "id", 1, digits=2, force=True)
    assert sorted(r.row_index for r in plain.collect()) == list(range(3000))
    # Whatever is spread, single keys keep their numbers, and copies theirs together.
    numbers = {r.id: r.row_index for r in rows if r.id != 7}
    assert numbers == {r.id: r.row_index for r in plain.collect() if r.id != 7}
    few = shuffled_index(table, "id", 1, digits=1, salts=1, min_hot_rows=2, force=True)
    assert numbers == {r.id: r.row_index for r in few.collect() if r.id != 7}


def test_leading_rows_with_a_shared_first_key(spark):
    table = spark.range(20_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id")
    )
    cut = leading_rows(table, "id", 50, force=True)
    assert cut.count() == 8 * 50
    assert "WindowGroupLimit" in cut._jdf.queryExecution().executedPlan().toString()
    assert [r.id for r in take_rows(table, "id", 50, force=True).collect()] == [0] * 50


def test_histogram_leaves_odd_entries_out(spark):
    table = spark.createDataFrame([([0.0, 1.0, float("nan"), None],), ([float("inf"), 2.0, 2.0],), (None,)], "v array<double>")
    rows = features.histogram(table, "v", 2).orderBy("bin").collect()
    assert [(r.left_edge, r["count"]) for r in rows] == [(0.0, 1), (1.0, 3)]


def test_components_take_one_pass_and_skip_incomplete_rows(spark):
    table = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.0, 3.0), (3.0, 6.5, 3.0), (None, 1.0, 3.0)], "a double, b double, c double")
    loadings, explained = features.components(table, ["a", "b", "c"], 2)
    assert loadings[0, 0] == pytest.approx(loadings[1, 0]) and abs(loadings[2, 0]) < 1e-9
    assert sum(explained) == pytest.approx(1.0)
    scores = features.principal_components(table, ["a", "b", "c"], 1).collect()
    assert sum(r.pc1 is None for r in scores) == 1


@pytest.mark.parametrize("copies", [1, 3, 900])
def test_parts_have_exactly_the_wanted_rows(spark, copies):
    """A column of equal keys, of equal rows, and of few keys."""
    table = spark.range(900, numPartitions=6).select(
        F.lit(7).alias("k") if copies == 900 else (F.col("id") % copies).alias("k"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("v")
    )
    table = table.unionByName(spark.createDataFrame([(None, 1)], "k long, v long"))
    parted = features.with_part(table, "k", 100, 350)
    assert parted.columns == ["k", "v", "part"]
    counts = {r.part: r["count"] for r in parted.groupBy("part").count().collect()}
    assert counts == {"validation": 100, "train": 350, "rest": 451}
    ends = {r.part: (r.low, r.high) for r in parted.filter("k IS NOT NULL").groupBy("part").agg(F.min("k").alias("low"), F.max("k").alias("high")).collect()}
    assert ends["validation"][1] <= ends["train"][0] and ends["train"][1] <= ends["rest"][0]
    # The same rows whatever the layout.
    rows = sorted(map(tuple, parted.filter("part = 'train'").select("k", "v").collect()), key=str)
    other = features.with_part(table.repartition(3), "k", 100, 350)
    assert rows == sorted(map(tuple, other.filter("part = 'train'").select("k", "v").collect()), key=str)


def test_split_has_no_row_twice(spark):
    table = spark.range(50).select(F.lit(1).alias("k"), "id")
    validation, train = features.split(table, "k", 20, 20)
    assert validation.count() == train.count() == 20 and validation.join(train, "id").count() == 0
    few = features.split(table, "k", 40, 40)
    assert [part.count() for part in few] == [40, 10]
    assert [part.count() for part in features.split(table.limit(0), "k", 5, 5)] == [0, 0]


def test_a_reused_table_reads_its_input_once(spark, tmp_path):
    from rowcast.plans.reuse import reused, settled

    path = str(tmp_path / "in")
    spark.range(100).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = spark.read.parquet(path).mapInArrow(counted, "id long")
    with reused(rows) as stored:
        total = settled(stored.agg(F.sum("id").alias("s"), F.count(F.lit(1)).alias("n")))
        assert stored.filter("id > 50").count() == 49 and features.with_part(stored, "id", 3, 4).count() == 100
        where = stored.inputFiles()[0]
    assert reads.value == 100
    assert total.collect() == [(4950, 100)]
    import os

    assert not os.path.exists(where.removeprefix("file://").removeprefix("file:"))
