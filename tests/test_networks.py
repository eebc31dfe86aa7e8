"""Full-batch fits against plain numpy, their penalties, and sums of matrices over a table."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rowcast.functions import vectors
from rowcast.operators import features, networks


def table(spark, rows=400):
    frame = spark.range(rows, numPartitions=5).select(
        "id",
        (F.col("id") % 2).alias("label"),
        F.array(F.col("id") % 2 + F.sin(F.col("id") * 1.7) * 0.8, F.cos(F.col("id") * 0.9), F.lit(0.5)).alias("v"),
        F.when(F.col("id") % 5 == 0, "validation").otherwise("train").alias("split"),
    )
    odd = spark.createDataFrame([(-1, None, [1.0, 1.0, 1.0], "train"), (-2, 1, None, "train")], "id long, label long, v array<double>, split string")
    return frame.unionByName(odd)


def test_steps_equal_finite_differences():
    draw = np.random.default_rng(1)
    x, y = draw.normal(size=(30, 4)), draw.integers(0, 2, 30).astype(float)
    net = networks.network("n", 4, [5, 3])

    def loss(at):
        p = networks.outputs(at, x)[1]
        return -np.log(np.where(y == 1, p, 1 - p)).sum()

    found = networks.gradients(net, x, y)
    for layer, place in ((0, (2, 1)), (1, (0, 4)), (2, (0, 0))):
        moved = networks.network("n", 4, [5, 3])
        moved.weights[layer][place] += 1e-6
        assert found[layer][place] == pytest.approx((loss(moved) - loss(net)) / 1e-6, rel=1e-3, abs=1e-4)


def test_fit_beats_the_class_shares_and_equals_sql(spark):
    rows = table(spark)
    nets = [networks.network("none", 3, []), networks.network("tiny", 3, [16]), networks.network("deep", 3, [4, 4])]
    fit = networks.fitted(nets, rows.filter("split = 'train'"), "v", "label", steps=25, rate=0.8)
    scores = {(r.model, r.split): r for r in networks.scored(fit, rows, "v", "label", "split").collect()}
    assert len(scores) == 6 and scores["tiny", "train"].rows == 320 and scores["tiny", "validation"].rows == 80
    assert scores["tiny", "train"].parameters == 3 * 16 + 16 + 16 + 1
    for name in ("none", "tiny"):
        assert scores[name, "train"].log_loss < 0.6 < np.log(2) and scores[name, "train"].accuracy > 0.7
    link = duckdb.connect()
    link.register("given", rows.filter("label IS NOT NULL AND v IS NOT NULL").toPandas())
    data = "SELECT id, split, v::DOUBLE[] AS x, label::DOUBLE AS y FROM given"
    for name, hidden in (("none", []), ("deep", [4, 4])):
        for split, count, zeros, loss, accuracy in link.execute(networks.oracle_sql(3, hidden, 25, 0.8, data)).fetchall():
            row = scores[name, split]
            assert (count, zeros) == (row.rows, row.zero_weights)
            assert loss == pytest.approx(row.log_loss, abs=1e-9) and accuracy == pytest.approx(row.accuracy)


def test_penalties(spark):
    rows = table(spark).filter("split = 'train'")
    kinds = {"none": (0, 0), "l1": (0.02, 0), "l2": (0, 0.02)}
    fit = networks.fitted([networks.network(name, 3, [8], *p) for name, p in kinds.items()], rows, "v", "label", steps=20)
    plain, absolute, squared = fit
    assert absolute.zeros > 3 and plain.zeros == squared.zeros == 0
    size = [sum(float((w**2).sum()) for w in net.weights) for net in fit]
    assert size[2] < size[0] and size[1] < size[0]


def test_no_rows_leave_networks_as_they_are(spark):
    net = networks.network("n", 3, [2])
    same = networks.fitted([net], table(spark).limit(0), "v", "label", steps=3)[0]
    assert all((a == b).all() for a, b in zip(net.weights, same.weights))
    with pytest.raises(Exception, match="has not 3 components"):
        networks.fitted([net], spark.createDataFrame([([1.0], 1)], "v array<double>, label int"), "v", "label", steps=1)


@pytest.mark.parametrize("width", [1, 28, 64])
def test_scatter(spark, width):
    draw = np.random.default_rng(width)
    x = draw.normal(size=(300, width)) * 3 + 1e6
    rows = [(row.tolist(),) for row in x] + [(None,), ([None] * width,), ([float("nan")] * width,), ([],)]
    frame = spark.createDataFrame(rows, "v array<double>").repartition(7)
    count, mean, products = vectors.scatter(frame, "v")
    centred = x - x.mean(axis=0)
    assert count == 300 and np.allclose(mean, x.mean(axis=0)) and np.allclose(products, centred.T @ centred, rtol=1e-6, atol=1e-6)


def test_array_components(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(200, 3)) @ np.array([[1, 2, 0], [0, 1, 3], [0, 0, 0.1]])
    x = np.hstack([x, np.full((200, 1), 7.0)])
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)] + [(-1, None), (-2, [1.0])], "id long, v array<double>")
    got = {r.id: r for r in features.array_components(frame, "v", 2, "id").collect()}
    assert got[-1].pc1 is None and got[-2].pc1 is None
    deviation = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(deviation == 0, 1, deviation)
    strength, axes = np.linalg.eigh(z.T @ z)
    for name, axis in (("pc1", axes[:, -1]), ("pc2", axes[:, -2])):
        axis = axis * np.sign(axis[np.abs(axis).argmax()])
        assert np.allclose([got[i][name] for i in range(200)], z @ axis)
    assert features.array_components(frame.limit(0), "v", 2, "id").columns == ["id", "pc1", "pc2"]
