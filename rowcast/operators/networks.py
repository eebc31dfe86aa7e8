"""Feed-forward classifiers fitted by full-batch steps, each one aggregation over the table.

A network has hidden layers with the exponential linear unit and one logistic
output. A step adds up the gradient of the mean cross-entropy over all training
rows: every task sums its rows, partial sums are added by unit, and what comes
to the driver is as large as the networks, whatever the table. Several networks
are fitted side by side, so a sweep reads the table once a step. Weights start
from whole-number arithmetic and the number of steps is fixed, so a fit can be
repeated, also in another engine.

Penalties act on weights, not on biases, as proximal steps: an absolute penalty
moves every weight towards 0 and stops there, a squared one shrinks it.

Rows with a NULL label or vector take no part; a vector of another length than
the networks' input is an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: probabilities are kept above this before taking logarithms.
SMALLEST = 1e-15


@dataclass
class Network:
    """``weights[l]`` (units by inputs) and ``biases[l]``; the penalties of its fit."""

    name: str
    weights: list[np.ndarray]
    biases: list[np.ndarray]
    l1: float = 0.0
    l2: float = 0.0

    @property
    def parameters(self) -> int:
        return sum(w.size for w in self.weights) + sum(b.size for b in self.biases)

    @property
    def zeros(self) -> int:
        return int(sum((w == 0).sum() for w in self.weights))


def start(layer: int, units: int, inputs: int) -> np.ndarray:
    """First weights of a layer: thousandths from -1 to 1 by whole-number arithmetic, over the root of the inputs."""
    j, i = np.arange(units)[:, None], np.arange(inputs)[None, :]
    spread = ((j + 1) * 7919 + (i + 1) * 104_729 + (layer + 1) * 15_485_863 + (j + 1) * (i + 1) * 31) % 2001
    return (spread - 1000) / 1000.0 / np.sqrt(float(inputs))


def network(name: str, inputs: int, hidden: Sequence[int], l1: float = 0.0, l2: float = 0.0) -> Network:
    sizes = [inputs, *hidden, 1]
    weights = [start(layer, b, a) for layer, (a, b) in enumerate(zip(sizes, sizes[1:]))]
    return Network(name, weights, [np.zeros(b) for b in sizes[1:]], l1, l2)


def _elu(values: np.ndarray) -> np.ndarray:
    return np.where(values > 0, values, np.expm1(np.minimum(values, 0)))


def outputs(net: Network, x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """What every layer takes in, and the probability of label 1."""
    taken = [x]
    for w, b in zip(net.weights[:-1], net.biases[:-1]):
        taken.append(_elu(taken[-1] @ w.T + b))
    raw = taken[-1] @ net.weights[-1].T + net.biases[-1]
    return taken, 1 / (1 + np.exp(-np.clip(raw[:, 0], -700, 700)))


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Summed gradients of the cross-entropy, a matrix a layer with the bias as last column."""
    taken, p = outputs(net, x)
    delta = (p - y)[:, None]
    found = []
    for layer in range(len(net.weights) - 1, -1, -1):
        found.append(np.hstack([delta.T @ taken[layer], delta.sum(axis=0)[:, None]]))
        if layer:
            slope = np.where(taken[layer] > 0, 1.0, taken[layer] + 1)
            delta = (delta @ net.weights[layer]) * slope
    return found[::-1]


def _matrix(batch: pa.RecordBatch, inputs: int) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(0)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != inputs * len(column):
        raise ValueError(f"a vector has not {inputs} components")
    return flat.reshape(len(column), inputs).astype(float), batch.column(1).to_numpy(zero_copy_only=False).astype(float)


def _rows(df: DataFrame, features: str, label: str) -> DataFrame:
    rows = df.select(F.col(features).cast("array<double>").alias("x"), F.col(label).cast("double").alias("y"))
    return rows.filter("x IS NOT NULL AND y IS NOT NULL")


def _summed(nets: list[Network], train: DataFrame) -> tuple[int, list[list[np.ndarray]]]:
    """Number of training rows and the gradients of all networks, by one aggregation."""
    inputs = nets[0].weights[0].shape[1]
    schema = "net int, layer int, unit int, part binary, n long"

    def partial(batches):
        total, count = None, 0
        for batch in batches:
            x, y = _matrix(batch, inputs)
            own = [gradients(net, x, y) for net in nets]
            total = own if total is None else [[a + b for a, b in zip(p, q)] for p, q in zip(total, own)]
            count += len(y)
        if count:
            yield from _records((k, layer, unit, row.tobytes(), count) for k, net in enumerate(total) for layer, m in enumerate(net) for unit, row in enumerate(m))

    def add(batches):
        total, counts = {}, {}
        for batch in batches:
            for k, layer, unit, part, n in zip(*(c.to_pylist() for c in batch.columns)):
                key = (k, layer, unit)
                row = np.frombuffer(part)
                total[key] = total[key] + row if key in total else row
                counts[key] = counts.get(key, 0) + n
        yield from _records((*key, row.tobytes(), counts[key]) for key, row in sorted(total.items()))

    parts = train.mapInArrow(partial, schema)
    # The units of all networks are dealt out, so no task adds up more than its share.
    whole = parts.repartition(F.col("net"), F.col("layer"), F.col("unit")).mapInArrow(add, schema)
    found = [[np.zeros((w.shape[0], w.shape[1] + 1)) for w in net.weights] for net in nets]
    count = 0
    for r in whole.collect():
        found[r.net][r.layer][r.unit] = np.frombuffer(r.part)
        count = r.n
    return count, found


def _records(rows, size: int = 256):
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
    names = ["net", "layer", "unit", "part", "n"]
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)


def stepped(net: Network, sums: list[np.ndarray], rows: int, rate: float) -> Network:
    """One step down the mean gradient, then the penalties' proximal steps."""
    weights, biases = [], []
    for w, b, g in zip(net.weights, net.biases, sums):
        moved = w - rate * g[:, :-1] / rows
        if net.l1:
            moved = np.sign(moved) * np.maximum(np.abs(moved) - rate * net.l1, 0.0)
        if net.l2:
            moved = moved / (1 + 2 * rate * net.l2)
        weights.append(moved)
        biases.append(b - rate * g[:, -1] / rows)
    return Network(net.name, weights, biases, net.l1, net.l2)


def fitted(nets: Sequence[Network], train: DataFrame, features: str, label: str, steps: int = 20, rate: float = 0.5) -> list[Network]:
    """The networks after ``steps`` full-batch steps over ``train``; as they are if it has no rows.

    ``train`` is read once a step, so it should be a stored table.
    """
    rows, nets = _rows(train, features, label), list(nets)
    for _ in range(steps):
        count, sums = _summed(nets, rows)
        if not count:
            break
        nets = [stepped(net, own, count, rate) for net, own in zip(nets, sums)]
    return nets


def scored(nets: Sequence[Network], df: DataFrame, features: str, label: str, split: str) -> DataFrame:
    """``model, parameters, zero_weights, split, rows, log_loss, accuracy`` over all rows, in one pass for all networks."""
    nets = list(nets)
    inputs = nets[0].weights[0].shape[1]
    rows = df.select(F.col(features).cast("array<double>").alias("x"), F.col(label).cast("double").alias("y"), F.col(split).cast("string").alias("split"))
    rows = rows.filter("x IS NOT NULL AND y IS NOT NULL")

    def measure(batches):
        for batch in batches:
            x, y = _matrix(batch, inputs)
            names, place = np.unique(np.array(batch.column(2).to_pylist(), dtype=object).astype(str), return_inverse=True)
            out = []
            for k, net in enumerate(nets):
                p = outputs(net, x)[1]
                loss = -np.log(np.maximum(np.where(y == 1, p, 1 - p), SMALLEST))
                right = (p > 0.5) == (y == 1)
                sums = (np.bincount(place), np.bincount(place, weights=loss), np.bincount(place, weights=right))
                out += [(k, name, int(n), float(s), int(hit)) for name, n, s, hit in zip(names, *sums)]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["net", "split", "n", "loss", "hits"])

    measured = rows.mapInArrow(measure, "net int, split string, n long, loss double, hits long")
    summed = measured.groupBy("net", "split").agg(F.sum("n").alias("rows"), F.sum("loss").alias("loss"), F.sum("hits").alias("hits"))
    known = df.sparkSession.createDataFrame(
        [(k, net.name, net.parameters, net.zeros) for k, net in enumerate(nets)], "net int, model string, parameters long, zero_weights long"
    )
    return summed.join(F.broadcast(known), "net").select(
        "model", "parameters", "zero_weights", "split", "rows", (F.col("loss") / F.col("rows")).alias("log_loss"), (F.col("hits") / F.col("rows")).alias("accuracy")
    )


def oracle_sql(inputs: int, hidden: Sequence[int], steps: int, rate: float, data: str, l1: float = 0.0, l2: float = 0.0) -> str:
    """The same fit as DuckDB SQL: ``split, rows, zero_weights, log_loss, accuracy``.

    ``data`` yields ``id, split, x, y``; rows of split ``train`` are fitted. Steps
    are written out one after the other; weights are lists of lists, and a
    gradient is the inner product of two columns taken over all rows.
    """
    sizes = [inputs, *hidden, 1]
    layers = range(len(sizes) - 1)
    first = ", ".join(
        f"list_transform(range(1, {sizes[k + 1] + 1}), lambda j: list_transform(range(1, {sizes[k] + 1}), lambda i: "
        f"((j * 7919 + i * 104729 + {(k + 1) * 15_485_863} + j * i * 31) % 2001 - 1000) / 1000.0::DOUBLE / sqrt({sizes[k]}::DOUBLE))) AS w{k}, "
        f"list_transform(range({sizes[k + 1]}), lambda j: 0.0::DOUBLE) AS b{k}"
        for k in layers
    )
    parts = [f"data AS MATERIALIZED ({data})", f"step0 AS MATERIALIZED (SELECT {first})"]

    def forward(name: str, step: int, where: str) -> list[str]:
        out = []
        before = f"SELECT id, split, y, x AS a0 FROM data {where}"
        for k in layers:
            raw = f"list_transform(range(1, {sizes[k + 1] + 1}), lambda j: b{k}[j] + list_dot_product(w{k}[j], a{k}))"
            if k < len(sizes) - 2:
                raw = f"list_transform({raw}, lambda s: CASE WHEN s > 0 THEN s ELSE exp(s) - 1 END)"
            else:
                raw = f"list_transform({raw}, lambda s: 1 / (1 + exp(-s)))"
            source = f"({before})" if k == 0 else f"{name}_{k - 1}"
            out.append(f"{name}_{k} AS MATERIALIZED (SELECT f.*, {raw} AS a{k + 1} FROM {source} f, (SELECT w{k}, b{k} FROM step{step}))")
        return out

    top = len(sizes) - 2
    for step in range(steps):
        name = f"up{step}"
        parts += forward(name, step, "WHERE split = 'train'")
        source, deltas = f"{name}_{top}", f"[a{top + 1}[1] - y]"
        parts.append(f"down{step}_{top} AS MATERIALIZED (SELECT *, {deltas} AS d{top} FROM {source})")
        for k in range(top - 1, -1, -1):
            turned = f"(SELECT list_transform(range(1, {sizes[k + 1] + 1}), lambda i: list_transform(w{k + 1}, lambda r: r[i])) AS t FROM step{step})"
            slope = f"CASE WHEN a{k + 1}[i] > 0 THEN 1 ELSE a{k + 1}[i] + 1 END"
            delta = f"list_transform(range(1, {sizes[k + 1] + 1}), lambda i: list_dot_product(t[i], d{k + 1}) * {slope})"
            parts.append(f"down{step}_{k} AS MATERIALIZED (SELECT f.*, {delta} AS d{k} FROM down{step}_{k + 1} f, {turned})")
        for k in layers:
            for letter in "ad":
                parts.append(
                    f"{letter}{step}_{k} AS MATERIALIZED (SELECT list(c ORDER BY i) AS c FROM (SELECT i, list(v ORDER BY id) AS c FROM "
                    f"(SELECT id, unnest({letter}{k}) AS v, generate_subscripts({letter}{k}, 1) AS i FROM down{step}_0) GROUP BY i))"
                )
            moved = f"w{k}[j][i] - {rate} * list_dot_product(d.c[j], a.c[i]) / len(d.c[1])"
            if l1:
                moved = f"sign({moved}) * greatest(abs({moved}) - {rate * l1}, 0.0)"
            if l2:
                moved = f"({moved}) / {1 + 2 * rate * l2}"
            parts.append(
                f"layer{step}_{k} AS MATERIALIZED (SELECT "
                f"list_transform(range(1, {sizes[k + 1] + 1}), lambda j: list_transform(range(1, {sizes[k] + 1}), lambda i: {moved})) AS w{k}, "
                f"list_transform(range(1, {sizes[k + 1] + 1}), lambda j: b{k}[j] - {rate} * list_sum(d.c[j]) / len(d.c[1])) AS b{k} "
                f"FROM step{step}, a{step}_{k} a, d{step}_{k} d)"
            )
        columns = ", ".join(f"layer{step}_{k}.w{k}, layer{step}_{k}.b{k}" for k in layers)
        parts.append(f"step{step + 1} AS MATERIALIZED (SELECT {columns} FROM {', '.join(f'layer{step}_{k}' for k in layers)})")
    parts += forward("last", steps, "")
    zeros = " + ".join(f"list_sum(list_transform(w{k}, lambda r: len(list_filter(r, lambda v: v = 0))))" for k in layers)
    chosen = f"CASE WHEN y = 1 THEN a{top + 1}[1] ELSE 1 - a{top + 1}[1] END"
    return (
        "WITH " + ", ".join(parts) + f" SELECT split, COUNT(*) AS rows, (SELECT CAST({zeros} AS BIGINT) FROM step{steps}) AS zero_weights, "
        f"AVG(-LN(GREATEST({chosen}, {SMALLEST}))) AS log_loss, "
        f"AVG(CASE WHEN (a{top + 1}[1] > 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END) AS accuracy FROM last_{top} GROUP BY split"
    )
