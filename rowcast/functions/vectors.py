"""Adding up vectors and matrices over a table, a row of the matrix at a time.

Every task adds its own rows in numpy and hands on one row of numbers per row
of the matrix; those are dealt out by their place and merged. What moves is as
large as the matrix, once a task, and no task merges a whole matrix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PARTS = "place int, n long, mean binary, part binary"
_NAMES = [field.split()[0] for field in _PARTS.split(", ")]


def _records(rows) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _NAMES)


def joined_moments(one: tuple, other: tuple) -> tuple:
    """Counts, means and centred products of two sets of rows as those of both; products may be some rows of the matrix.

    ``(n, mean, places, products)``, the places being which rows of the matrix.
    """
    n = one[0] + other[0]
    gap = other[1] - one[1]
    products = one[3] + other[3] + np.outer(gap[one[2]], gap) * (one[0] * other[0] / n)
    return n, one[1] + gap * (other[0] / n), one[2], products


def scatter(df: DataFrame, column: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and the matrix of centred products of an array column, in one pass.

    Arrays that are NULL, hold something that is not a finite number, or are of
    another length than the longest, take no part. Means are taken out before
    squaring, so large means cost no digits. The result is as large as the
    square of the array's length, whatever the table; no rows give ``0`` and
    empty arrays.
    """
    sound = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = df.select(F.col(column).cast("array<double>").alias("v")).filter(sound)
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    rows = rows.filter(F.size("v") == width)
    if not width:
        return 0, np.zeros(0), np.zeros((0, 0))
    every = np.arange(width)

    def partial(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, width)
                mean = x.mean(axis=0)
                centred = x - mean
                own = (len(x), mean, every, centred.T @ centred)
                total = own if total is None else joined_moments(total, own)
        if total is not None:
            yield _records([(i, total[0], total[1].tobytes(), row.tobytes()) for i, row in enumerate(total[3])])

    def merge(batches):
        held = {}
        for batch in batches:
            for place, n, mean, part in zip(*(c.to_pylist() for c in batch.columns)):
                own = (n, np.frombuffer(mean), np.array([place]), np.frombuffer(part)[None, :])
                held[place] = joined_moments(held[place], own) if place in held else own
        yield _records([(place, n, mean.tobytes(), part.tobytes()) for place, (n, mean, _, part) in sorted(held.items())])

    whole = rows.mapInArrow(partial, _PARTS).repartition("place").mapInArrow(merge, _PARTS)
    found = {r.place: r for r in whole.collect()}
    products = np.stack([np.frombuffer(found[i].part) for i in range(width)])
    return found[0].n, np.frombuffer(found[0].mean), products


def weighed(column: str, weights: list[float], means: list[float], scales: list[float]):
    """``sum(weight * (x - mean) / scale)`` of an array column; NULL if a component is missing."""
    terms = F.transform(
        F.arrays_zip(
            F.col(column).cast("array<double>").alias("x"),
            F.array(*map(F.lit, map(float, weights))).alias("w"),
            F.array(*map(F.lit, map(float, means))).alias("m"),
            F.array(*map(F.lit, map(float, scales))).alias("s"),
        ),
        lambda t: (t["x"] - t["m"]) / t["s"] * t["w"],
    )
    return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
