"""Feature preparation: packing, scaling, components, histograms, splits, batches."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowcast.functions.vectors import scatter, weighed
from rowcast.plans.joins import POSITION, with_position
from rowcast.plans.numbering import CONTENT, content, leading_cut, shuffled_index, within_cut


def pack(df: DataFrame, features: Sequence[str], label: str, *keep: str) -> DataFrame:
    """Number columns as one ``features`` vector next to ``label`` and ``keep``."""
    packed = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    return packed.select(*keep, F.col(label).alias("label"), "features")


def pack_array(df: DataFrame, features: str, label: str, *keep: str) -> DataFrame:
    """An array column as a ``features`` vector next to ``label`` and ``keep``."""
    vector = array_to_vector(F.col(features).cast("array<double>"))
    return df.select(*keep, F.col(label).alias("label"), vector.alias("features"))


def _one_row(stats: DataFrame) -> Column:
    """A one-row result as a struct, used as a scalar subquery of another plan."""
    return stats.select(F.struct(*stats.columns).alias("row")).scalar()


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Means and population deviations of ``columns`` in one row; 1 for a deviation of 0."""
    return df.agg(*_moment_columns(columns))


def _moment_columns(columns: Sequence[str]) -> list[Column]:
    deviations = {name: F.stddev_pop(name) for name in columns}
    return [F.avg(name).alias(f"{name}_mean") for name in columns] + [
        F.when(deviation == 0, 1.0).otherwise(deviation).alias(f"{name}_dev")
        for name, deviation in deviations.items()
    ]


def _number(value: Column | float | None) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("double")


def _centred(df: DataFrame, columns: Sequence[str], stats) -> DataFrame:
    return df.withColumns(
        {
            name: (F.col(name) - _number(stats[f"{name}_mean"])) / _number(stats[f"{name}_dev"])
            for name in columns
        }
    )


def standardized(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace ``columns`` by their distance from the mean in population deviations.

    One aggregation of fixed size, then one projection; rows do not move. A
    constant column becomes zeros.
    """
    return _centred(df, columns, _one_row(moments(df, columns)))


def _correlated(df: DataFrame, columns: Sequence[str]) -> tuple[dict, np.ndarray]:
    """Moments and the correlation matrix of complete rows, by one aggregation of fixed size."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    whole = df.dropna(subset=list(columns))
    products = [F.covar_pop(a, b).alias(f"{a}_{b}_product") for a, b in pairs]
    deviations = [F.stddev_pop(name).alias(f"{name}_spread") for name in columns]
    row = whole.agg(*_moment_columns(columns), *products, *deviations).first().asDict()
    matrix = np.eye(len(columns))
    for i, a in enumerate(columns):
        matrix[i, i] = 1.0 if row[f"{a}_spread"] else 0.0
        for j in range(i + 1, len(columns)):
            b = columns[j]
            product = row[f"{a}_{b}_product"] or 0.0
            matrix[i, j] = matrix[j, i] = product / row[f"{a}_dev"] / row[f"{b}_dev"]
    return row, matrix


def _leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Loadings and explained shares; a vector's largest entry is positive."""
    strength, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-strength, kind="stable")[:count]
    loadings = vectors[:, order]
    strongest = np.abs(loadings).argmax(axis=0)
    signs = np.sign(loadings[strongest, np.arange(loadings.shape[1])])
    return loadings * signs, strength[order] / max(strength.sum(), np.finfo(float).tiny)


def components(scaled: DataFrame, columns: Sequence[str], count: int = 2):
    """Loadings (columns by components) and explained variance of standardized data.

    Every loading vector is turned so that its largest entry is positive. Rows
    with a NULL among ``columns`` do not take part.
    """
    return _leading(_correlated(scaled, columns)[1], count)


def principal_components(
    df: DataFrame, columns: Sequence[str], count: int = 2, *keep: str
) -> DataFrame:
    """Scores ``pc1 .. pcN`` of every row, next to the ``keep`` columns.

    One aggregation gives the moments and all products of two columns; the
    loadings are the eigenvectors of that small matrix. Scoring is plain
    arithmetic in the scan's own stage, so the label stays with its row.
    """
    stats, matrix = _correlated(df, columns)
    loadings, _ = _leading(matrix, count)
    scaled = _centred(df, columns, stats)
    scores = []
    for j in range(count):
        terms = [F.col(name) * float(loadings[i, j]) for i, name in enumerate(columns)]
        total = terms[0]
        for term in terms[1:]:
            total = total + term
        scores.append(total.alias(f"pc{j + 1}"))
    return scaled.select(*keep, *scores)


def array_components(df: DataFrame, column: str, count: int = 2, *keep: str) -> DataFrame:
    """Scores ``pc1 .. pcN`` of an array column of any width, next to the ``keep`` columns.

    As ``principal_components``: entries are standardized, a constant one
    becomes 0. The correlation matrix is one accumulator, not an aggregate per
    pair. Rows that took no part in it have NULL scores.
    """
    rows, means, products = scatter(df, column)
    if not rows:
        return df.select(*keep, *[F.lit(None).cast("double").alias(f"pc{j + 1}") for j in range(count)])
    spread = np.sqrt(np.diag(products) / rows)
    scale = np.where(spread == 0, 1.0, spread)
    loadings, _ = _leading(products / rows / np.outer(scale, scale), count)
    fits = F.size(column) == len(means)
    return df.select(
        *keep,
        *[
            F.when(fits, weighed(column, loadings[:, j].tolist(), means.tolist(), scale.tolist())).alias(f"pc{j + 1}")
            for j in range(loadings.shape[1])
        ],
    )


def of_class(df: DataFrame, label: str, value) -> DataFrame:
    """The rows of one class."""
    return df.filter(F.col(label) == value)


def class_summary(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Row count and mean of ``columns`` for every class at once."""
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.avg(name).alias(f"mean_{name}") for name in columns],
    )


def histogram(
    df: DataFrame, values: str, bins: int = 101, by: str | None = None, groups: Sequence[str] = ()
) -> DataFrame:
    """Counts per equal-width bin over all entries of the array column ``values``.

    The last bin includes its right edge; a constant column gets the range
    value +/- 0.5. Entries are binned where they are read, and only ``bins``
    partial counts leave each task. Empty bins are part of the result. NULL, NaN
    and infinite entries are left out. With ``by``, counts are per value of that
    column among ``groups``, over the same bins of all rows.
    """
    keys = [by] if by else []
    finite = lambda x: F.abs(x) < F.lit(float("inf"))
    numbers = F.filter(F.col(values).cast("array<double>"), finite)
    span = df.select(numbers.alias("v")).agg(
        F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")
    )
    flat = F.col("low") == F.col("high")
    edges = _one_row(
        span.select(
            F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
            F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
        )
    )
    low, width = edges["low"], edges["high"] - edges["low"]
    position = F.floor((F.col("x") - low) / width * float(bins)).cast("int")
    counted = (
        df.select(*keys, F.explode(numbers).alias("x"))
        .filter(F.col("x").isNotNull())
        .select(*keys, F.least(position, F.lit(bins - 1)).alias("bin"))
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if by:
        all_bins = all_bins.select("bin", F.explode(F.array(*map(F.lit, groups))).alias(by))
    return all_bins.join(counted, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (low + F.col("bin") * width / float(bins)).alias("left_edge"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("count"),
    )


PARTS = ("validation", "train", "rest")


def split(
    df: DataFrame, key: str, validation: int = 1_000, train: int = 10_000, **options
) -> tuple[DataFrame, DataFrame]:
    """The first ``validation`` rows in key order, and the next ``train`` rows; no row is in both."""
    parted = with_part(df, key, validation, train, **options)
    return tuple(parted.filter(F.col("part") == name).drop("part") for name in PARTS[:2])


def with_part(
    df: DataFrame, key: str, validation: int = 1_000, train: int = 10_000, **options
) -> DataFrame:
    """All rows with the ``part`` of the split they fall in; ``rest`` is past both.

    Parts have exactly the wanted rows, also where a key repeats across a
    boundary: rows of one key are in the order of a hash of their content, and
    equal rows in the order of the scan. Rows without a key belong to the rest.
    """
    marked = content(with_position(df))
    cuts = [leading_cut(marked, key, count, **options) for count in (validation, validation + train)]
    part = F.when(within_cut(cuts[0], key), PARTS[0]).when(within_cut(cuts[1], key), PARTS[1])
    added = [c for c in (POSITION, CONTENT) if c not in df.columns]
    return marked.withColumn("part", part.otherwise(PARTS[2])).drop(*added)


def batches(df: DataFrame, key: str, size: int = 500, seed: int = 7) -> DataFrame:
    """Shuffle by seed and number the rows in batches of ``size``."""
    indexed = shuffled_index(df, key, seed)
    return indexed.withColumn(
        "batch_id", F.call_function("div", F.col("row_index"), F.lit(size).cast("bigint"))
    )
