"""Approximate quantiles from a mergeable sketch kept as a column.

A KLL sketch is built with map-side combining, in one pass and without a call
to the driver, for the whole table or for every group at once. It is a binary
column: it can be stored, and sketches of smaller groups merge into those of
larger ones without another look at the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROBABILITIES = (0.25, 0.5, 0.75, 0.9, 0.99)
ERROR = 0.01


def sketch_size(error: float) -> int:
    """The sketch's ``k`` for a rank error well below ``error``.

    The published bound at 99 % confidence is ``2.296 / k ** 0.9021``; half of
    ``error`` is asked for, so that many quantiles of many groups stay inside; 0
    takes the largest sketch, exact up to some 60 000 values.
    """
    if error <= 0:
        return 65_535
    return min(65_535, max(8, math.ceil((2.296 / (error / 2)) ** (1 / 0.9021))))


def sketched(df: DataFrame, keys: Sequence[str], column: str, error: float = ERROR) -> DataFrame:
    """``keys``, the number of values and their sketch; NULL, NaN and infinite values are left out."""
    value = F.col(column).cast("double")
    finite = F.when(F.abs(value) < F.lit(float("inf")), value)
    return df.select(*keys, finite.alias("_value")).groupBy(*keys).agg(
        F.count("_value").alias("value_count"), F.kll_sketch_agg_double("_value", sketch_size(error)).alias("sketch")
    )


def merged(sketches: DataFrame, keys: Sequence[str] = (), error: float = ERROR) -> DataFrame:
    """Sketches of the coarser groups ``keys``, from sketches alone."""
    return sketches.groupBy(*keys).agg(
        F.sum("value_count").alias("value_count"), F.kll_merge_agg_double("sketch", sketch_size(error)).alias("sketch")
    )


def estimated(sketches: DataFrame, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """One row per group and probability: ``probability, quantile``; groups without values give none."""
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    found = F.kll_sketch_get_quantile_double("sketch", asked)
    keys = [c for c in sketches.columns if c not in ("value_count", "sketch")]
    pairs = sketches.filter("value_count > 0").select(*keys, "value_count", F.explode(F.arrays_zip(asked.alias("p"), found.alias("q"))).alias("pair"))
    return pairs.select(*keys, "value_count", F.col("pair.p").alias("probability"), F.col("pair.q").alias("quantile"))


def rank_errors(df: DataFrame, keys: Sequence[str], column: str, estimates: DataFrame) -> DataFrame:
    """``estimates`` with ``rank_error``: how far each lies from its probability, by counting all values.

    0 where the probability falls on one of the equal values of the quantile.
    """
    value = F.col(column).cast("double")
    # A few quantiles a group travel to its values, which are counted where they are read.
    listed = estimates.groupBy(*keys).agg(F.collect_list(F.struct("probability", "quantile")).alias("_asked"))
    named = listed.select(*[F.col(k).alias(f"_{k}") for k in keys], "_asked")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    rows = df.filter(F.abs(value) < F.lit(float("inf"))).select(*keys, value.alias("_value"))
    rows = rows.join(named, same) if keys else rows.withColumn("_asked", named.scalar())
    each = rows.select(*keys, "_value", F.explode("_asked").alias("_one")).select(*keys, "_value", "_one.probability", "_one.quantile")
    counted = each.groupBy(*keys, "probability", "quantile").agg(
        F.count(F.lit(1)).alias("value_count"),
        F.count_if(F.col("_value") < F.col("quantile")).alias("_below"),
        F.count_if(F.col("_value") <= F.col("quantile")).alias("_upto"),
    )
    low, high = F.col("_below") / F.col("value_count"), F.col("_upto") / F.col("value_count")
    off = F.greatest(F.lit(0.0), low - F.col("probability"), F.col("probability") - high)
    return counted.select(*keys, "probability", "quantile", "value_count", off.alias("rank_error"))
