"""Equi-joins that keep their shape when one key holds much of a table.

Three ways, from cheap to heavy:

* a build side under the session's broadcast threshold is left to Spark, one
  somewhat larger is broadcast after its size was measured;
* small inputs use a plain join, and AQE picks the physical strategy and splits
  skewed partitions; neither of these runs a job while the query is built;
* large inputs use ``skew_join``: heavy keys found by a mergeable sketch are
  spread over a grid of salts, so no task receives one key whole. Without
  heavy keys it is a plain join again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rowcast.plans.sizing import broadcastable, left_to_spark, modest

POSITION = "_position"
# The sketch lists at most this many keys, which bounds what is collected and broadcast.
MAX_HOT_KEYS = 20_000
SKETCH_ITEMS = 100_000
MERGE_BRANCHES = 512
# Rows of one key that one task may get; a key with more is spread.
TASK_ROWS = 1_000_000


def with_position(df: DataFrame) -> DataFrame:
    """Add a row position to salt by.

    Call it on a scan (or a row-wise transformation of one): file splits are
    read in a fixed order, so a task that runs again gives the same positions.
    """
    if POSITION in df.columns:
        return df
    return df.withColumn(POSITION, F.monotonically_increasing_id())


def hot_keys(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Keys of ``df`` with their ``hot_rows``: at least ``min_rows``, and one in ``MAX_HOT_KEYS``.

    One pass over one column: every task makes a sketch of fixed size, and the
    sketches are merged in two levels, so no task receives one from every
    other. The sketch lists only keys it has seen, and it cannot miss a key
    above its error, which is smaller than the share asked for.
    """
    branch = F.pmod(F.spark_partition_id(), F.lit(MERGE_BRANCHES)).alias("branch")
    counted = (
        df.filter(F.col(key).isNotNull())
        .groupBy(branch)
        .agg(
            F.expr(f"approx_top_k_accumulate(`{key}`, {SKETCH_ITEMS})").alias("sketch"),
            F.count(F.lit(1)).alias("total"),
        )
    )
    # Grouping by a constant gives no row, and no empty sketch, for no input.
    listed = (
        counted.groupBy(F.lit(0).alias("all"))
        .agg(
            F.expr(f"approx_top_k_combine(sketch, {SKETCH_ITEMS})").alias("sketch"),
            F.sum("total").alias("total"),
        )
        .select(
            "total",
            F.explode(F.expr(f"approx_top_k_estimate(sketch, {MAX_HOT_KEYS})")).alias("entry"),
        )
    )
    floor = F.greatest(F.lit(min_rows).cast("bigint"), F.ceil(F.col("total") / MAX_HOT_KEYS))
    return listed.filter(F.col("entry.count") >= floor).select(
        F.col("entry.item").alias(key), F.col("entry.count").alias("hot_rows")
    )


def _salted(hot: list, df: DataFrame, key: str, min_hot_rows: int, name: str) -> DataFrame:
    """``(key, name)``: how many salts each hot key gets, by its counted rows."""
    rows = [(value, -(-count // min_hot_rows) + 1) for value, count in hot]
    schema = StructType([StructField(key, df.schema[key].dataType), StructField(name, IntegerType())])
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    *,
    salts: int = 64,
    min_hot_rows: int = TASK_ROWS,
    force: bool = False,
    left_keys: DataFrame | None = None,
    right_keys: DataFrame | None = None,
    right_unique: bool = False,
    right_scan: bool = True,
) -> DataFrame:
    """``left.join(right, key, how)`` for ``how`` in left, inner; exact.

    A row of a key that is hot on its own side takes one salt of that side's
    axis and is repeated along the other axis only if the key is hot there
    too. A key has one salt more than it has ``min_hot_rows``, so the number
    of tasks follows its rows; rows without a key are spread over ``salts``.
    Each matching pair meets in exactly one cell. In a left join, a row
    repeated along the right axis may find some cells empty; those copies are
    dropped, which is safe because a key listed for the right side has at
    least one right row, so a real match remains.

    ``left_keys`` and ``right_keys`` are cheaper tables to look for hot keys
    in, such as the scan a side was derived from; each must hold only keys of
    that side. A key missed there costs balance only, never rows.
    ``right_unique`` says that the right side holds every key once, as after
    a grouping by it, so that there is nothing to look for. ``right_scan``
    is False for a right side that comes out of a shuffle: it is salted by
    the row's content, as positions may change when a task runs again.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    look_left = left if left_keys is None else left_keys
    look_right = right if right_keys is None else right_keys
    if not force and modest(left, right):
        return left.join(right, key, how)

    # At most MAX_HOT_KEYS values each. They are fixed here once, so that both
    # sides, and any task that runs again, agree on them.
    def heavy(df: DataFrame) -> list:
        return [tuple(row) for row in hot_keys(df, key, min_hot_rows).collect()]

    hot_left = heavy(look_left)
    hot_right = [] if right_unique else heavy(look_right)
    if not hot_left and not hot_right:
        return left.join(right, key, how)

    columns = [c for c in left.columns if c != key]
    added = [c for c in right.columns if c not in (key, POSITION)]

    def spread(df: DataFrame, own: list, other: list, own_salt: str, other_salt: str, scan: bool):
        marked = with_position(df) if scan else df.withColumn(POSITION, F.xxhash64(*df.columns))
        marked = marked.join(_salted(own, df, key, min_hot_rows, "_own"), key, "left")
        marked = marked.join(_salted(other, df, key, min_hot_rows, "_other"), key, "left")
        count = F.when(F.col(key).isNull(), salts).otherwise(F.coalesce("_own", F.lit(1)))
        axis = F.sequence(F.lit(0), F.coalesce("_other", F.lit(1)) - 1)
        return marked.withColumn(own_salt, F.pmod(F.col(POSITION), count).cast("int")).withColumn(
            other_salt, F.explode(axis)
        )

    lhs = spread(left, hot_left, hot_right, "_si", "_sj", True).select(key, *columns, "_si", "_sj", "_other")
    rhs = spread(right, hot_right, hot_left, "_sj", "_si", right_scan).select(
        key, *added, "_si", "_sj", F.lit(True).alias("_match")
    )
    joined = lhs.join(rhs, [key, "_si", "_sj"], how)
    if how == "left":
        joined = joined.filter(F.col("_other").isNull() | F.col("_match"))
    return joined.drop("_si", "_sj", "_match", "_other")


def join_dimension(
    fact: DataFrame, dimension: DataFrame, key: str, how: str = "left", **skew
) -> DataFrame:
    """Look ``key`` up in ``dimension``: broadcast if it is small, else skew-safe."""
    if not skew.get("force") and left_to_spark(dimension):
        return fact.join(dimension, key, how)
    if broadcastable(dimension):
        return fact.join(F.broadcast(dimension), key, how)
    return skew_join(fact, dimension, key, how, **skew)
