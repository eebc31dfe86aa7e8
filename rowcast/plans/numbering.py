"""Global row numbers and leading slices without one task seeing every row.

Rows should come from a scan, or a row-wise transformation of one: plans here
read them more than once and rely on the same rows in the same places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowcast.plans.joins import POSITION, hot_keys, with_position
from rowcast.plans.sizing import modest

CUT_ERROR = 0.0001
MERGE_BRANCHES = 256


def shuffled_index(
    df: DataFrame,
    key: str,
    seed: int,
    index: str = "row_index",
    *,
    digits: int = 4,
    salts: int = 64,
    min_hot_rows: int = 1_000_000,
    force: bool = False,
) -> DataFrame:
    """Number rows 0, 1, 2, ... in a seeded random order of ``key``.

    The order is that of ``md5(seed:key)``. Its leading hex digits cut the
    rows into ``16 ** digits`` even buckets; bucket sizes are counted first
    and summed up, so each bucket is then numbered on its own. Copies of one
    key share a bucket: on large inputs a key with very many rows gets buckets
    of its own, in its place, one more for each ``min_hot_rows`` it has. Other
    keys have the same number either way.
    """
    if index in df.columns:
        raise ValueError(f"column {index} already exists")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    marked = df.withColumn("_order", order)
    bucket = F.substring("_order", 1, digits)
    hot = []
    if force or not modest(df):
        hot = [tuple(row) for row in hot_keys(df, key, min_hot_rows).collect()]
    if hot:
        # A bucket with hot keys is cut into what lies before, between and after
        # them, and each hot key into salts, so every row keeps its place in the order.
        known = df.sparkSession.createDataFrame(hot, df.select(key, F.lit(0).cast("bigint").alias("hot_rows")).schema)
        ranked = known.withColumn("_order", order)
        listed = ranked.groupBy(bucket.alias("_cell")).agg(F.array_sort(F.collect_list("_order")).alias("_hot"))
        several = ranked.select(F.col("_order").alias("_key_order"), F.ceil(F.col("hot_rows") / min_hot_rows).alias("_salts"))
        marked = with_position(marked).withColumn("_cell", bucket).join(F.broadcast(listed), "_cell", "left")
        marked = marked.join(F.broadcast(several), F.col("_order") == F.col("_key_order"), "left")
        before_it = F.expr("coalesce(size(filter(_hot, x -> x < _order)), 0)")
        piece = before_it * 2 + F.col("_salts").isNotNull().cast("int")
        salt = F.coalesce(F.pmod(F.col(POSITION), F.col("_salts") + salts - 1), F.lit(0))
        spot = F.format_string("%s~%06d~%08d", "_cell", piece, salt)
        marked = marked.withColumn("_bucket", spot).drop(POSITION, "_cell", "_hot", "_key_order", "_salts")
    else:
        marked = marked.withColumn("_bucket", bucket)

    # At most 16 ** digits rows, and salts for each hot key, whatever the table size.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        marked.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("_bucket").orderBy("_order", key)
    # Starts are looked up after numbering, so they do not travel with the rows.
    return (
        marked.withColumn("_place", F.row_number().over(within))
        .join(F.broadcast(starts), "_bucket")
        .withColumn(index, F.col("_start") + F.col("_place") - 1)
        .drop("_bucket", "_order", "_start", "_place")
    )


def leading_rows(df: DataFrame, key: str, count: int, *, force: bool = False) -> DataFrame:
    """A superset of the first ``count`` rows by numeric ``key``, kept small.

    A top-k over very many partitions gathers up to ``count`` rows from each
    of them in one task. On large inputs two steps come first. A quantile
    sketch gives a key certain to lie at or past the wanted rows, and a
    pushed-down filter drops everything above it. Many rows can share that
    key, so groups of partitions then keep their own first ``count`` rows.
    """
    if not force and modest(df):
        return df
    total = df.filter(F.col(key).isNotNull()).count()
    share = count / total + 2 * CUT_ERROR if total else 1.0
    if share < 1.0:
        df = df.filter(F.col(key) <= F.lit(df.approxQuantile(key, [share], CUT_ERROR)[0]))
    branch = F.pmod(F.spark_partition_id(), F.lit(MERGE_BRANCHES))
    rank = F.row_number().over(Window.partitionBy("_branch").orderBy(key))
    ranked = df.withColumn("_branch", branch).withColumn("_rank", rank)
    return ranked.filter(F.col("_rank") <= count).drop("_branch", "_rank")


CONTENT = "_content"


def content(df: DataFrame) -> DataFrame:
    """Add a hash of every column but the position, to order rows of one key by."""
    if CONTENT in df.columns:
        return df
    return df.withColumn(CONTENT, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c != POSITION]))


def leading_cut(df: DataFrame, key: str, count: int, **options) -> tuple | None:
    """Where the first ``count`` rows by (key, content, position) end; None if there are no more than that.

    ``df`` has all three, see ``with_position`` and ``content``. The last key is
    found first; only where more rows share it than are wanted are its contents
    counted, by leading bits and then within one of 65 536 stretches, and only
    where equal rows remain their places, by task and then within one task. So
    nothing sorts a key's rows, however many there are.
    """
    if count <= 0:
        return (None,)
    rows = df.filter(F.col(key).isNotNull())
    known = leading_rows(rows.select(key), key, count, **options).orderBy(key).limit(count)
    last = known.agg(F.max(key).alias("last"), F.count(F.lit(1)).alias("n")).first()
    if last["n"] < count:
        return None
    value = F.lit(last["last"])
    below, same = rows.agg(F.count_if(F.col(key) < value), F.count_if(F.col(key) == value)).first()
    wanted = count - below
    if wanted == same:
        return (last["last"], None, None)
    equal = rows.filter(F.col(key) == value)
    stretch, wanted = _counted_place(equal, F.shiftright(CONTENT, 48), wanted)
    hashed, wanted = _counted_place(equal.filter(F.shiftright(CONTENT, 48) == stretch), F.col(CONTENT), wanted)
    equal = equal.filter(F.col(CONTENT) == hashed)
    # A position is a task's number and a place within it.
    task, wanted = _counted_place(equal, F.shiftright(POSITION, 33), wanted)
    place = F.row_number().over(Window.orderBy(POSITION))
    inside = equal.filter(F.shiftright(POSITION, 33) == task).select(POSITION, place.alias("place"))
    return (last["last"], hashed, inside.filter(F.col("place") == wanted).first()[POSITION])


def _counted_place(df: DataFrame, step: Column, wanted: int) -> tuple[int, int]:
    """The value of ``step`` that the row of rank ``wanted`` has, and its rank among the rows of that value."""
    counts = df.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"))
    upto = counts.select("step", "n", F.sum("n").over(Window.orderBy("step")).alias("upto"))
    row = upto.filter(F.col("upto") >= wanted).orderBy("step").first()
    return row["step"], wanted - (row["upto"] - row["n"])


def within_cut(cut: tuple | None, key: str) -> Column:
    """Whether a row lies before the end that ``leading_cut`` found."""
    if cut is None:
        return F.col(key).isNotNull()
    if len(cut) == 1:
        return F.lit(False)
    value, hashed, position = cut
    if hashed is None:
        return F.col(key) <= F.lit(value)
    first = F.col(CONTENT) < F.lit(hashed).cast("long")
    equal = (F.col(CONTENT) == F.lit(hashed).cast("long")) & (F.col(POSITION) <= F.lit(position).cast("long"))
    return (F.col(key) < F.lit(value)) | ((F.col(key) == F.lit(value)) & (first | equal))


def take_rows(df: DataFrame, key: str, count: int, skip: int = 0, **options) -> DataFrame:
    """Rows ``skip .. skip + count`` in the order of a numeric ``key`` without NULLs."""
    ordered = leading_rows(df, key, skip + count, **options).orderBy(key)
    return (ordered.offset(skip) if skip else ordered).limit(count)
