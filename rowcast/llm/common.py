"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.plans.scratch import scratch_path
from rowcast.plans.sizing import payload

# A side is broadcast only after its rows and bytes were measured below these; beyond them the join shuffles.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The written table cuts the lineage: a lost executor costs the tasks it
    ran, not the jobs before them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if its counted rows and their measured bytes are few; else leave it."""
    sizes = df.select(payload(df).alias("bytes")).limit(rows + 1)
    seen = sizes.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if seen["rows"] <= rows and seen["bytes"] <= BROADCAST_BYTES else df


def only_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` is among ``ids`` (one column of that name)."""
    return df.join(small_side(ids), column, "left_semi")
