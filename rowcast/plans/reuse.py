"""Reading an expensive input once for several consumers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from rowcast.plans.scratch import release, scratch_path


@contextmanager
def reused(df: DataFrame, name: str = "reused") -> Iterator[DataFrame]:
    """``df`` written once; every consumer inside the block reads the written table, which goes at its end.

    Unlike a cache it survives lost executors and needs no memory. What leaves
    the block must not read it any more, see ``settled``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        release(spark, path)


def settled(df: DataFrame, name: str = "result") -> DataFrame:
    """A result that stands on its own: written now, read when it is asked for."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
