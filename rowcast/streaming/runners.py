"""Starting streams and replaying them into tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from rowcast.plans.scratch import scratch_path


def start_console(counters: DataFrame, mode: str = "update", rows: int = 50) -> StreamingQuery:
    """Print every batch. A sorted stream needs ``complete`` mode."""
    return (
        counters.writeStream.outputMode(mode)
        .format("console")
        .option("truncate", False)
        .option("numRows", rows)
        .start()
    )


def run_until_stopped(query: StreamingQuery, seconds: int | None = None) -> None:
    """Wait for the stream to end, or stop it after ``seconds``."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()


def replay(
    spark: SparkSession,
    counters: DataFrame,
    mode: str = "update",
    name: str = "replay",
    progress: list | None = None,
) -> DataFrame:
    """Run a stream over everything available and return its output table.

    Batches are written by the executors to a folder per batch, so a batch
    that runs again replaces what it wrote before; nothing is gathered on the
    driver. Rows carry ``batch_id``. ``progress`` takes the stream's reports,
    one of every batch it still remembers.
    """
    target = scratch_path(spark, name)

    started = [False]

    def store(batch: DataFrame, batch_id: int) -> None:
        started[0] = True
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    query = (
        counters.writeStream.outputMode(mode)
        .option("checkpointLocation", scratch_path(spark, f"{name}-state"))
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if progress is not None:
        progress.extend(query.recentProgress)
    schema = StructType([*counters.schema.fields, StructField("batch_id", LongType())])
    # A stream that had nothing to read ran no batch.
    if not started[0]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(target)


def replay_closed(spark: SparkSession, counters: DataFrame, name: str = "closed") -> DataFrame:
    """Append mode into a parquet folder whose log lists only committed files."""
    target = scratch_path(spark, name)
    query = (
        counters.writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", scratch_path(spark, f"{name}-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(counters.schema).parquet(target)


def latest(updates: DataFrame, key: str) -> DataFrame:
    """The last update of every key of an ``update`` mode output."""
    values = [c for c in updates.columns if c not in (key, "batch_id")]
    return (
        updates.groupBy(key)
        .agg(F.max_by(F.struct(*values), "batch_id").alias("last"))
        .select(key, *[F.col(f"last.{name}").alias(name) for name in values])
    )


def last_batch(results: DataFrame) -> DataFrame:
    """The final result table of a ``complete`` mode output."""
    newest = results.agg(F.max("batch_id").alias("b")).scalar()
    return results.filter(F.col("batch_id") == newest).drop("batch_id")
