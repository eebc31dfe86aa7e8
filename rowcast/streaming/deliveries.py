"""Replaying a table in the order it would have arrived, one delivery a micro-batch.

A watermark only means something over several batches, and a table's files are
in no order of time. Here every row is given the number of the delivery it
comes with; deliveries are written one after the other, so that a file stream
that takes as many files a batch as a delivery has reads them in that order.

Which rows are late follows from Spark's rules alone. The watermark of a batch
is the latest event time of all batches before it, less the tolerance, in whole
milliseconds. A batch drops rows whose window ended by the watermark of the
batch before it, and evicts windows that ended by its own, so a dropped row is
one whose window was evicted already.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowcast.plans.scratch import _files, scratch_path
from rowcast.plans.sizing import input_bytes
from rowcast.streaming.runners import replay

FILE_BYTES = 128 << 20
FILE_ROWS = 1000


def time_slice(moment: str, low: Column, high: Column, slices: int) -> Column:
    """Number of the even slice of time between ``low`` and ``high`` (microseconds) that a row falls in."""
    place = F.unix_micros(moment) - low
    return F.call_function("div", place * F.lit(slices), high - low + 1).cast("int")


def _modified(spark: SparkSession, path: str) -> list[int]:
    folder, files = _files(spark, path)
    return [one.getModificationTime() for one in files.listStatus(folder) if one.getPath().getName().startswith("part-")]


def write_deliveries(df: DataFrame, path: str, delivery: str, files: int | None = None) -> int:
    """Write ``df`` without ``delivery`` to one folder, a delivery after the other; returns the files of each, 0 for no rows.

    The table is parted by delivery in one pass, then each part is written when
    its turn comes. A part has the same number of files, by the bytes of the
    input, so that a batch is one delivery. Deliveries without rows do not occur.
    """
    spark = df.sparkSession
    parted = scratch_path(spark, "parted")
    df.write.partitionBy(delivery).parquet(parted)
    # One row a delivery.
    whole = spark.read.schema(df.schema).parquet(parted)
    counts = {r[0]: r[1] for r in whole.groupBy(delivery).count().collect()}
    if files is None:
        files = max(1, -(-(input_bytes(df) or 0) // (FILE_BYTES * max(1, len(counts)))))
    # A delivery too small for that many files would leave some of them out.
    files = max(1, min([files, *(n // FILE_ROWS for n in counts.values())]))
    kept = [field for field in df.schema.fields if field.name != delivery]
    newest = 0
    for number in sorted(counts):
        part = whole.filter(F.col(delivery) == number).select(*[field.name for field in kept])
        known = set(_modified(spark, path)) if newest else set()
        # A store that keeps whole seconds only must not show two deliveries as equally old.
        while newest and int(time.time() * 1000) // 1000 <= newest // 1000 and newest % 1000 == 0:
            time.sleep(0.05)
        part.repartition(files).write.mode("append").parquet(path)
        newest = max([newest, *(set(_modified(spark, path)) - known)])
    return files if counts else 0


def late_rows(df: DataFrame, moment: str, delivery: str, window_end: Column, lateness_ms: int) -> DataFrame:
    """The rows that a replay drops, told from the whole table by a batch job."""
    latest = df.groupBy(delivery).agg(F.max(F.unix_millis(moment)).alias("latest"))
    order = Window.orderBy(delivery).rowsBetween(Window.unboundedPreceding, -2)
    marks = latest.select(delivery, (F.max("latest").over(order) - lateness_ms).alias("mark"))
    return df.join(F.broadcast(marks), delivery).filter(F.unix_millis(window_end) <= F.col("mark"))


def replay_deliveries(
    spark: SparkSession, counted: DataFrame, name: str = "deliveries", progress: list | None = None
) -> DataFrame:
    """Update mode over a stream of deliveries; ``progress`` takes the batches' own reports."""
    return replay(spark, counted, "update", name, progress=progress)
