"""Counters over ``events`` replayed as a stream, in all three output modes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.plans.scratch import scratch_path
from rowcast.streaming import counters, deliveries, runners
from rowcast.workloads.tables import table

WINDOW = "1 hour"
# Even slices of time, each a delivery; some rows come one or two slices late.
SLICES = 10
DELAY = "CASE WHEN event_id % 13 = 0 THEN 2 WHEN event_id % 11 = 0 THEN 1 ELSE 0 END"


def event_stream(spark: SparkSession, folder: str, **source) -> DataFrame:
    schema = table(spark, folder, "events").select("event_id", "ts").schema
    path = f"{folder.rstrip('/')}/events.parquet"
    events = counters.table_stream(spark, path, schema, **source)
    return counters.flagged(
        events.select(counters.instant("ts").alias("timestamp"), F.col("event_id").alias("value"))
    )


def _counted(stream: DataFrame, **options) -> DataFrame:
    return counters.flat_window(counters.two_counters(stream, WINDOW, **options))


# Part files of a table are in no order of time. Over several batches a
# watermark would drop what comes late, so these two keep every window.
def stream_two_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Update mode: changed windows per batch, of which the latest count."""
    counted = _counted(event_stream(spark, folder), lateness=None)
    updates = runners.replay(spark, counted, "update", "counters-update")
    return runners.latest(updates, "window_start").orderBy("window_start")


def stream_all_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Complete mode, in which the stream itself may be sorted."""
    ordered = _counted(event_stream(spark, folder), lateness=None).orderBy("window_start")
    return runners.last_batch(runners.replay(spark, ordered, "complete", "counters-complete"))


def stream_closed_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Append mode: only windows that the watermark has passed, all files in one batch."""
    counted = _counted(event_stream(spark, folder, files_per_batch=None))
    return runners.replay_closed(spark, counted, "counters-append")


def _delivered(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a time, and the delivery they come with."""
    events = table(spark, folder, "events").select("event_id", "ts").filter("ts IS NOT NULL")
    timed = events.select(counters.instant("ts").alias("timestamp"), F.col("event_id").alias("value"))
    low, high = timed.agg(F.min(F.unix_micros("timestamp")), F.max(F.unix_micros("timestamp"))).first()
    place = deliveries.time_slice("timestamp", F.lit(low).cast("long"), F.lit(high).cast("long"), SLICES)
    return timed.withColumn("delivery", place + F.expr(DELAY.replace("event_id", "value")))


def _late_windows(spark: SparkSession, folder: str, progress: list | None = None) -> DataFrame:
    arrived = _delivered(spark, folder)
    path = scratch_path(spark, "deliveries")
    files = deliveries.write_deliveries(arrived, path, "delivery")
    if not files:
        return _counted(counters.flagged(arrived)).withColumn("batch_id", F.lit(0).cast("long"))
    stream = counters.table_stream(spark, path, arrived.drop("delivery").schema, files_per_batch=files)
    return deliveries.replay_deliveries(spark, _counted(counters.flagged(stream)), "counters-late", progress)


def stream_late_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Update mode with a watermark over a dozen batches: windows without the rows that came too late."""
    return runners.latest(_late_windows(spark, folder), "window_start").orderBy("window_start")


def stream_late_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows the same replay took and dropped, in how many batches."""
    progress: list = []
    updates = _late_windows(spark, folder, progress)
    counted = runners.latest(updates, "window_start").agg(F.coalesce(F.sum("total_count"), F.lit(0)).alias("counted_rows"))
    # A batch of late rows alone changes no window, so batches are counted by their own reports.
    batches = sum(1 for report in progress if report["numInputRows"] > 0)
    given = table(spark, folder, "events").agg(F.count("ts").alias("input_rows"))
    known = given.select("input_rows", counted.scalar().alias("counted_rows"), F.lit(batches).cast("long").alias("batches"))
    return known.withColumn("dropped_rows", F.col("input_rows") - F.col("counted_rows"))


QUERIES = {
    "stream_late_windows": stream_late_windows,
    "stream_late_counts": stream_late_counts,
    "stream_two_counters": stream_two_counters,
    "stream_all_windows": stream_all_windows,
    "stream_closed_windows": stream_closed_windows,
}

_WINDOWS = """
WITH amounts AS (
    SELECT ts, TIME_BUCKET(INTERVAL 1 HOUR, ts) AS window_start, event_id % 100 + 1 AS amount
    FROM {source}
), windows AS (
    SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end,
           COUNT(*) FILTER (WHERE amount > 50) AS count_big,
           COUNT(*) FILTER (WHERE amount <= 50) AS count_small,
           CAST(COALESCE(SUM(amount) FILTER (WHERE amount > 50), 0) AS BIGINT) AS sum_big,
           CAST(COALESCE(SUM(amount) FILTER (WHERE amount <= 50), 0) AS BIGINT) AS sum_small,
           COUNT(*) AS total_count
    FROM amounts GROUP BY window_start
), rated AS (
    SELECT *, ROUND(CAST(count_big AS DOUBLE) / total_count * 100.0, 2) AS big_ratio_pct
    FROM windows
)
"""

# A batch drops what lies in windows that ended by the watermark of the batch before it.
_LATE = f"""
WITH bounds AS (
    SELECT MIN(EPOCH_US(ts)) AS low, MAX(EPOCH_US(ts)) AS high FROM events
), delivered AS (
    SELECT event_id, ts, (EPOCH_US(ts) - low) * {SLICES} // (high - low + 1) + {DELAY} AS delivery
    FROM events, bounds WHERE ts IS NOT NULL
), marks AS (
    SELECT delivery,
           MAX(MAX(EPOCH_MS(ts))) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - 30000 AS mark
    FROM delivered GROUP BY delivery
), kept AS (
    SELECT event_id, ts FROM delivered JOIN marks USING (delivery)
    WHERE mark IS NULL OR EPOCH_MS(TIME_BUCKET(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR) > mark
)"""
_KEPT = _LATE + _WINDOWS.replace("{source}", "kept").replace("WITH amounts", ", amounts")
_WINDOWS = _WINDOWS.replace("{source}", "events")

ORACLE = {
    "stream_late_windows": _KEPT + "SELECT * FROM rated ORDER BY window_start",
    "stream_late_counts": _LATE
    + """SELECT (SELECT COUNT(ts) FROM events) AS input_rows, COUNT(*) AS counted_rows,
    (SELECT COUNT(ts) FROM events) - COUNT(*) AS dropped_rows, (SELECT COUNT(*) FROM marks) AS batches FROM kept""",
    "stream_two_counters": _WINDOWS + "SELECT * FROM rated ORDER BY window_start",
    "stream_all_windows": _WINDOWS + "SELECT * FROM rated ORDER BY window_start",
    "stream_closed_windows": _WINDOWS
    + """SELECT * FROM rated
    WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 30 SECOND""",
}
