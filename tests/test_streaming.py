from __future__ import annotations

import datetime
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowcast.streaming import counters, deliveries, runners

SCHEMA = "timestamp timestamp, value bigint"


def events(spark, count, step_seconds=1):
    return spark.range(count).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * step_seconds).alias("timestamp"),
        F.col("id").alias("value"),
    )


def stored(spark, tmp_path, parts):
    """One file per part, in order."""
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def batch_result(table, window="10 seconds"):
    return counters.flat_window(
        counters.two_counters(counters.flagged(table), window, lateness=None)
    )


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_counts_and_shares(spark):
    table = batch_result(events(spark, 200)).orderBy("window_start").collect()
    assert sum(r.total_count for r in table) == 200
    assert all(r.count_big + r.count_small == r.total_count for r in table)
    assert sum(r.sum_big + r.sum_small for r in table) == 2 * sum(range(1, 101))
    first = table[0]
    assert (first.count_big, first.big_ratio_pct) == (0, 0.0)
    assert first.window_end - first.window_start == datetime.timedelta(seconds=10)


def test_update_replay_over_several_batches_equals_batch(spark, tmp_path):
    table = events(spark, 300)
    parts = [table.filter(f"value >= {a} AND value < {a + 75}") for a in (0, 75, 150, 225)]
    folder = stored(spark, tmp_path, parts)
    stream = counters.table_stream(spark, folder, table.schema, files_per_batch=1)
    counted = counters.flat_window(counters.two_counters(counters.flagged(stream)))
    updates = runners.replay(spark, counted, "update", "t-update")
    assert updates.select("batch_id").distinct().count() == 4
    columns = batch_result(table).columns
    assert rows(runners.latest(updates, "window_start").select(columns)) == rows(batch_result(table))


def test_complete_replay_may_be_sorted(spark, tmp_path):
    table = events(spark, 120)
    folder = stored(spark, tmp_path, [table])
    stream = counters.table_stream(spark, folder, table.schema)
    counted = counters.flat_window(counters.two_counters(counters.flagged(stream)))
    result = runners.last_batch(runners.replay(spark, counted.orderBy("window_start"), "complete", "t"))
    assert rows(result) == rows(batch_result(table))


def test_append_replay_holds_open_windows_back(spark, tmp_path):
    table = events(spark, 120)
    folder = stored(spark, tmp_path, [table])
    stream = counters.table_stream(spark, folder, table.schema)
    counted = counters.flat_window(counters.two_counters(counters.flagged(stream)))
    closed = runners.replay_closed(spark, counted)
    full = batch_result(table)
    assert not rows(closed) - rows(full)
    last = table.agg(F.max("timestamp").cast("timestamp_ntz")).first()[0]
    limit = last - datetime.timedelta(seconds=30)
    assert closed.count() == full.filter(F.col("window_end") <= F.lit(limit)).count()


def test_late_rows_are_dropped(spark, tmp_path):
    """A watermark drops rows one batch after the batch that moved it."""
    table = events(spark, 200)
    late = spark.range(1).select(
        F.timestamp_seconds(F.lit(1_700_000_000)).alias("timestamp"),
        F.lit(99).cast("bigint").alias("value"),
    )
    parts = [table.filter("value < 100"), table.filter("value >= 100"), late]
    folder = stored(spark, tmp_path, parts)
    stream = counters.table_stream(spark, folder, table.schema, files_per_batch=1)
    counted = counters.flat_window(counters.two_counters(counters.flagged(stream)))
    updates = runners.latest(runners.replay(spark, counted, "update", "t-late"), "window_start")
    assert updates.agg(F.sum("total_count")).first()[0] == 200


def test_part_files_single_file_and_nothing(spark, tmp_path):
    table = events(spark, 90)
    folder = stored(spark, tmp_path, [table.filter("value < 30"), table.filter("value >= 30")])
    single = str(next((tmp_path / "in").glob("*.parquet")))
    for path, count in ((folder, 90), (single, spark.read.parquet(single).count())):
        stream = counters.table_stream(spark, path, table.schema)
        counted = counters.two_counters(counters.flagged(stream), lateness=None)
        updates = runners.latest(runners.replay(spark, counters.flat_window(counted)), "window_start")
        assert updates.agg(F.sum("total_count")).first()[0] == count
    with pytest.raises(FileNotFoundError):
        counters.table_stream(spark, str(tmp_path / "absent"), table.schema)
    (tmp_path / "none").mkdir()
    stream = counters.table_stream(spark, str(tmp_path / "none"), table.schema)
    empty = runners.replay(spark, counters.flat_window(counters.two_counters(counters.flagged(stream))))
    assert empty.count() == 0 and "batch_id" in empty.columns


def test_windows_do_not_depend_on_the_session_zone(spark):
    times = ["2021-03-14 02:30:00", "2021-07-01 12:00:00.000001", "1969-12-31 23:59:59.5", "2040-01-01 00:00:00"]
    table = spark.createDataFrame([(t, i) for i, t in enumerate(times)], "ts string, value bigint")
    seen = []
    for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            moments = table.select(F.col("ts").cast("timestamp_ntz").alias("ts"), "value")
            frame = moments.select(counters.instant("ts").alias("timestamp"), "value")
            seen.append(rows(batch_result(frame, "1 hour")))
            back = frame.select(counters.local_time("timestamp").cast("string").alias("ts")).collect()
            assert [r.ts for r in back] == times
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seen[0] == seen[1] == seen[2]


def test_rate_source_to_console(spark, capfd):
    stream = counters.flagged(counters.rate_stream(spark, 10))
    assert stream.isStreaming
    query = runners.start_console(counters.two_counters(stream))
    runners.run_until_stopped(query, 6)
    assert not query.isActive and query.exception() is None


def test_deliveries_drop_late_rows_and_evict_windows(spark, tmp_path):
    table = events(spark, 1200).withColumn("delivery", F.expr("int(value div 100) + CASE WHEN value % 17 = 0 THEN 3 WHEN value % 5 = 0 THEN 1 ELSE 0 END"))
    path = str(tmp_path / "deliveries")
    assert deliveries.write_deliveries(table, path, "delivery") == 1
    stream = counters.table_stream(spark, path, events(spark, 1).schema, files_per_batch=1)
    counted = counters.flat_window(counters.two_counters(counters.flagged(stream)))
    progress = []
    updates = deliveries.replay_deliveries(spark, counted, "t-late", progress)
    got = runners.latest(updates, "window_start")
    ends = F.window("timestamp", "10 seconds")["end"]
    late = deliveries.late_rows(table, "timestamp", "delivery", ends, 30_000)
    dropped = {r.value for r in late.collect()}
    assert {v for v in range(1200) if v % 17 == 0 and v < 1000} - dropped == {v for v in range(100) if v % 17 == 0 and v >= 100}
    kept = events(spark, 1200).filter(~F.col("value").isin(*dropped))
    assert rows(got.select(batch_result(kept).columns)) == rows(batch_result(kept))
    assert 10 < updates.select("batch_id").distinct().count() <= len(progress)
    states = [p["stateOperators"][0] for p in progress if p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in states) > 0
    # Windows leave the state as they close: it never holds them all.
    assert max(s["numRowsTotal"] for s in states) < batch_result(events(spark, 1200)).count() / 2


def test_no_deliveries(spark, tmp_path):
    none = events(spark, 0).withColumn("delivery", F.lit(1))
    assert deliveries.write_deliveries(none, str(tmp_path / "d"), "delivery") == 0


def test_deliveries_of_several_files_stay_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(deliveries, "FILE_ROWS", 100)
    table = events(spark, 3000).withColumn("delivery", F.expr("int(value div 1000)"))
    path = str(tmp_path / "d")
    assert deliveries.write_deliveries(table, path, "delivery", files=3) == 3
    stream = counters.table_stream(spark, path, events(spark, 1).schema, files_per_batch=3)
    counted = counters.flat_window(counters.two_counters(counters.flagged(stream)))
    updates = deliveries.replay_deliveries(spark, counted, "t-files")
    sums = updates.groupBy("batch_id").agg(F.min("window_start").alias("at")).orderBy("batch_id").collect()
    assert len(sums) == 3 and [r.at for r in sums] == sorted(r.at for r in sums)
