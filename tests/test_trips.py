from __future__ import annotations

import datetime

from rowcast.operators import trips

COLUMNS = (
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID bigint, "
    "passenger_count bigint, trip_distance double, total_amount double"
)


def at(day, hour):
    return datetime.datetime(2022, 1, day, hour)


def taxi(spark):
    rows = [
        (at(1, 5), at(1, 6), 10, 1, 2.0, 10.0),
        (at(1, 5), at(1, 6), 10, None, 0.0, 15.01),
        (at(2, 7), at(2, 8), 20, 1, 1.5, 120.0),
        (at(2, 7), at(2, 8), 20, 2, 30.0, 250.0),
        (at(2, 8), at(2, 9), 20, 2, 30.0, -5.0),
    ]
    return trips.from_yellow_taxi(spark.createDataFrame(rows, COLUMNS))


def test_totals_zones_days_hours(spark):
    table = taxi(spark)
    assert tuple(trips.totals(table).first()) == (5, 390.01 / 5, 390.01)
    assert [tuple(r) for r in trips.top_zones(table).collect()] == [(20, 3, 365.0), (10, 2, 25.01)]
    # 25.01 / 2 = 12.505 is a tie and rounds up.
    assert [tuple(r) for r in trips.daily(table).collect()] == [
        (datetime.date(2022, 1, 1), 2, 12.51, 25.01),
        (datetime.date(2022, 1, 2), 3, 121.67, 365.0),
    ]
    assert [tuple(r) for r in trips.hourly(table).collect()] == [
        (5, 2, 12.51), (7, 2, 185.0), (8, 1, -5.0),
    ]


def test_unknown_passenger_counts_form_a_group(spark):
    assert [tuple(r) for r in trips.by_passengers(taxi(spark)).collect()] == [
        (None, 1, 15.01, 0.0), (1, 2, 65.0, 1.75), (2, 2, 122.5, 30.0),
    ]


def test_cost_per_km_and_suspicious(spark):
    rows = trips.cost_per_km(taxi(spark)).collect()
    assert [r.cost_per_km for r in rows] == [80.0, 8.33, 5.0]
    assert [r.total_amount for r in trips.suspicious(taxi(spark)).collect()] == [250.0, 120.0]


def test_filters_reach_the_scan(spark, tmp_path):
    taxi(spark).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = trips.cost_per_km(stored)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(trip_distance,0.0)" in plan and "TakeOrderedAndProject" in plan
    narrow = trips.top_zones(stored)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<zone:bigint,total_amount:double>" in narrow
