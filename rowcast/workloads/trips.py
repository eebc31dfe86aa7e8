"""Trip reports over ``events``: every event is a trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.operators import trips
from rowcast.workloads.tables import table


def taxi(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("event_id")
    return table(spark, folder, "events").select(
        F.col("ts").alias("pickup"),
        (F.col("ts") + F.make_dt_interval(mins=(key % 60).cast("int"))).alias("dropoff"),
        F.col("user_id").alias("zone"),
        F.when(key % 11 != 0, key % 7).alias("passenger_count"),
        ((key % 40) / 4.0).alias("trip_distance"),
        F.col("value").alias("total_amount"),
    )


def trips_totals(spark: SparkSession, folder: str) -> DataFrame:
    return trips.totals(taxi(spark, folder))


def trips_top_zones(spark: SparkSession, folder: str) -> DataFrame:
    return trips.top_zones(taxi(spark, folder))


def trips_daily(spark: SparkSession, folder: str) -> DataFrame:
    return trips.daily(taxi(spark, folder)).withColumn("day", F.col("day").cast("string"))


def trips_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return trips.hourly(taxi(spark, folder))


def trips_by_passengers(spark: SparkSession, folder: str) -> DataFrame:
    return trips.by_passengers(taxi(spark, folder))


def trips_cost_per_km(spark: SparkSession, folder: str) -> DataFrame:
    return trips.cost_per_km(taxi(spark, folder))


def trips_suspicious(spark: SparkSession, folder: str) -> DataFrame:
    return trips.suspicious(taxi(spark, folder))


QUERIES = {
    "trips_totals": trips_totals,
    "trips_top_zones": trips_top_zones,
    "trips_daily": trips_daily,
    "trips_hourly": trips_hourly,
    "trips_by_passengers": trips_by_passengers,
    "trips_cost_per_km": trips_cost_per_km,
    "trips_suspicious": trips_suspicious,
}

_TAXI = """
WITH taxi AS (
    SELECT ts AS pickup, ts + INTERVAL 1 MINUTE * (event_id % 60) AS dropoff, user_id AS zone,
           CASE WHEN event_id % 11 <> 0 THEN event_id % 7 END AS passenger_count,
           CAST(event_id % 40 AS DOUBLE) / 4.0 AS trip_distance, value AS total_amount,
           CAST(value AS DECIMAL(18, 2)) AS price,
           CAST(ROUND(value * 100) AS BIGINT) AS cents, event_id % 40 * 25 AS hundredths
    FROM events
)
"""


def _half_up(total: str, count: str) -> str:
    return f"CAST((2 * ({total}) + ({count})) // (2 * ({count})) AS DOUBLE) / 100.0"


_AVERAGE = _half_up("SUM(cents)", "COUNT(cents)")
_TRIP = "pickup, dropoff, passenger_count, trip_distance, total_amount"

ORACLE = {
    "trips_totals": _TAXI
    + """SELECT COUNT(*) AS total_trips,
    CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_total_amount,
    CAST(SUM(price) AS DOUBLE) AS total_revenue FROM taxi""",
    "trips_top_zones": _TAXI
    + """SELECT zone, COUNT(*) AS trips, CAST(SUM(price) AS DOUBLE) AS revenue FROM taxi
    GROUP BY zone ORDER BY revenue DESC, zone LIMIT 10""",
    "trips_daily": _TAXI
    + f"""SELECT CAST(CAST(pickup AS DATE) AS VARCHAR) AS day, COUNT(*) AS trips,
    {_AVERAGE} AS avg_amount, CAST(SUM(price) AS DOUBLE) AS revenue FROM taxi
    GROUP BY CAST(pickup AS DATE) ORDER BY day""",
    "trips_hourly": _TAXI
    + f"""SELECT CAST(HOUR(pickup) AS INTEGER) AS hour, COUNT(*) AS trips,
    {_AVERAGE} AS avg_amount FROM taxi GROUP BY HOUR(pickup) ORDER BY hour""",
    "trips_by_passengers": _TAXI
    + f"""SELECT passenger_count, COUNT(*) AS trips, {_AVERAGE} AS avg_price,
    {_half_up("SUM(hundredths)", "COUNT(hundredths)")} AS avg_distance FROM taxi
    GROUP BY passenger_count ORDER BY passenger_count""",
    "trips_cost_per_km": _TAXI
    + f"""SELECT {_TRIP}, {_half_up("cents * 100", "hundredths")} AS cost_per_km FROM taxi
    WHERE trip_distance > 0 AND total_amount > 0
    ORDER BY cost_per_km DESC, pickup, dropoff LIMIT 20""",
    "trips_suspicious": _TAXI
    + f"""SELECT {_TRIP} FROM taxi
    WHERE total_amount > 200 OR (total_amount > 100 AND trip_distance < 2)
    ORDER BY total_amount DESC, pickup, dropoff LIMIT 20""",
}
