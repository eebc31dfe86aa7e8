"""Taxi trips.

Input columns: ``pickup, dropoff`` timestamps, ``zone, passenger_count,
trip_distance, total_amount``. Distances and amounts are summed as they are.
Every report is one scan with column pruning and one aggregation, or a top-k
kept per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowcast.functions.exact import amount, mean, rounded_mean, rounded_ratio, sum_units, units

TRIP = ["pickup", "dropoff", "passenger_count", "trip_distance", "total_amount"]


def _money() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("trips"),
        F.count(units("total_amount")).alias("amounts"),
        sum_units(units("total_amount")).alias("units"),
    ]


def totals(trips: DataFrame) -> DataFrame:
    """Trip count, average and summed amount."""
    return trips.agg(*_money()).select(
        F.col("trips").alias("total_trips"),
        mean(F.col("units"), F.col("amounts")).alias("avg_total_amount"),
        amount("units").alias("total_revenue"),
    )


def top_zones(trips: DataFrame, count: int = 10) -> DataFrame:
    """Pickup zones by revenue."""
    return (
        trips.groupBy("zone")
        .agg(*_money())
        .orderBy(F.desc("units"), "zone")
        .limit(count)
        .select("zone", "trips", amount("units").alias("revenue"))
    )


def daily(trips: DataFrame) -> DataFrame:
    """Trips, average amount and revenue per pickup day."""
    return (
        trips.groupBy(F.to_date("pickup").alias("day"))
        .agg(*_money())
        .select(
            "day",
            "trips",
            rounded_mean(F.col("units"), F.col("amounts")).alias("avg_amount"),
            amount("units").alias("revenue"),
        )
        .orderBy("day")
    )


def hourly(trips: DataFrame) -> DataFrame:
    """Trips and average amount per hour of the day."""
    return (
        trips.groupBy(F.hour("pickup").alias("hour"))
        .agg(*_money())
        .select(
            "hour", "trips", rounded_mean(F.col("units"), F.col("amounts")).alias("avg_amount")
        )
        .orderBy("hour")
    )


def by_passengers(trips: DataFrame) -> DataFrame:
    """Average price and distance per passenger count; unknown counts form a group."""
    return (
        trips.groupBy("passenger_count")
        .agg(
            *_money(),
            sum_units(units("trip_distance")).alias("length"),
            F.count(units("trip_distance")).alias("lengths"),
        )
        .select(
            "passenger_count",
            "trips",
            rounded_mean(F.col("units"), F.col("amounts")).alias("avg_price"),
            rounded_mean(F.col("length"), F.col("lengths")).alias("avg_distance"),
        )
        .orderBy("passenger_count")
    )


def cost_per_km(trips: DataFrame, count: int = 20) -> DataFrame:
    """Trips with the highest price for their distance."""
    price, length = units("total_amount"), units("trip_distance")
    return (
        trips.filter((F.col("trip_distance") > 0) & (F.col("total_amount") > 0))
        .select(*TRIP, rounded_ratio(price, length).alias("cost_per_km"))
        .orderBy(F.desc("cost_per_km"), *TRIP)
        .limit(count)
    )


def is_suspicious() -> Column:
    paid, length = F.col("total_amount"), F.col("trip_distance")
    return (paid > 200) | ((paid > 100) & (length < 2))


def suspicious(trips: DataFrame, count: int = 20) -> DataFrame:
    """Dearest trips that are very dear, or dear and short."""
    return (
        trips.filter(is_suspicious())
        .select(*TRIP)
        .orderBy(F.desc("total_amount"), *TRIP[:-1])
        .limit(count)
    )


def from_yellow_taxi(table: DataFrame) -> DataFrame:
    """City taxi records under the column names used here."""
    return table.select(
        F.col("tpep_pickup_datetime").alias("pickup"),
        F.col("tpep_dropoff_datetime").alias("dropoff"),
        F.col("PULocationID").alias("zone"),
        "passenger_count",
        "trip_distance",
        "total_amount",
    )
