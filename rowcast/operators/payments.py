"""Orders, customers and payments joined from three sources.

Inputs
    orders     ``order_id, customer_id, order_amount``
    customers  ``customer_id, first_name, last_name, city``, one row per id
    payments   ``order_id, paid_ratio``

Amounts are summed as they are, to the millionth. An order without payment counts as unpaid, an
order without customer keeps its row with empty customer columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.functions.exact import amount, half_up, sum_units, units
from rowcast.plans.joins import join_dimension, skew_join, with_position
from rowcast.sources import files

MEASURES = ("order", "paid", "unpaid")


def read_sources(
    spark: SparkSession, customers_csv: str, orders_parquet: str, payments_json: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders, customers and payments from their three file formats."""
    return (
        files.read_parquet(spark, orders_parquet),
        files.read_csv(
            spark,
            customers_csv,
            "customer_id int, first_name string, last_name string, city string",
        ),
        files.read_json(spark, payments_json, "order_id bigint, paid_ratio double"),
    )


def payment_status(ratio: Column) -> Column:
    return (
        F.when(ratio == 0.0, "UNPAID").when(ratio == 1.0, "FULLY_PAID").otherwise("PARTIALLY_PAID")
    )


def settle(orders: DataFrame, payments: DataFrame, **skew) -> DataFrame:
    """Orders with their payment: units ordered, paid and unpaid, and a status.

    Either side may hold one ``order_id`` many times; every pair is kept.
    """
    paid = skew_join(orders, payments, "order_id", "left", **skew)
    return (
        paid.withColumns(
            {
                "paid_ratio": F.coalesce("paid_ratio", F.lit(0.0)),
                "order_units": units("order_amount"),
            }
        )
        .withColumn("paid_units", half_up(F.col("order_units") * F.col("paid_ratio")))
        .withColumns(
            {
                "unpaid_units": F.col("order_units") - F.col("paid_units"),
                "payment_status": payment_status(F.col("paid_ratio")),
            }
        )
    )


def joined(orders: DataFrame, customers: DataFrame, payments: DataFrame, **skew) -> DataFrame:
    """One row per order and payment, with customer columns and amounts."""
    placed = with_position(orders)
    known = join_dimension(placed, customers, "customer_id", "left", left_keys=orders, **skew)
    return settle(known, payments, left_keys=orders, **skew).select(
        "order_id",
        "customer_id",
        "first_name",
        "last_name",
        "city",
        amount("order_units").alias("order_amount"),
        "paid_ratio",
        amount("paid_units").alias("paid_amount"),
        amount("unpaid_units").alias("unpaid_amount"),
        "payment_status",
    )


def _sums() -> list[Column]:
    return [sum_units(f"{name}_units").alias(f"{name}_units") for name in MEASURES]


def _sums_of_sums() -> list[Column]:
    return [F.sum(f"{name}_units").alias(f"{name}_units") for name in MEASURES]


def _totals() -> list[Column]:
    return [amount(f"{name}_units").alias(f"total_{name}_amount") for name in MEASURES]


def totals(orders: DataFrame, payments: DataFrame, **skew) -> DataFrame:
    """Order count and the three sums, in one pass and one row."""
    summed = settle(orders, payments, **skew).agg(F.count(F.lit(1)).alias("orders_count"), *_sums())
    return summed.select("orders_count", *_totals())


def by_status(orders: DataFrame, payments: DataFrame, **skew) -> DataFrame:
    """Order count and sums per payment status, ordered by status."""
    return (
        settle(orders, payments, **skew)
        .groupBy("payment_status")
        .agg(F.count(F.lit(1)).alias("orders_count"), *_sums())
        .select("payment_status", "orders_count", *_totals())
        .orderBy("payment_status")
    )


def _per_customer(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, **skew
) -> DataFrame:
    """Sums per customer id, taken before the customer columns are looked up.

    The sums are combined within each task first, so a customer holding much
    of the orders is one row per task by the time rows move, and the lookup
    joins one row per customer instead of one per order.
    """
    spent = (
        settle(orders, payments, **skew)
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("orders_count"), *_sums())
    )
    return spent.join(customers, "customer_id", "left")


def top_customers(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, count: int = 10, **skew
) -> DataFrame:
    """Customers with the largest unpaid sum."""
    who = ["customer_id", "first_name", "last_name", "city"]
    return (
        _per_customer(orders, customers, payments, **skew)
        .groupBy(*who)
        .agg(*_sums_of_sums())
        .orderBy(F.desc("unpaid_units"), *who)
        .limit(count)
        .select(*who, *_totals())
    )


def top_cities(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, count: int = 10, **skew
) -> DataFrame:
    """Cities with the largest ordered sum."""
    return (
        _per_customer(orders, customers, payments, **skew)
        .groupBy("city")
        .agg(*_sums_of_sums(), F.sum("orders_count").alias("orders_count"))
        .orderBy(F.desc("order_units"), "city")
        .limit(count)
        .select("city", *_totals(), "orders_count")
    )
