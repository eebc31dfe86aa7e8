"""Payment reports over ``orders`` and ``customer``.

A few customer and payment keys are negated, so that unmatched rows occur on
both lookups while every row of both tables takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.operators import payments
from rowcast.plans.scratch import scratch_path
from rowcast.sources import files
from rowcast.workloads.tables import table


def sources(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders, customers and payments in the shape of ``operators.payments``."""
    placed = table(spark, folder, "orders")
    orders = placed.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("order_amount"),
    )
    customers = table(spark, folder, "customer").select(
        F.when(F.col("c_custkey") % 37 == 5, -F.col("c_custkey"))
        .otherwise(F.col("c_custkey"))
        .alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.concat(F.lit("city "), F.col("c_nationkey").cast("string")).alias("city"),
    )
    key = F.col("o_orderkey")
    paid = placed.select(
        F.when(key % 50 == 7, -key).otherwise(key).alias("order_id"),
        F.when(key % 10 == 0, 0.0).when(key % 10 == 1, 0.5).otherwise(1.0).alias("paid_ratio"),
    )
    return orders, customers, paid


def payments_joined(spark: SparkSession, folder: str) -> DataFrame:
    return payments.joined(*sources(spark, folder))


def payments_totals(spark: SparkSession, folder: str) -> DataFrame:
    orders, _, paid = sources(spark, folder)
    return payments.totals(orders, paid)


def payments_by_status(spark: SparkSession, folder: str) -> DataFrame:
    orders, _, paid = sources(spark, folder)
    return payments.by_status(orders, paid)


def payments_top_customers(spark: SparkSession, folder: str) -> DataFrame:
    return payments.top_customers(*sources(spark, folder))


def payments_top_cities(spark: SparkSession, folder: str) -> DataFrame:
    return payments.top_cities(*sources(spark, folder))


def payments_three_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Customers through CSV, orders through Parquet, payments through JSON, then the totals."""
    orders, customers, paid = sources(spark, folder)
    paths = [scratch_path(spark, name) for name in ("customers", "orders", "payments")]
    files.write_csv(customers, paths[0])
    files.write_parquet(orders, paths[1])
    files.write_json(paid, paths[2])
    return payments.top_cities(*payments.read_sources(spark, *paths))


QUERIES = {
    "payments_joined": payments_joined,
    "payments_totals": payments_totals,
    "payments_by_status": payments_by_status,
    "payments_top_customers": payments_top_customers,
    "payments_top_cities": payments_top_cities,
    "payments_three_sources": payments_three_sources,
}

_FULL = """
WITH customers AS (
    SELECT CASE WHEN c_custkey % 37 = 5 THEN -c_custkey ELSE c_custkey END AS customer_id,
           c_name AS first_name, c_mktsegment AS last_name,
           'city ' || c_nationkey AS city
    FROM customer
), paid AS (
    SELECT CASE WHEN o_orderkey % 50 = 7 THEN -o_orderkey ELSE o_orderkey END AS order_id,
           CASE o_orderkey % 10 WHEN 0 THEN 0.0 WHEN 1 THEN 0.5 ELSE 1.0 END AS paid_ratio
    FROM orders
), full_rows AS (
    SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
           c.first_name, c.last_name, c.city,
           CAST(o.o_totalprice AS DECIMAL(18, 2)) AS order_amount,
           CAST(COALESCE(p.paid_ratio, 0.0) AS DECIMAL(3, 1)) AS paid_ratio,
           CAST(o.o_totalprice AS DECIMAL(18, 2))
               * CAST(COALESCE(p.paid_ratio, 0.0) AS DECIMAL(3, 1)) AS paid_amount
    FROM orders o
    LEFT JOIN customers c ON o.o_custkey = c.customer_id
    LEFT JOIN paid p ON o.o_orderkey = p.order_id
), full_df AS (
    SELECT *, order_amount - paid_amount AS unpaid_amount,
           CASE WHEN paid_ratio = 0 THEN 'UNPAID' WHEN paid_ratio = 1 THEN 'FULLY_PAID'
                ELSE 'PARTIALLY_PAID' END AS payment_status
    FROM full_rows
)
"""

_SUMS = """
CAST(SUM(order_amount) AS DOUBLE) AS total_order_amount,
CAST(SUM(paid_amount) AS DOUBLE) AS total_paid_amount,
CAST(SUM(unpaid_amount) AS DOUBLE) AS total_unpaid_amount
"""

ORACLE = {
    "payments_joined": _FULL
    + """SELECT order_id, customer_id, first_name, last_name, city,
    CAST(order_amount AS DOUBLE) AS order_amount, CAST(paid_ratio AS DOUBLE) AS paid_ratio,
    CAST(paid_amount AS DOUBLE) AS paid_amount, CAST(unpaid_amount AS DOUBLE) AS unpaid_amount,
    payment_status FROM full_df""",
    "payments_totals": _FULL + f"SELECT COUNT(*) AS orders_count, {_SUMS} FROM full_df",
    "payments_by_status": _FULL
    + f"""SELECT payment_status, COUNT(*) AS orders_count, {_SUMS}
    FROM full_df GROUP BY payment_status ORDER BY payment_status""",
    "payments_top_customers": _FULL
    + f"""SELECT customer_id, first_name, last_name, city, {_SUMS} FROM full_df
    GROUP BY customer_id, first_name, last_name, city
    ORDER BY total_unpaid_amount DESC, customer_id, first_name, last_name, city LIMIT 10""",
    "payments_top_cities": _FULL
    + f"""SELECT city, {_SUMS}, COUNT(*) AS orders_count FROM full_df GROUP BY city
    ORDER BY total_order_amount DESC, city NULLS FIRST LIMIT 10""",
}
# The same report, whichever way the tables came in.
ORACLE["payments_three_sources"] = ORACLE["payments_top_cities"]
