"""Nested orders collected from ``orders``, ``lineitem``, ``part``, ``customer`` and ``nation``.

An order's items are its lines with the name of their part, its city is its
customer's nation. Orders without lines occur and have no items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.functions import quantiles
from rowcast.operators import nested
from rowcast.plans.joins import join_dimension
from rowcast.plans.scratch import scratch_path
from rowcast.sources import files
from rowcast.workloads.tables import rounded, rounded_sql, table


def nested_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order; lines are gathered by their order, which holds a few of them."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_extendedprice").alias("price"),
    )
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("part_id"), F.col("p_name").alias("product"))
    named = join_dimension(lines, parts, "part_id", "inner", right_unique=True)
    gathered = named.groupBy("order_id").agg(
        F.array_sort(F.collect_list(F.struct("line", "product", "qty", "price"))).alias("lines")
    )
    items = F.transform("lines", lambda one: F.struct(one["product"].alias("product"), one["qty"].alias("qty"), one["price"].alias("price")))
    people = table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("nation_id"))
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("city"))
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.struct(
            F.col("o_custkey").alias("id"),
            F.col("o_orderpriority").alias("name"),
            F.col("o_orderstatus").alias("surname"),
        ).alias("customer"),
    )
    known = join_dimension(orders, people, "customer_id", "left", right_unique=True)
    placed = join_dimension(known, nations, "nation_id", "left", right_unique=True).drop("customer_id", "nation_id")
    return placed.join(gathered.select("order_id", items.alias("items")), "order_id", "left").select(
        "order_id", "customer", "items", "city"
    )


def nested_items(spark: SparkSession, folder: str) -> DataFrame:
    """Written as JSON lines, read back with a schema, one row per item."""
    path = scratch_path(spark, "nested")
    files.write_json(nested_orders(spark, folder), path)
    return nested.items(files.read_json(spark, path, nested.READ_SCHEMA))


def nested_order_values(spark: SparkSession, folder: str) -> DataFrame:
    return nested.order_values(nested_orders(spark, folder))


def nested_totals(spark: SparkSession, folder: str) -> DataFrame:
    return nested.totals(nested_orders(spark, folder))


def nested_city_counts(spark: SparkSession, folder: str) -> DataFrame:
    return nested.city_counts(nested_orders(spark, folder))


def nested_city_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return nested.city_revenue(nested_orders(spark, folder))


def nested_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return nested.top_products(nested_orders(spark, folder))


def nested_describe(spark: SparkSession, folder: str) -> DataFrame:
    summary = nested.describe(nested_order_values(spark, folder), "order_value")
    return summary.withColumns(
        {"mean": rounded("mean"), "stddev": rounded("stddev")}
    )


def nested_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Exact at any size."""
    return nested.exact_quantiles(nested_order_values(spark, folder), "order_value")


def nested_city_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Order values per city and over all cities, from one sketch a city; each quantile's rank is checked.

    Sketches draw lots, so it is not the value that is compared but whether its
    rank, counted over all orders, is within one per cent.
    """
    path = scratch_path(spark, "order-values")
    files.write_parquet(nested_order_values(spark, folder).select("city", "order_value"), path)
    values = spark.read.schema("city string, order_value double").parquet(path)
    cities = quantiles.sketched(values, ["city"], "order_value")
    found = []
    for keys, sketches in ((["city"], cities), ([], quantiles.merged(cities))):
        estimates = quantiles.estimated(sketches)
        checked = quantiles.rank_errors(values, keys, "order_value", estimates)
        place = F.col("city") if keys else F.lit("all")
        found.append(checked.select(place.alias("city"), "probability", "value_count", (F.col("rank_error") <= quantiles.ERROR).alias("within")))
    return found[0].unionByName(found[1])


QUERIES = {
    "nested_city_quantiles": nested_city_quantiles,
    "nested_items": nested_items,
    "nested_order_values": nested_order_values,
    "nested_totals": nested_totals,
    "nested_city_counts": nested_city_counts,
    "nested_city_revenue": nested_city_revenue,
    "nested_top_products": nested_top_products,
    "nested_describe": nested_describe,
    "nested_quantiles": nested_quantiles,
}


_NESTED = """
WITH items AS (
    SELECT l_orderkey AS order_id, p_name AS product, CAST(l_quantity AS BIGINT) AS qty,
           l_extendedprice AS price
    FROM lineitem JOIN part ON l_partkey = p_partkey
), sums AS (
    SELECT order_id, SUM(qty * CAST(price AS DECIMAL(18, 2))) AS order_value
    FROM items GROUP BY order_id
), valued AS (
    SELECT o_orderkey AS order_id, n_name AS city, COALESCE(s.order_value, 0) AS exact_value,
           CAST(COALESCE(s.order_value, 0) AS DOUBLE) AS order_value
    FROM orders
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN sums s ON o_orderkey = s.order_id
)
"""

ORACLE = {
    "nested_city_quantiles": _NESTED
    + """SELECT city, CAST(p AS DOUBLE) AS probability, COUNT(*) AS value_count, TRUE AS within
    FROM (SELECT city FROM valued UNION ALL SELECT 'all' FROM valued), (SELECT UNNEST([0.25, 0.5, 0.75, 0.9, 0.99]) AS p)
    GROUP BY city, p""",
    "nested_items": _NESTED
    + "SELECT order_id, product, qty, price FROM items WHERE order_id IN (SELECT o_orderkey FROM orders)",
    "nested_order_values": _NESTED + "SELECT order_id, city, order_value FROM valued",
    "nested_totals": _NESTED
    + """SELECT COUNT(*) AS total_orders,
    CAST(SUM(exact_value) AS DOUBLE) / COUNT(*) AS avg_order_value FROM valued""",
    "nested_city_counts": _NESTED
    + """SELECT city, COUNT(*) AS orders_count FROM valued GROUP BY city
    ORDER BY orders_count DESC, city LIMIT 10""",
    "nested_city_revenue": _NESTED
    + """SELECT city, CAST(SUM(exact_value) AS DOUBLE) AS total_revenue FROM valued
    GROUP BY city ORDER BY total_revenue DESC, city LIMIT 10""",
    "nested_top_products": _NESTED
    + """SELECT product, CAST(SUM(qty * CAST(price AS DECIMAL(18, 2))) AS DOUBLE) AS revenue,
    CAST(SUM(qty) AS BIGINT) AS total_qty FROM items GROUP BY product
    ORDER BY revenue DESC, product LIMIT 10""",
    "nested_describe": _NESTED
    + f"""SELECT 'order_value' AS column_name, COUNT(order_value) AS count,
    {rounded_sql("AVG(order_value)")} AS mean, {rounded_sql("STDDEV_SAMP(order_value)")} AS stddev,
    MIN(order_value) AS min, MAX(order_value) AS max FROM valued""",
    "nested_quantiles": _NESTED
    + """SELECT CAST(p AS DOUBLE) AS probability, CAST(CASE p
        WHEN 0.25 THEN QUANTILE_DISC(order_value, 0.25)
        WHEN 0.5 THEN QUANTILE_DISC(order_value, 0.5)
        WHEN 0.75 THEN QUANTILE_DISC(order_value, 0.75)
        WHEN 0.9 THEN QUANTILE_DISC(order_value, 0.9)
        ELSE QUANTILE_DISC(order_value, 0.99) END AS DOUBLE) AS quantile
    FROM valued, (SELECT UNNEST([0.25, 0.5, 0.75, 0.9, 0.99]) AS p) ps GROUP BY p""",
}
