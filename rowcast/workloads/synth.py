"""Generated columns for the keys of ``customer``, ``orders`` and ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.functions import draws
from rowcast.operators import nested
from rowcast.plans.scratch import scratch_path
from rowcast.sources import files, synth
from rowcast.workloads.tables import rounded, rounded_sql, table


def _ids(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    return table(spark, folder, name).select(F.col(key).alias("id"))


def synth_customers(spark: SparkSession, folder: str) -> DataFrame:
    return synth.customers(_ids(spark, folder, "customer", "c_custkey"))


def synth_orders(spark: SparkSession, folder: str) -> DataFrame:
    return synth.orders(_ids(spark, folder, "orders", "o_orderkey"), 100_000)


def synth_payments(spark: SparkSession, folder: str) -> DataFrame:
    return synth.payments(_ids(spark, folder, "orders", "o_orderkey"))


def synth_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return synth.transactions(_ids(spark, folder, "orders", "o_orderkey"), 50_000)


def synth_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return synth.alerts(_ids(spark, folder, "events", "event_id"), 50_000)


def synth_nested_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Generated as JSON lines unless already there, then read and exploded."""
    path = scratch_path(spark, "synth-nested")
    made = synth.nested_orders(_ids(spark, folder, "orders", "o_orderkey"))
    files.write_if_absent(made, path, "json")
    return nested.items(files.read_json(spark, path, nested.READ_SCHEMA))


def synth_nested_heads(spark: SparkSession, folder: str) -> DataFrame:
    made = synth.nested_orders(_ids(spark, folder, "orders", "o_orderkey"))
    return made.select(
        "order_id",
        F.col("customer.id").alias("customer_id"),
        F.col("customer.name").alias("name"),
        F.col("customer.surname").alias("surname"),
        F.size("items").alias("item_count"),
        "city",
    )


def synth_numeric(spark: SparkSession, folder: str) -> DataFrame:
    made = synth.numeric(_ids(spark, folder, "events", "event_id"))
    return made.withColumn("value", rounded("value"))


QUERIES = {
    "synth_customers": synth_customers,
    "synth_orders": synth_orders,
    "synth_payments": synth_payments,
    "synth_transactions": synth_transactions,
    "synth_alerts": synth_alerts,
    "synth_nested_orders": synth_nested_orders,
    "synth_nested_heads": synth_nested_heads,
    "synth_numeric": synth_numeric,
}


# DuckDB macros cannot be declared inside a query, so each draw is spelled out.
def _draw(key: str, stream: int) -> str:
    prime = draws.PRIME
    high = f"({key}) // {prime} % {prime} * {draws.FOLD}"
    start = f"((({key}) % {prime} * {draws.SPREAD} + {high} + {stream * draws.STRIDE}) % {prime})"
    return f"(({start} * ({start} + {draws.TWIST}) + {stream}) % {prime} * {draws.SPREAD} % {prime})"


def _below(key: str, stream: int, size: int | str) -> str:
    return f"({_draw(key, stream)} * {size} // {draws.PRIME})"


def _unit(key: str, stream: int) -> str:
    return f"((CAST({_draw(key, stream)} AS DOUBLE) + 0.5) / CAST({draws.PRIME} AS DOUBLE))"


def _pick(values: list[str], key: str, stream: int) -> str:
    listed = ", ".join(f"'{value}'" for value in values)
    return f"([{listed}])[{_below(key, stream, len(values))} + 1]"


def _cents(key: str, stream: int, low: int, high: int) -> str:
    span = (high - low) * 100 + 1
    return f"(CAST({_below(key, stream, span)} + {low * 100} AS DOUBLE) / 100.0)"


def _clock(key: str, stream: int) -> str:
    hour = f"LPAD(CAST({_below(key, stream, 24)} AS VARCHAR), 2, '0')"
    minute = f"LPAD(CAST({_below(key, stream + 1, 60)} AS VARCHAR), 2, '0')"
    return f"CAST('{synth.DAY} ' || {hour} || ':' || {minute} || ':00' AS TIMESTAMP)"


_CATALOGUE = ", ".join(
    f"({i + 1}, '{name}', {low * 100}, {(high - low) * 100 + 1})"
    for i, (name, low, high) in enumerate(synth.PRODUCTS)
)
_HEAD = _draw("o_orderkey", 55)
_FILLED = f"CASE WHEN {_HEAD} // 2240 % 20 = 0 THEN 0 ELSE {_HEAD} // 448 % 5 + 1 END"


def _listed(values: list[str], before: int) -> str:
    names = ", ".join(f"'{value}'" for value in values)
    return f"([{names}])[{_HEAD} // {before} % {len(values)} + 1]"



_NORMAL = (
    f"SQRT(LN({_unit('event_id', 61)}) * -2.0) "
    f"* COS({_unit('event_id', 62)} * 6.283185307179586) * 20.0 + 100.0"
)

ORACLE = {
    "synth_customers": f"""SELECT c_custkey AS customer_id,
    {_pick(synth.FIRST_NAMES, "c_custkey", 1)} AS first_name,
    {_pick(synth.LAST_NAMES, "c_custkey", 2)} AS last_name,
    {_pick(synth.CITIES, "c_custkey", 3)} AS city,
    {_pick(synth.SEGMENTS, "c_custkey", 4)} AS segment FROM customer""",
    "synth_orders": f"""SELECT o_orderkey AS order_id,
    CAST({_below("o_orderkey", 11, 100_000)} + 1 AS INTEGER) AS customer_id,
    {_cents("o_orderkey", 12, 100, 2000)} AS order_amount FROM orders""",
    "synth_payments": f"""SELECT o_orderkey AS order_id,
    CAST(CASE WHEN {_below("o_orderkey", 21, 1000)} < 100 THEN 0.0
    WHEN {_below("o_orderkey", 21, 1000)} < 200 THEN 0.5 ELSE 1.0 END AS DOUBLE) AS paid_ratio
    FROM orders""",
    "synth_transactions": f"""SELECT o_orderkey AS tx_id,
    CAST({_below("o_orderkey", 31, 50_000)} + 1 AS INTEGER) AS customer_id,
    {_cents("o_orderkey", 32, 10, 10000)} AS amount,
    {_pick(synth.CHANNELS, "o_orderkey", 33)} AS channel,
    {_pick(synth.COUNTRIES, "o_orderkey", 34)} AS country,
    {_clock("o_orderkey", 35)} AS tx_timestamp FROM orders""",
    "synth_alerts": f"""WITH scored AS (
        SELECT event_id AS alert_id,
        CAST({_below("event_id", 41, 50_000)} + 1 AS INTEGER) AS customer_id,
        CAST({_below("event_id", 42, 1001)} AS DOUBLE) / 1000.0 AS risk_score,
        {_clock("event_id", 43)} AS created_at FROM events
    ) SELECT *, CASE WHEN risk_score >= 0.8 THEN 'high' WHEN risk_score >= 0.4 THEN 'medium'
    ELSE 'low' END AS risk_class FROM scored""",
    "synth_nested_orders": f"""WITH catalogue(position, product, low, span) AS (
        VALUES {_CATALOGUE}
    ), lines AS (
        SELECT o_orderkey AS order_id, {_draw("o_orderkey * 8 + n.i", 51)} AS drawn
        FROM orders JOIN (SELECT UNNEST(RANGE(1, 6)) AS i) n ON n.i <= {_FILLED}
    )
    SELECT order_id, product, drawn // 8 % 5 + 1 AS qty,
    CAST(low + drawn // 40 % span AS DOUBLE) / 100.0 AS price
    FROM lines JOIN catalogue ON position = drawn % 8 + 1""",
    "synth_nested_heads": f"""SELECT o_orderkey AS order_id,
    {_below("o_orderkey", 56, 900_000)} + 100000 AS customer_id,
    {_listed(synth.FIRST_NAMES, 1)} AS name,
    {_listed(synth.LAST_NAMES, 8)} AS surname,
    CAST({_FILLED} AS INTEGER) AS item_count,
    {_listed(synth.CITIES, 56)} AS city FROM orders""",
    "synth_numeric": f"""SELECT event_id AS id,
    {rounded_sql(_NORMAL)} AS value,
    {_pick(synth.CATEGORIES, "event_id", 63)} AS category FROM events""",
}
