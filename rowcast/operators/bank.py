"""Bank and risk reports over customers, transactions and alerts, in SQL.

Inputs
    customers     ``customer_id, first_name, last_name, segment``
    transactions  ``tx_id, customer_id, amount, channel, country, tx_timestamp``
    alerts        ``alert_id, customer_id, risk_score, risk_class, created_at``

Transactions are summed per customer before any lookup, so what is joined is
one row per customer on both sides and a customer with very many transactions
or alerts multiplies nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.functions.exact import amount, amount_sql, mean, sum_units_sql, units_sql
from rowcast.plans.joins import join_dimension
from rowcast.sources import files

# Labels of the two groups.
HIGH_RISK = "HIGH_RISK_CUSTOMER"
OTHER = "OTHER_CUSTOMER"

# One pass with map-side combining: one row per customer leaves it.
_SPEND = f"""
    SELECT customer_id, {sum_units_sql("u")} AS units, COUNT(u) AS amounts, COUNT(*) AS tx_count
    FROM (SELECT customer_id, {units_sql("amount")} AS u FROM {{transactions}})
    GROUP BY customer_id
"""
_TOTAL = amount_sql("total_units")


def read_sources(
    spark: SparkSession, customers_csv: str, transactions_parquet: str, alerts_json: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers, transactions and alerts from their three file formats."""
    return (
        files.read_csv(
            spark,
            customers_csv,
            "customer_id int, first_name string, last_name string, segment string",
        ),
        files.read_parquet(spark, transactions_parquet),
        files.read_json(
            spark,
            alerts_json,
            "alert_id bigint, customer_id int, risk_score double, risk_class string, "
            "created_at timestamp_ntz",
        ),
    )


def risk_class(score: Column) -> Column:
    return F.when(score >= 0.8, "high").when(score >= 0.4, "medium").otherwise("low")


def register_views(
    customers: DataFrame, transactions: DataFrame, alerts: DataFrame, prefix: str = ""
) -> None:
    """Name the three sources for SQL in the current session."""
    customers.createOrReplaceTempView(f"{prefix}customers")
    transactions.createOrReplaceTempView(f"{prefix}transactions")
    alerts.createOrReplaceTempView(f"{prefix}alerts")


def spend(spark: SparkSession, transactions: DataFrame) -> DataFrame:
    return spark.sql(_SPEND, transactions=transactions)


def top_customers(
    spark: SparkSession, customers: DataFrame, transactions: DataFrame, count: int = 10
) -> DataFrame:
    """Customers with the largest sum of transactions."""
    return spark.sql(
        f"""
        SELECT customer_id, first_name, last_name, segment, {_TOTAL} AS total_amount, tx_count
        FROM (
            SELECT c.customer_id, c.first_name, c.last_name, c.segment,
                   SUM(s.units) AS total_units, SUM(s.tx_count) AS tx_count
            FROM {{spend}} s JOIN {{customers}} c ON s.customer_id = c.customer_id
            GROUP BY c.customer_id, c.first_name, c.last_name, c.segment
        )
        ORDER BY total_units DESC NULLS LAST, customer_id, first_name, last_name, segment
        LIMIT :count
        """,
        args={"count": count},
        spend=spend(spark, transactions),
        customers=customers,
    )


def high_risk(
    spark: SparkSession,
    customers: DataFrame,
    transactions: DataFrame,
    alerts: DataFrame,
    count: int = 20,
    **skew,
) -> DataFrame:
    """High-risk alerts with the customer's transaction total.

    Each alert repeats its customer's total. A customer without transactions
    has a NULL total and, as one unmatched row, a count of 1.
    """
    # One row per customer id, so that a repeated customer multiplies nothing here.
    profiles = spark.sql(
        """
        SELECT c.customer_id, c.first_name, c.last_name, c.segment,
               s.units, COALESCE(s.tx_count, 1) AS tx_count
        FROM {customers} c LEFT JOIN {spend} s ON s.customer_id = c.customer_id
        """,
        customers=customers,
        spend=spend(spark, transactions),
    )
    flagged = alerts.filter(F.col("risk_class") == "high").select(
        "alert_id", "customer_id", "risk_score", "risk_class"
    )
    return spark.sql(
        f"""
        SELECT customer_id, first_name, last_name, segment, alert_id, risk_score, risk_class,
               {_TOTAL} AS total_amount, tx_count
        FROM (
            SELECT customer_id, first_name, last_name, segment, alert_id, risk_score,
                   risk_class, SUM(units) AS total_units, SUM(tx_count) AS tx_count
            FROM {{matched}}
            GROUP BY customer_id, first_name, last_name, segment, alert_id, risk_score,
                     risk_class
        )
        ORDER BY risk_score DESC NULLS LAST, total_units DESC NULLS LAST, alert_id,
                 customer_id, first_name, last_name, segment
        LIMIT :count
        """,
        args={"count": count},
        matched=join_dimension(
            flagged, profiles, "customer_id", "inner", right_keys=customers, right_scan=False, **skew
        ),
    )


def countries(spark: SparkSession, transactions: DataFrame) -> DataFrame:
    """Countries by transaction volume."""
    return spark.sql(
        f"""
        SELECT country, tx_count, {amount_sql("units")} AS total_amount,
               {amount_sql("units")} / NULLIF(amounts, 0) AS avg_amount
        FROM (
            SELECT country, COUNT(*) AS tx_count, COUNT(u) AS amounts, {sum_units_sql("u")} AS units
            FROM (SELECT country, {units_sql("amount")} AS u FROM {{transactions}})
            GROUP BY country
        )
        ORDER BY total_amount DESC NULLS LAST, country
        """,
        transactions=transactions,
    )


def flagged_customers(alerts: DataFrame) -> DataFrame:
    """Distinct customers with a high-risk alert."""
    return alerts.filter(F.col("risk_class") == "high").select("customer_id").distinct()


def risk_groups(spark: SparkSession, transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Transactions of customers with a high-risk alert against all others."""
    marked = flagged_customers(alerts).withColumn("customer_risk_group", F.lit(HIGH_RISK))
    spent = spend(spark, transactions).join(marked, "customer_id", "left")
    grouped = spent.groupBy(F.coalesce("customer_risk_group", F.lit(OTHER)).alias("customer_risk_group"))
    summed = grouped.agg(F.sum("amounts").alias("tx_count"), F.sum("units").alias("units"))
    return summed.select(
        "customer_risk_group",
        "tx_count",
        amount("units").alias("total_amount"),
        mean(F.col("units"), F.col("tx_count")).alias("avg_amount"),
    )
