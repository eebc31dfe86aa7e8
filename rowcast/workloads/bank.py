"""Bank reports over ``customer``, ``orders`` and ``events``.

Orders stand in for transactions and events for alerts. Every tenth customer
key among the transactions is negated, so customers without transactions and
transactions without customers both occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.operators import bank
from rowcast.plans.scratch import scratch_path
from rowcast.sources import files
from rowcast.sources.synth import COUNTRIES
from rowcast.workloads.tables import table

def customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("last_name"),
        F.col("c_mktsegment").alias("segment"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    codes = F.array(*[F.lit(code) for code in COUNTRIES])
    buyer = F.col("o_custkey")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("tx_id"),
        F.when(buyer % 10 == 3, -buyer).otherwise(buyer).alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("channel"),
        F.element_at(codes, (F.col("o_orderkey") % 6 + 1).cast("int")).alias("country"),
        F.col("o_orderdate").alias("tx_timestamp"),
    )


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    scored = table(spark, folder, "events").select(
        F.col("event_id").alias("alert_id"),
        F.col("user_id").alias("customer_id"),
        ((F.col("event_id") * 37 % 1000) / 1000.0).alias("risk_score"),
        F.col("ts").alias("created_at"),
    )
    return scored.withColumn("risk_class", bank.risk_class(F.col("risk_score")))


def bank_top_customers(spark: SparkSession, folder: str) -> DataFrame:
    return bank.top_customers(spark, customers(spark, folder), transactions(spark, folder))


def bank_high_risk(spark: SparkSession, folder: str) -> DataFrame:
    return bank.high_risk(
        spark, customers(spark, folder), transactions(spark, folder), alerts(spark, folder)
    )


def bank_countries(spark: SparkSession, folder: str) -> DataFrame:
    return bank.countries(spark, transactions(spark, folder))


def bank_risk_groups(spark: SparkSession, folder: str) -> DataFrame:
    return bank.risk_groups(spark, transactions(spark, folder), alerts(spark, folder))


def bank_view_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per registered view, read back through the session catalog."""
    bank.register_views(
        customers(spark, folder), transactions(spark, folder), alerts(spark, folder), "bank_"
    )
    return spark.sql(
        """
        SELECT risk_class AS label, COUNT(*) AS row_count FROM bank_alerts GROUP BY risk_class
        UNION ALL SELECT segment, COUNT(*) FROM bank_customers GROUP BY segment
        UNION ALL SELECT channel, COUNT(*) FROM bank_transactions GROUP BY channel
        """
    )


def bank_three_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Customers through CSV, transactions through Parquet, alerts through JSON."""
    paths = [scratch_path(spark, name) for name in ("customers", "transactions", "alerts")]
    files.write_csv(customers(spark, folder), paths[0])
    files.write_parquet(transactions(spark, folder), paths[1])
    files.write_json(alerts(spark, folder), paths[2])
    people, moves, warnings = bank.read_sources(spark, *paths)
    return bank.high_risk(spark, people, moves, warnings).withColumn(
        "customer_id", F.col("customer_id").cast("bigint")
    )


QUERIES = {
    "bank_top_customers": bank_top_customers,
    "bank_high_risk": bank_high_risk,
    "bank_countries": bank_countries,
    "bank_risk_groups": bank_risk_groups,
    "bank_view_counts": bank_view_counts,
    "bank_three_sources": bank_three_sources,
}

# The results stated from their definitions: what each customer moved is summed
# first, and names, alerts and groups are looked up for those sums. Column names
# and the two group labels are fixed values, part of the results.
_MOVED = """
WITH moves AS (
    SELECT if(o_custkey % 10 = 3, -o_custkey, o_custkey) AS owner, o_totalprice::DECIMAL(18, 2) AS price,
           (['PL', 'DE', 'US', 'GB', 'FR', 'CZ'])[o_orderkey % 6 + 1] AS place
    FROM orders
), moved AS (
    SELECT owner, sum(price) AS total, count(price) AS priced, count(*) AS moves FROM moves GROUP BY owner
), people AS (
    SELECT c_custkey AS owner, c_name AS first_name, concat('nation ', c_nationkey) AS last_name,
           c_mktsegment AS segment
    FROM customer
), scores AS (
    SELECT event_id AS alert_id, user_id AS owner, (event_id * 37 % 1000)::DOUBLE / 1000.0 AS risk_score
    FROM events
), worst AS (
    SELECT alert_id, owner, risk_score FROM scores WHERE NOT risk_score < 0.8
)
"""

ORACLE = {
    "bank_top_customers": _MOVED
    + """SELECT owner AS customer_id, first_name, last_name, segment, total::DOUBLE AS total_amount,
           moves AS tx_count
    FROM moved JOIN people USING (owner)
    ORDER BY total DESC, owner LIMIT 10""",
    "bank_high_risk": _MOVED
    + """SELECT owner AS customer_id, first_name, last_name, segment, alert_id, risk_score,
           'high' AS risk_class, total::DOUBLE AS total_amount, coalesce(moves, 1) AS tx_count
    FROM worst JOIN people USING (owner) LEFT JOIN moved USING (owner)
    ORDER BY risk_score DESC, total DESC NULLS LAST, alert_id LIMIT 20""",
    "bank_countries": _MOVED
    + """SELECT place AS country, tx_count, total::DOUBLE AS total_amount, total::DOUBLE / priced AS avg_amount
    FROM (SELECT place, count(*) AS tx_count, count(price) AS priced, sum(price) AS total FROM moves GROUP BY place)
    ORDER BY total DESC""",
    "bank_risk_groups": _MOVED
    + """, sides AS (
        SELECT owner IN (SELECT owner FROM worst) AS watched, total, priced FROM moved
    ), halves AS (
        SELECT watched, sum(priced)::BIGINT AS tx_count, sum(total)::DOUBLE AS total_amount
        FROM sides GROUP BY watched
    )
    SELECT if(watched, 'HIGH_RISK_CUSTOMER', 'OTHER_CUSTOMER') AS customer_risk_group, tx_count,
           total_amount, total_amount / tx_count AS avg_amount
    FROM halves""",
    "bank_view_counts": _MOVED
    + """, labelled AS (
        SELECT CASE WHEN risk_score < 0.4 THEN 'low' WHEN risk_score < 0.8 THEN 'medium' ELSE 'high' END AS label
        FROM scores
        UNION ALL SELECT segment FROM people
        UNION ALL SELECT o_orderpriority FROM orders
    ), kinds AS (
        SELECT label, count(*) AS row_count FROM labelled GROUP BY label
    )
    SELECT label, row_count FROM kinds""",
}
# The same report, whichever way the tables came in.
ORACLE["bank_three_sources"] = ORACLE["bank_high_risk"]
