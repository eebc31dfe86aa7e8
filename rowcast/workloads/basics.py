"""Single-table steps over ``orders``, ``part`` and ``customer``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.functions import limbs
from rowcast.operators import basics, layout
from rowcast.plans.scratch import scratch_path
from rowcast.sources import files
from rowcast.workloads.tables import SCHEMAS, rounded, rounded_sql, table


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").alias("amount"),
    )


def basic_filter(spark: SparkSession, folder: str) -> DataFrame:
    return basics.above(_orders(spark, folder), "amount", 250000.0)


def basic_group_avg(spark: SparkSession, folder: str) -> DataFrame:
    means = basics.group_average(_orders(spark, folder), "category", "amount")
    return means.select("category", rounded("avg(amount)").alias("avg_amount"))


def basic_to_pandas(spark: SparkSession, folder: str) -> DataFrame:
    """A small grouped result taken to pandas and back; a large one is refused."""
    return spark.createDataFrame(
        files.to_pandas(basic_group_avg(spark, folder)), "category string, avg_amount double"
    )


def basic_mean(spark: SparkSession, folder: str) -> DataFrame:
    mean = basics.average(_orders(spark, folder), "amount")
    return mean.select(rounded("avg(amount)").alias("avg_amount"))


def basic_casts(spark: SparkSession, folder: str) -> DataFrame:
    """Mixed arithmetic on every part: int + double, int - boolean, int * text."""
    size = F.col("p_size")
    digits = F.regexp_extract("p_brand", r"(\d+)", 1)
    return table(spark, folder, "part").select(
        "p_partkey",
        basics.widen(size, F.col("p_retailprice")).alias("widened"),
        basics.minus_flag(size, F.col("p_type") == "ECONOMY").alias("less_flag"),
        basics.times_text(size, digits).alias("by_text"),
        basics.times_text(size, F.col("p_name")).alias("by_word"),
        F.col("p_retailprice").cast("int").alias("truncated"),
    )


def basic_head(spark: SparkSession, folder: str) -> DataFrame:
    return basics.head(_orders(spark, folder), 10, "order_id")


def basic_retitled(spark: SparkSession, folder: str) -> DataFrame:
    return basics.retitle(
        table(spark, folder, "customer"),
        {"c_custkey": "customer_id", "c_name": "full_name"},
        drop=("c_acctbal", "c_nationkey"),
    )


def table_profile(spark: SparkSession, folder: str) -> DataFrame:
    return basics.profile(table(spark, folder, "lineitem"))


def table_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines written by return flag; rows, files and bytes of every folder as the files themselves tell."""
    path = scratch_path(spark, "layout")
    table(spark, folder, "lineitem").write.partitionBy("l_returnflag").parquet(path)
    blocks = layout.blocks(spark.read.schema(SCHEMAS["lineitem"]).parquet(path))
    folders = blocks.withColumn("l_returnflag", F.regexp_extract("file_path", "l_returnflag=([^/]*)/", 1))
    files = layout.files(folders, "l_returnflag")
    return files.groupBy("l_returnflag").agg(
        F.sum("rows").alias("row_count"), F.bool_and((F.col("file_bytes") > 0) & F.col("in_one_piece")).alias("files_whole")
    )


def exact_event_sums(spark: SparkSession, folder: str) -> DataFrame:
    """Values of very different size and sign per type, summed without rounding: whole part and fraction."""
    scaled = F.col("value") * F.pow(F.lit(2.0), (F.col("event_id") % 25 - 12).cast("double"))
    signed = F.when(F.col("event_id") % 3 == 0, -scaled).otherwise(scaled)
    sums = limbs.exact_sums(table(spark, folder, "events").withColumn("v", signed), "v", "event_type")
    return sums.select(
        "event_type",
        "value_count",
        limbs.whole_part("sum").cast("string").alias("whole"),
        limbs.fraction("sum").cast("string").alias("fraction"),
    )


QUERIES = {
    "table_layout": table_layout,
    "exact_event_sums": exact_event_sums,
    "basic_filter": basic_filter,
    "basic_group_avg": basic_group_avg,
    "basic_mean": basic_mean,
    "basic_to_pandas": basic_to_pandas,
    "basic_casts": basic_casts,
    "basic_head": basic_head,
    "basic_retitled": basic_retitled,
    "table_profile": table_profile,
}

_ORDERS = """
WITH placed AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderpriority AS category,
           o_totalprice AS amount
    FROM orders
)
"""

_WIDTHS = {
    "l_orderkey": 8, "l_partkey": 8, "l_suppkey": 8, "l_linenumber": 4, "l_quantity": 8,
    "l_extendedprice": 8, "l_discount": 8, "l_tax": 8, "l_shipdate": 8,
}
_LINEITEM = [*_WIDTHS, "l_returnflag", "l_linestatus"]

# Sums as whole numbers of 2 ** -72; every value is a multiple of that.
_UNIT = 1 << 72

ORACLE = {
    "table_layout": "SELECT l_returnflag, COUNT(*) AS row_count, TRUE AS files_whole FROM lineitem GROUP BY l_returnflag",
    "exact_event_sums": f"""WITH scaled AS (
        SELECT event_type, CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END * value * POW(2.0::DOUBLE, event_id % 25 - 12) AS v FROM events
    ), summed AS (
        SELECT event_type, COUNT(v) AS value_count, SUM(CAST(v * {float(_UNIT)!r}::DOUBLE AS HUGEINT)) AS s FROM scaled GROUP BY event_type
    )
    SELECT event_type, value_count, CAST((s - f) // {_UNIT}::HUGEINT AS VARCHAR) AS whole, CAST(f AS VARCHAR) AS fraction
    FROM (SELECT *, ((s % {_UNIT}::HUGEINT) + {_UNIT}::HUGEINT) % {_UNIT}::HUGEINT AS f FROM summed)""",
    "basic_filter": _ORDERS + "SELECT * FROM placed WHERE amount > 250000",
    "basic_group_avg": _ORDERS
    + f"SELECT category, {rounded_sql('AVG(amount)')} AS avg_amount FROM placed GROUP BY category",
    "basic_mean": _ORDERS + f"SELECT {rounded_sql('AVG(amount)')} AS avg_amount FROM placed",
    "basic_casts": r"""SELECT p_partkey, p_size + p_retailprice AS widened,
    p_size - CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END AS less_flag,
    p_size * TRY_CAST(REGEXP_EXTRACT(p_brand, '(\d+)', 1) AS INTEGER) AS by_text,
    p_size * TRY_CAST(p_name AS INTEGER) AS by_word,
    CAST(TRUNC(p_retailprice) AS INTEGER) AS truncated FROM part""",
    "basic_head": _ORDERS + "SELECT * FROM placed ORDER BY order_id LIMIT 10",
    "basic_retitled": """SELECT c_custkey AS customer_id, c_name AS full_name, c_mktsegment
    FROM customer""",
    "table_profile": "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, COUNT(*) AS row_count, COUNT({name}) AS value_count, "
        + (
            f"CAST({_WIDTHS[name]} * COUNT({name}) AS BIGINT)"
            if name in _WIDTHS
            else f"CAST(SUM(STRLEN({name})) AS BIGINT)"
        )
        + " AS payload_bytes FROM lineitem"
        for name in _LINEITEM
    ),
}
ORACLE["basic_to_pandas"] = ORACLE["basic_group_avg"]
