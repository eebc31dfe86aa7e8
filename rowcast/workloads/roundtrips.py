"""Tables written in each format and read back whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.plans.scratch import scratch_path
from rowcast.sources import files, foreign
from rowcast.workloads import bank
from rowcast.workloads.tables import rounded, rounded_sql, table

WIDTH = 64


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """CSV with header; a subset of columns is read back by name and cast."""
    path = scratch_path(spark, "csv")
    files.write_csv(table(spark, folder, "customer"), path)
    return files.read_csv(
        spark, path, "c_custkey int, c_name string, c_mktsegment string, c_acctbal double"
    )


def csv_lazy_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """CSV scanned lazily under a full schema, then averaged per category."""
    path = scratch_path(spark, "csv-lazy")
    part = table(spark, folder, "part")
    rows = part.selectExpr("p_partkey AS id", "p_retailprice AS value", "p_brand AS category")
    files.write_csv(rows, path)
    scan = files.read_csv_lazy(spark, path, "id bigint, value double, category string")
    return scan.groupBy("category").agg(rounded(F.avg("value")).alias("avg_value"))


def csv_headerless_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "csv-headerless")
    measures = table(spark, folder, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
    )
    files.write_csv(measures, path, header=False)
    return files.read_csv_headerless(
        spark, path, "quantity double, price double, discount double, tax double, target string"
    )


def csv_gzip_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Gzipped label and features, read as doubles and spread over the cluster."""
    path = scratch_path(spark, "csv-gzip")
    vectors = table(spark, folder, "embeddings").select(
        F.col("label").cast("double").alias("label"),
        *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(WIDTH)],
    )
    files.write_csv(vectors, path, header=False, compression="gzip")
    return files.read_numeric_gzip(spark, path, WIDTH)


def csv_foreign_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents in CSV as other programs write it, with line breaks inside quotes, read back in parallel."""
    path = scratch_path(spark, "csv_foreign")
    docs = table(spark, folder, "documents")
    quoted = [F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"')) for c in ("text", "lang")]
    row = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in (quoted[0], F.col("doc_id").cast("string"), quoted[1], F.col("n_chars").cast("string"))])
    # The header opens every file; rows of this writer end in CR LF.
    files.write_text(docs.select(F.concat(row, F.lit("\r")).alias("value")), path, header="text,doc_id,lang,n_chars\r")
    return foreign.read_foreign_csv(spark, path, "doc_id bigint, text string, lang string, n_chars bigint")


def csv_text_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents with their line breaks, quotes and blanks."""
    path = scratch_path(spark, "csv_text")
    files.write_csv(table(spark, folder, "documents").select("doc_id", "text", "lang"), path)
    return files.read_csv_lazy(spark, path, "doc_id bigint, text string, lang string")


def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Written only if absent: the second write must change nothing."""
    path = scratch_path(spark, "parquet")
    orders = table(spark, folder, "orders")
    files.write_if_absent(orders, path)
    files.write_if_absent(orders.filter("o_orderkey < 0"), path)
    return files.read_parquet(spark, path)


def parquet_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "parquet-overwrite")
    files.write_parquet(table(spark, folder, "supplier"), path)
    files.write_parquet(table(spark, folder, "part"), path)
    return files.read_parquet(spark, path)


def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "json")
    files.write_json(bank.alerts(spark, folder), path)
    return files.read_json(
        spark,
        path,
        "alert_id bigint, customer_id bigint, risk_score double, risk_class string, "
        "created_at timestamp_ntz",
    )


def text_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Lines per length after a trip through text files."""
    path = scratch_path(spark, "text")
    files.write_text(table(spark, folder, "pages").select(F.col("url").alias("value")), path)
    lines = files.read_text(spark, path)
    return lines.groupBy(F.length("value").alias("line_length")).agg(
        F.count(F.lit(1)).alias("line_count")
    )


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "csv_lazy_roundtrip": csv_lazy_roundtrip,
    "csv_headerless_roundtrip": csv_headerless_roundtrip,
    "csv_gzip_roundtrip": csv_gzip_roundtrip,
    "csv_text_roundtrip": csv_text_roundtrip,
    "csv_foreign_roundtrip": csv_foreign_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "parquet_overwrite": parquet_overwrite,
    "json_roundtrip": json_roundtrip,
    "text_roundtrip": text_roundtrip,
}

ORACLE = {
    "csv_roundtrip": """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_mktsegment,
    c_acctbal FROM customer""",
    "csv_lazy_roundtrip": f"""SELECT p_brand AS category, {rounded_sql("AVG(p_retailprice)")} AS avg_value
    FROM part GROUP BY p_brand""",
    "csv_headerless_roundtrip": """SELECT l_quantity AS quantity, l_extendedprice AS price,
    l_discount AS discount, l_tax AS tax, l_returnflag AS target FROM lineitem""",
    "csv_gzip_roundtrip": "SELECT CAST(label AS DOUBLE) AS label, "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(WIDTH))
    + " FROM embeddings",
    "parquet_roundtrip": "SELECT * FROM orders",
    "parquet_overwrite": "SELECT * FROM part",
    "json_roundtrip": """SELECT event_id AS alert_id, user_id AS customer_id, risk_score,
    CASE WHEN risk_score >= 0.8 THEN 'high' WHEN risk_score < 0.4 THEN 'low' ELSE 'medium' END AS risk_class,
    ts AS created_at
    FROM (SELECT *, CAST(event_id * 37 % 1000 AS DOUBLE) / 1000.0 AS risk_score FROM events)""",
    "csv_text_roundtrip": "SELECT doc_id, text, lang FROM documents",
    "csv_foreign_roundtrip": "SELECT doc_id, text, lang, n_chars FROM documents",
    "text_roundtrip": """SELECT CAST(LENGTH(url) AS INTEGER) AS line_length,
    COUNT(*) AS line_count FROM pages GROUP BY LENGTH(url)""",
}
