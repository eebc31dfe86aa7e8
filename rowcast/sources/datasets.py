"""Whole generated data sets of three sources, each table written only where it is absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowcast.sources import files, synth


def _stored(tables: dict[str, tuple[DataFrame, str]], folder: str) -> dict[str, str]:
    paths = {}
    for name, (rows, form) in tables.items():
        path = paths[name] = f"{folder.rstrip('/')}/{name}_{form}"
        if form == "csv":
            files.write_csv(rows, path, mode="ignore")
        else:
            files.write_if_absent(rows, path, form, **(files.TIME_FORMATS if form == "json" else {}))
    return paths


def write_payment_sources(
    spark: SparkSession, folder: str, customers: int = 100_000, orders: int = 500_000, forms=("csv", "parquet", "json")
) -> dict[str, str]:
    """Customers, orders and one payment per order; returns where each lies."""
    buyers, placed = synth.id_range(spark, customers), synth.id_range(spark, orders)
    tables = (synth.customers(buyers), synth.orders(placed, customers), synth.payments(placed))
    return _stored(dict(zip(("customers", "orders", "payments"), zip(tables, forms))), folder)


def write_bank_sources(
    spark: SparkSession, folder: str, customers: int = 50_000, transactions: int = 200_000, alerts: int = 10_000, forms=("csv", "parquet", "json")
) -> dict[str, str]:
    """Customers, transactions and alerts; returns where each lies."""
    tables = (
        synth.customers(synth.id_range(spark, customers)),
        synth.transactions(synth.id_range(spark, transactions), customers),
        synth.alerts(synth.id_range(spark, alerts), customers),
    )
    return _stored(dict(zip(("customers", "transactions", "alerts"), zip(tables, forms))), folder)
