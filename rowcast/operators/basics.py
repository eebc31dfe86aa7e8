"""Small single-table steps: filters, averages, casts, heads and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    ByteType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Bytes per stored value of each fixed-width type.
WIDTHS = {
    BooleanType: 1,
    ByteType: 1,
    ShortType: 2,
    IntegerType: 4,
    FloatType: 4,
    DateType: 4,
    LongType: 8,
    DoubleType: 8,
    TimestampType: 8,
    TimestampNTZType: 8,
}


def above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Rows whose ``column`` exceeds ``threshold``; pushed down to the scan."""
    return df.filter(F.col(column) > threshold)


def group_average(df: DataFrame, key: str, value: str) -> DataFrame:
    """Average of ``value`` per ``key`` under the name ``avg(value)``."""
    return df.groupBy(key).avg(value)


def average(df: DataFrame, value: str) -> DataFrame:
    """Average of one column in one row."""
    return df.agg(F.avg(value).alias(f"avg({value})"))


def widen(integer: Column, real: Column) -> Column:
    """Integer plus real number."""
    return integer + real


def minus_flag(integer: Column, flag: Column) -> Column:
    """Integer minus a boolean counted as 0 or 1."""
    return integer - flag.cast("int")


def times_text(integer: Column, text: Column) -> Column:
    """Integer times a number written as text; NULL if it is none."""
    return integer * text.try_cast("int")


def head(df: DataFrame, count: int = 10, key: str | None = None) -> DataFrame:
    """First rows, in the order of ``key`` if given."""
    return (df.orderBy(key) if key else df).limit(count)


def retitle(df: DataFrame, names: dict[str, str], drop: tuple[str, ...] = ()) -> DataFrame:
    """Rename and drop columns in one projection."""
    return df.withColumnsRenamed(names).drop(*drop)


def _payload(column: Column, kind) -> Column:
    """Stored bytes of one value; NULL for NULL."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.octet_length(column).cast("bigint")
    width = WIDTHS.get(type(kind))
    if width is not None:
        return F.when(column.isNotNull(), F.lit(width).cast("bigint"))
    # Nested values are measured by their JSON text.
    if isinstance(kind, StructType) or hasattr(kind, "elementType") or hasattr(kind, "keyType"):
        return F.octet_length(F.to_json(column)).cast("bigint")
    return F.octet_length(column.cast("string")).cast("bigint")


def profile(df: DataFrame) -> DataFrame:
    """Rows, non-null values and payload bytes per column, in one pass."""
    rows = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count(field.name).alias("value_count"),
            F.coalesce(F.sum(_payload(F.col(field.name), field.dataType)), F.lit(0)).alias(
                "payload_bytes"
            ),
        )
        for field in df.schema.fields
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def partitions(df: DataFrame) -> DataFrame:
    """Number of non-empty partitions and the rows of the smallest and largest."""
    sizes = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("partition_count"),
        F.min("n").alias("smallest"),
        F.max("n").alias("largest"),
    )
