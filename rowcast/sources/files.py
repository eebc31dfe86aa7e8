"""Readers and writers for CSV, Parquet, JSON lines and text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

Schema = StructType | str

# Line breaks inside a text are written as two characters led by ESC (NUL too), so that
# every line is a row and large files can be cut anywhere; ESC itself likewise.
# NULL is a mark that no text can be, which keeps it apart from an empty text.
_ESCAPES = (("\x1b", "\x1be"), ("\x00", "\x1bz"), ("\n", "\x1bn"), ("\r", "\x1br"))
_CSV = {
    "quote": '"',
    "escape": '"',
    "nullValue": "\x1b0",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# Text forms that keep timestamps to the microsecond.
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _fields(spark: SparkSession, schema: Schema) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def _named(field: StructField) -> Column:
    return F.col(f"`{field.name}`")


def _written(field: StructField) -> Column:
    """A text with its line breaks escaped; other columns as they are."""
    column = _named(field)
    if isinstance(field.dataType, StringType):
        for plain, escaped in _ESCAPES:
            column = F.replace(column, F.lit(plain), F.lit(escaped))
    return column.alias(field.name)


def _read(field: StructField) -> Column:
    """The text as it was before ``_written``."""
    column = _named(field)
    if isinstance(field.dataType, StringType):
        for plain, escaped in reversed(_ESCAPES):
            column = F.replace(column, F.lit(escaped), F.lit(plain))
    return column.alias(field.name)


def _typed(field: StructField) -> Column:
    if isinstance(field.dataType, StringType):
        return _read(field)
    return _named(field).try_cast(field.dataType).alias(field.name)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Give heavy per-row work all slots when a scan has fewer tasks than that.

    A table of many files comes back unchanged, without a shuffle.
    """
    wanted = partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def read_csv(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """CSV with a header: columns chosen by header name and cast.

    Text that does not parse becomes NULL. Only the chosen columns are parsed.
    All files must have the columns in the order of the first; one that has
    not is an error when it is read. An unquoted empty field is NULL, a quoted
    one an empty text.
    """
    text = spark.read.options(**_CSV, header=True, enforceSchema=False).csv(path)
    return text.select(*[_typed(field) for field in _fields(spark, schema).fields])


def _scanned(spark: SparkSession, path: str, schema: Schema, **options) -> DataFrame:
    fields = _fields(spark, schema)
    scan = spark.read.schema(fields).options(**_CSV, **options).csv(path)
    return scan.select(*[_read(field) for field in fields.fields])


def read_csv_lazy(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """CSV with a header whose column order is known: one lazy scan, no peek at the file.

    A header that differs from the schema is an error when its file is read.
    """
    return _scanned(spark, path, schema, header=True, enforceSchema=False)


def read_csv_headerless(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """CSV without a header, columns named by the caller."""
    return _scanned(spark, path, schema)


def read_numeric_gzip(
    spark: SparkSession, path: str, features: int, partitions: int | None = None
) -> DataFrame:
    """Gzipped CSV of a label and ``features`` numbers.

    A gzip file is one task however large it is, so rows are spread out right
    after the scan when there are few of them.
    """
    names = ["label"] + [f"f{i}" for i in range(features)]
    schema = StructType([StructField(name, DoubleType()) for name in names])
    return spread(spark.read.schema(schema).options(**_CSV).csv(path), partitions)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_json(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """JSON lines with a given schema: no inference pass, only listed fields parsed."""
    return spark.read.schema(_fields(spark, schema)).json(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One ``value`` per line."""
    return spark.read.text(path)


def from_rows(spark: SparkSession, rows: Iterable[Sequence], schema: Schema) -> DataFrame:
    """A small literal table with an explicit schema."""
    return spark.createDataFrame(list(rows), _fields(spark, schema))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """CSV that the readers above return as it was: breaks, quotes, blanks, empty texts, NULL."""
    rows = df.select(*[_written(field) for field in df.schema.fields])
    every = {"header": True, "quoteAll": True, **_CSV, **TIME_FORMATS, **options}
    rows.write.mode(mode).options(**every).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**TIME_FORMATS).json(path)


def write_text(df: DataFrame, path: str, mode: str = "overwrite", header: str | None = None) -> None:
    """One line per ``value``; with ``header`` every file begins with that line."""
    if header is not None:

        def headed(batches):
            first = True
            for batch in batches:
                if first and batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array([header], batch.schema.field(0).type)], schema=batch.schema)
                    first = False
                yield batch

        df = df.mapInArrow(headed, "value string")
    df.write.mode(mode).text(path)


def write_if_absent(df: DataFrame, path: str, form: str = "parquet", **options) -> None:
    """Write only when nothing is stored at ``path``; an existing table is left alone."""
    df.write.mode("ignore").format(form).options(**options).save(path)


def preview(df: DataFrame, count: int = 5) -> DataFrame:
    """The first rows met, for a look at the data."""
    return df.limit(count)


def schema_table(df: DataFrame) -> DataFrame:
    """The schema as rows: position, name, type, nullable."""
    rows = [
        (i, field.name, field.dataType.simpleString(), field.nullable)
        for i, field in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean"
    )


def to_pandas(df: DataFrame, limit: int = 10_000):
    """A small result as a pandas frame; refuses a larger one instead of cutting it."""
    frame = df.limit(limit + 1).toPandas()
    if len(frame) > limit:
        raise ValueError(f"result has more than {limit} rows; aggregate it first")
    return frame
