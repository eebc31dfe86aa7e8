"""CSV that other programs wrote: quoted texts with line breaks, read in parallel.

A line break inside quotes does not end a row, so where a block of a file may be
cut is known only from the quotes before it. A first pass counts the quotes of
every block; the parity of their sum up to a block says whether it begins inside
a quoted text. A second pass joins each block's lines into rows, streaming. What
a block holds before its first row and after its last complete one is a piece
of a row that other blocks share; those few pieces are put together by row. So a
file of any size is read by as many tasks as it has blocks.

Quotes inside a text are doubled, fields are separated by one character, rows
end in LF or CR LF. An unquoted empty field is NULL, a quoted one an empty text.
Line breaks inside quotes are kept as they are; blank lines between rows are
left out. A quote that is never closed makes the rest of its file one row.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rowcast.plans.reuse import settled

# Files of one table may differ in their header this often.
MAX_HEADERS = 100
# Stands for a quoted empty text while NULL and empty are told apart.
_EMPTY = "\x00empty\x00"
_PIECES = "file int, place int, kind string, text string"
_NAMES = [part.split()[0] for part in _PIECES.split(", ")]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as they stand, with the file and block they were read from, in order within each block."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")


def block_parity(lines: DataFrame, quote: str = '"') -> DataFrame:
    """``(path, block, file, place, leading, opened)``: whether a block begins a file, and inside quotes. One row a block."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit(quote), F.lit("")))
    counted = lines.groupBy("path", "block").agg(F.sum(quotes).alias("quotes"))
    order = Window.partitionBy("path").orderBy("block")
    before = F.coalesce(F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parity = counted.select("path", "block", F.row_number().over(order).alias("place"), (before % 2 == 1).alias("opened"))
    # Numbers instead of paths travel with the lines.
    files = counted.select("path").distinct().select("path", F.row_number().over(Window.orderBy("path")).alias("file"))
    return parity.join(files, "path").select("path", "block", "file", "place", (F.col("place") == 1).alias("leading"), "opened")


def _pieces(quote: str):
    """Rows and pieces of rows from the lines of blocks, each block in order.

    ``row`` is a whole row and ``first`` one that begins a file; ``head`` is what
    precedes the first row that begins in the block, ``tail`` a row that does
    not end in it, ``middle`` a block inside one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, inside, begun, first, out = None, [], False, True, False, []

        def flush():
            if held:
                out.append((*block, ("tail" if begun else "middle") if inside else ("row" if begun else "head"), "\n".join(held)))
                held.clear()

        for batch in batches:
            for file, place, leading, opened, value in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (file, place) != block:
                    flush()
                    block, inside, begun, first = (file, place), opened, not opened, leading
                held.append(value)
                if value.count(quote) % 2:
                    inside = not inside
                if not inside:
                    out.append((*block, "first" if first else "row" if begun else "head", "\n".join(held)))
                    held.clear()
                    begun, first = True, False
                if len(out) >= 4096:
                    yield _batch(out)
                    out.clear()
        flush()
        yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 4
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _NAMES)


def _shared_rows(pieces: DataFrame) -> DataFrame:
    """Rows that several blocks share, from their pieces: a tail, the blocks inside it, and the head that ends it."""
    order = Window.partitionBy("file").orderBy("place", F.when(F.col("kind") == "tail", 1).otherwise(0))
    parts = pieces.withColumn("row", F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(order))
    ordered = F.array_sort(F.collect_list(F.struct("place", "text")))
    whole = parts.groupBy("file", "row").agg(ordered.alias("parts"))
    return whole.select("file", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))


def read_rows(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """``(file, first, text)``: the text of every row, ``first`` for the one that begins a file."""
    lines = _lines(spark, path)
    # One row a block, looked up where the lines are read, so they stay in order.
    blocks = F.broadcast(settled(block_parity(lines, quote), "blocks"))
    marked = lines.join(blocks, ["path", "block"]).select("file", "place", "leading", "opened", "value")
    pieces = settled(marked.mapInArrow(_pieces(quote), _PIECES), "pieces")
    kind = F.col("kind")
    whole = pieces.filter(kind.isin("row", "first")).select("file", (kind == "first").alias("first"), "text")
    shared = _shared_rows(pieces.filter(kind.isin("head", "middle", "tail"))).select("file", F.lit(False).alias("first"), "text")
    rows = whole.unionByName(shared)
    return rows.withColumn("text", F.regexp_replace("text", r"\r\z", "")).filter("first OR text <> ''")


def read_foreign_csv(
    spark: SparkSession, path: str, schema: StructType | str, *, header: bool = True, separator: str = ",", quote: str = '"'
) -> DataFrame:
    """Rows of other programs' CSV files, cast to ``schema``; text that does not parse is NULL.

    With ``header`` columns are chosen by the names in each file's first row,
    in whatever order that file has them; a column a file lacks is NULL. Without
    it they are named by position. Files are read when this is called.
    """
    fields = (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).fields
    rows = read_rows(spark, path, quote)
    options = {"sep": separator, "quote": quote, "escape": quote, "emptyValue": _EMPTY, "maxCharsPerColumn": "-1"}

    def parsed(names: list[str]):
        """The wanted columns of a row whose fields are ``names``, as texts."""
        raw = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
        row = F.from_csv("text", raw.simpleString(), options)
        found = [row[f"c{names.index(field.name)}"] if field.name in names else F.lit(None).cast("string") for field in fields]
        return F.struct(*[value.alias(field.name) for value, field in zip(found, fields)])

    if header:
        heads = rows.filter("first").select("file", F.regexp_replace("text", "^﻿", "").alias("head"))
        texts = [r["head"] for r in heads.select("head").distinct().limit(MAX_HEADERS + 1).collect()]
        if len(texts) > MAX_HEADERS:
            raise ValueError(f"files with more than {MAX_HEADERS} different headers")
        row = F.lit(None)
        for text in texts:
            names = next(csv.reader([text], delimiter=separator, quotechar=quote), [])
            row = F.when(F.col("head") == text, parsed(names)).otherwise(row)
        rows = rows.filter("NOT first").join(F.broadcast(heads), "file") if texts else rows.filter("NOT first")
        rows = rows.select((row if texts else parsed([])).alias("row"))
    else:
        rows = rows.filter("text <> ''").select(parsed([field.name for field in fields]).alias("row"))

    def typed(field: StructField):
        value = F.when(F.col(f"row.`{field.name}`") == _EMPTY, "").otherwise(F.col(f"row.`{field.name}`"))
        return (value if isinstance(field.dataType, StringType) else value.try_cast(field.dataType)).alias(field.name)

    return rows.select(*[typed(field) for field in fields])
