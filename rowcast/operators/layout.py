"""How a table lies in its files, told by Spark's own columns about every row's file.

The hidden ``_metadata`` column gives the file of a row, its size, and the
block of it that the task reads. Only that column is read, so the profile costs
little more than opening the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def blocks(table: DataFrame) -> DataFrame:
    """Per file and block that a task reads: start, length, rows, and the file's bytes. ``table`` is a scan of files."""
    facts = [F.col(f"_metadata.{name}").alias(name) for name in ("file_path", "file_size", "file_block_start", "file_block_length")]
    keys = ["file_path", "file_size", "file_block_start", "file_block_length"]
    rows = table.select(*facts).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(
        "file_path", F.col("file_size").alias("file_bytes"), F.col("file_block_start").alias("block_start"),
        F.col("file_block_length").alias("block_bytes"), "rows",
    )


def files(table_blocks: DataFrame, *keep: str) -> DataFrame:
    """Per file: bytes, rows, blocks with rows, and whether those blocks lie within it without overlap.

    A block in which no row group begins has no rows and is not seen.
    """
    grouped = table_blocks.groupBy("file_path", "file_bytes", *keep).agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("blocks"),
        F.array_sort(F.collect_list(F.struct("block_start", "block_bytes"))).alias("parts"),
    )
    # A file has one block per task that reads it.
    apart = F.expr(
        "aggregate(parts, named_struct('to', 0L, 'ok', true), "
        "(s, p) -> named_struct('to', p.block_start + p.block_bytes, 'ok', s.ok and p.block_start >= s.to), s -> s.ok and s.to <= file_bytes)"
    )
    return grouped.select("file_path", "file_bytes", *keep, "rows", "blocks", apart.alias("in_one_piece"))


def balance(table_blocks: DataFrame) -> DataFrame:
    """One row over all blocks: files, blocks, rows, and the rows of the smallest, middle and largest block."""
    return table_blocks.agg(
        F.count_distinct("file_path").alias("files"),
        F.count(F.lit(1)).alias("blocks"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.min("rows").alias("smallest"),
        F.percentile_approx("rows", 0.5).alias("middle"),
        F.max("rows").alias("largest"),
    )
