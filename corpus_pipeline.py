"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``; the last returns the packed pieces
with their ids. Every row is decided by its own text, never by its id, so rows
without an id and rows that share one are treated like all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.llm.common import stored, table
from rowcast.llm.decontaminate import clean_rows
from rowcast.llm.line_crf import THRESHOLD, fit_quality, quality_scores
from rowcast.llm.near_dedup import near_duplicates
from rowcast.llm.packing import pack
from rowcast.llm.pseudonyms import pseudonymized
from rowcast.llm.queries import EXAMPLE_KEY
from rowcast.llm.tokens import vocabulary


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model scores at least at the threshold."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality_scores(docs, model).filter(f"score >= {THRESHOLD}").select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near copies: the one with the smallest id, of several the first in the scan."""
    # Positions in the scan of a stored table are the same every time it is read.
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    classes = stored(near_duplicates(rows.select("_row", "text"), id_col="_row"), "classes")
    grouped = classes.join(classes.filter("NOT kept").select("component_id").distinct(), "component_id", "left_semi")
    named = stored(rows.select("_row", "doc_id").join(grouped.select("_row", "component_id"), "_row"), "grouped")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))["_row"].alias("first"))
    dropped = named.join(first, "component_id").filter("_row <> first").select("_row")
    return rows.join(dropped, "_row", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return clean_rows(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms; lengths stay, so ``n_chars`` stays right."""
    return pseudonymized(docs, EXAMPLE_KEY, counts=False).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return pack(docs, vocabulary(), with_ids=True)


STAGES = [
    ("quality", drop_low_quality),
    ("near_dedup", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("pii", replace_personal_data),
    ("packing", pack_sequences),
]

# The stages learn weights, compare sets and hash with a key; SQL cannot state them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
