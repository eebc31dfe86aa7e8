"""The registered queries: each operator over its whole table, as ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.llm.common import table
from rowcast.llm import decontaminate, hamming, hard_negatives, token_index, warc
from rowcast.llm.conversation_trie import ORACLE as TRIE_ORACLE
from rowcast.llm.conversation_trie import conversation_trie
from rowcast.llm.divergence import judged
from rowcast.llm.hilbert import hilbert_shards
from rowcast.llm.licenses import scan_licenses
from rowcast.llm.line_crf import graded
from rowcast.llm.near_dedup import near_duplicates
from rowcast.llm.packing import pack
from rowcast.llm.pseudonyms import pseudonymized
from rowcast.llm.tokens import vocabulary
from rowcast.plans.scratch import scratch_path

# The key of the example queries; a user passes a secret of their own.
EXAMPLE_KEY = "example-key"


def op1_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document and its place in a sequence."""
    return pack(table(spark, folder, "documents"), vocabulary())


def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds three quarters of a benchmark item, with the item."""
    return decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_warc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written as a WARC record in chunks and read back."""
    path = scratch_path(spark, "archive")
    warc.write_archive(table(spark, folder, "pages"), path)
    return warc.read_archive(spark, path)


def op4_line_crf_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, learned from labels that are not held out."""
    return graded(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Component and keep decision of every document."""
    return near_duplicates(table(spark, folder, "documents"))


def op6_multi_index_hamming(spark: SparkSession, folder: str) -> DataFrame:
    """Ten nearest codes of every row whose id is divisible by 20, among all rows."""
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), hamming.checked_code("embedding").alias("code"))
    return hamming.nearest(rows, rows.filter("id % 20 = 0"))


def op7_hilbert_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document in the order of a Hilbert curve."""
    return hilbert_shards(table(spark, folder, "documents"))


def op8_license_automaton(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases, labels and score of every document."""
    return scan_licenses(table(spark, folder, "documents"), with_spans=False)


def op9_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text with pseudonyms, and how many values of each kind it had."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pseudonymized(docs, EXAMPLE_KEY)


def op10_token_index(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids written, found again by key through the index, and read back."""
    docs = table(spark, folder, "documents")
    path = scratch_path(spark, "token_store")
    token_index.write_store(docs, path, vocabulary())
    return token_index.read_by_key(spark, path, token_index.keys_of(docs)).withColumnRenamed("id", "doc_id")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return conversation_trie(table(spark, folder, "conversations"), rebuild=True)


def op12_divergence_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base measures of every document and the verdict of its distances to the language references."""
    return judged(table(spark, folder, "documents"))


def op13_secondary_sort_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Ten hard negatives for each of five positives of every row whose id is divisible by 100."""
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (bigint(label) + 1) % 10 ELSE label END")
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), label.cast("int").alias("label"), hard_negatives.quantised("embedding").alias("code")
    )
    return hard_negatives.hard_negatives(rows, "id % 100 = 0")


QUERIES = {
    "op1_harmonic_packing": op1_harmonic_packing,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_warc_chunks": op3_warc_chunks,
    "op4_line_crf_quality": op4_line_crf_quality,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_multi_index_hamming": op6_multi_index_hamming,
    "op7_hilbert_sharding": op7_hilbert_sharding,
    "op8_license_automaton": op8_license_automaton,
    "op9_pii_pseudonyms": op9_pii_pseudonyms,
    "op10_token_index": op10_token_index,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_divergence_rules": op12_divergence_rules,
    "op13_secondary_sort_negatives": op13_secondary_sort_negatives,
}

ORACLE = {
    "op2_benchmark_decontamination": decontaminate.ORACLE,
    "op6_multi_index_hamming": hamming.ORACLE,
    "op11_prefix_trie": TRIE_ORACLE,
    "op13_secondary_sort_negatives": hard_negatives.ORACLE,
}
