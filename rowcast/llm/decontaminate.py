"""Benchmark decontamination by size-partitioned MinHash containment search.

Short test items are looked for inside documents of any length. Jaccard
similarity says nothing there, so the search goes by containment: a document
is reported for an item if it holds at least ``share`` percent of the item's
distinct five-word shingles.

Items are parted by size (powers of two of their number of shingles), and every
part has sketches of its own length: the MinHash prefix of ``k`` shingles of
smallest hash, with ``k`` one more than the largest item of the part may lack.
A document that lacks no more than those must hold one of the ``k``, so nothing
is lost. A sketch entry is one row with the fewest shingles that an item posted
under it needs; a document meets it only if it is at least as large. Documents
that meet a sketch are read again, and the whole sets are compared by shingle
text.

What a document holds is a matter of its text alone, so texts are compared, each
once however many rows have it, and every row is reported for what its own text
holds: rows of one id do not add up, and rows without an id are reported too.

Words are runs of letters and digits, lower-cased, so punctuation and layout
do not hide a passage. An item of fewer than five words is looked for as one
run of its words. Items or documents without words and items without an id are
never reported; of rows with one item id the best counts. Other columns of
either table are not looked at.

Only DataFrame functions run here. Sketches and item sets are broadcast when
their rows and bytes were counted small, otherwise joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowcast.llm.common import small_side, stored

WIDTH = 5
SHARE = 75


def words(text: Column) -> Column:
    cut = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(cut, "")


def _runs(width: int, what) -> Column:
    """``what`` applied to every run of ``width`` words of column ``words``."""
    count = F.size("words")
    places = F.sequence(F.lit(1), count - (width - 1))
    runs = F.transform(places, lambda i: what(F.slice("words", i, F.lit(width))))
    return F.when(count >= width, runs).otherwise(F.array().cast("array<string>" if what is _joined else "array<bigint>"))


def _joined(run: Column) -> Column:
    return F.array_join(run, " ")


def _hashed(run: Column) -> Column:
    return F.xxhash64(run)


def _all_runs(widths: list[int], what) -> Column:
    return F.flatten(F.array(*[_runs(width, what) for width in widths]))


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per distinct item: key, item, width, texts and hashes of its distinct shingles."""
    own = items.select(F.col(id_col).cast("long").alias("item"), words(F.col(text_col)).alias("words"))
    own = own.filter("item IS NOT NULL AND size(words) > 0").distinct()
    width = F.least(F.size("words"), F.lit(WIDTH))
    places = F.sequence(F.lit(1), F.size("words") - (width - 1))
    texts = F.array_distinct(F.transform(places, lambda i: F.array_join(F.slice("words", i, width), " ")))
    hashes = F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.slice("words", i, width))))
    return own.select(
        F.xxhash64("item", "words").alias("key"), "item", width.alias("width"), texts.alias("texts"), hashes.alias("hashes")
    )


def _log2(count: Column) -> Column:
    return F.length(F.bin(count.cast("long"))) - 1


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    share: int = SHARE,
) -> DataFrame:
    """``(doc_id, item_id, n_item, n_shared)`` of every row of ``docs`` whose text holds enough of an item."""
    tests = stored(_items(items, item_id_col, item_text_col), "items")
    widths = sorted(row[0] for row in tests.select("width").distinct().collect())  # five at most
    text = F.col(text_col).cast("string")
    key = [F.xxhash64(text).alias("text_a"), F.hash(text).alias("text_b")]
    texts = docs.filter(text.isNotNull()).select(*key, words(text).alias("words"))
    if not widths:
        nothing = F.lit(0).cast("long")
        return tests.select(nothing.alias(id_col), F.col("item").alias(item_id_col), nothing.alias("n_item"), nothing.alias("n_shared")).limit(0)

    need = F.ceil(F.size("hashes") * F.lit(share) / F.lit(100)).cast("int")
    sized = tests.select("hashes", need.alias("need"), _log2(F.size("hashes")).alias("part"))
    lengths = sized.groupBy("part").agg(F.max(F.size("hashes") - F.col("need") + 1).alias("k"))
    sketch = sized.join(F.broadcast(lengths), "part").select("need", F.slice(F.array_sort("hashes"), F.lit(1), F.col("k")).alias("sketch"))
    sketch = sketch.select("need", F.explode("sketch").alias("hash")).groupBy("hash").agg(F.min("need").alias("need"))
    runs = texts.select("text_a", "text_b", _all_runs(widths, _hashed).alias("runs"))
    # Outer, or the planner tests the array's size below and computes words for every run.
    posted = runs.select("text_a", "text_b", F.size("runs").alias("held"), F.explode_outer("runs").alias("hash"))
    entries = small_side(stored(sketch.withColumnRenamed("hash", "entry"), "entries"))
    met = posted.join(entries, (F.col("hash") == F.col("entry")) & (F.col("held") >= F.col("need")), "left_semi")
    met = stored(met.select("text_a", "text_b").distinct(), "met")

    full = tests.select("key", "item", F.size("texts").cast("long").alias("n_item"), F.explode("texts").alias("run"))
    again = texts.join(small_side(met), ["text_a", "text_b"], "left_semi").dropDuplicates(["text_a", "text_b"])
    held = again.select("text_a", "text_b", F.explode_outer(F.array_distinct(_all_runs(widths, _joined))).alias("run"))
    shared = (
        held.join(small_side(full), "run")
        .groupBy("text_a", "text_b", "key", "item", "n_item")
        .agg(F.count_distinct("run").alias("n_shared"))
        .filter(F.col("n_shared") * 100 >= F.col("n_item") * share)
    )
    best = shared.groupBy("text_a", "text_b", "item").agg(
        F.max_by(F.struct("n_item", "n_shared"), F.struct(F.col("n_shared") / F.col("n_item"), "n_item")).alias("best")
    )
    found = stored(best.select("text_a", "text_b", F.col("item").alias(item_id_col), "best.n_item", "best.n_shared"), "found")
    rows = docs.filter(text.isNotNull()).select(F.col(id_col).cast("long").alias(id_col), *key)
    return rows.join(small_side(found), ["text_a", "text_b"]).select(id_col, item_id_col, "n_item", "n_shared")


def clean_rows(docs: DataFrame, items: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no item; rows of one text stay or go together."""
    numbered = docs.select(F.col(text_col).alias("text")).select(F.xxhash64("text").alias("id"), "text")
    found = contained_items(numbered, items, id_col="id", text_col="text", **options).select("id").distinct()
    marked = docs.withColumn("_text_id", F.xxhash64(F.col(text_col)))
    found = stored(found.withColumnRenamed("id", "_text_id"), "contaminated")
    return marked.join(small_side(found), "_text_id", "left_anti").select(docs.columns)


ORACLE = r"""
WITH d AS (
    SELECT row_number() OVER () AS doc, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
    FROM documents
), i AS (
    SELECT item_id AS item, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
    FROM benchmark WHERE item_id IS NOT NULL
), item_runs AS (
    SELECT DISTINCT item, unnest(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) AS run
    FROM i WHERE len(w) >= 5
), doc_runs AS (
    SELECT DISTINCT doc, doc_id, unnest(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) AS run
    FROM d WHERE len(w) >= 5
), sizes AS (
    SELECT item, count(*) AS n_item FROM item_runs GROUP BY item
), met AS (
    SELECT doc, doc_id, item, count(*) AS n_shared FROM doc_runs JOIN item_runs USING (run) GROUP BY doc, doc_id, item
)
SELECT doc_id, item AS item_id, n_item, n_shared
FROM met JOIN sizes USING (item)
WHERE n_shared * 100 >= n_item * 75
"""
