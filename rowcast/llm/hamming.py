"""Exact top-k search over binary codes by incremental multi-index hashing.

A code of 64 bits is cut into ``SEGMENTS`` segments, and every segment has an
inverted index from its value to the codes. Two codes within distance ``d``
agree in some segment up to ``d // SEGMENTS`` bits. So round ``r`` looks up,
for every query still open, the segment values at exactly ``r`` flipped bits,
verifies the codes found there and keeps the best; after it every code within
``SEGMENTS * (r + 1) - 1`` is known. A query closes as soon as its k-th
verified distance is covered that way; nothing is approximate.

The index is dealt into cells by segment and leading bits of the value, and
large cells into chunks, so a query visits few cells and a task holds a
bounded number of codes however skewed they are. Equal codes are one entry
with their ``k + 1`` smallest ids, which is all that a top-k can use.

A row's neighbours are the ``k`` other rows of smallest distance, smaller ids
first among equals. Rows without an id or a code take no part, not as queries
either; rows of one id count as one per distinct code. A table of fewer rows
gives fewer neighbours, an empty one none. Vectors of more than 64 dimensions
have no code; ``checked_code``, which the registered query takes, refuses them.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowcast.llm.common import small_side, stored

SEGMENTS = 4
SEGMENT_BITS = 16
LEAD_BITS = 6
CELL_CODES = 65_536
K = 10


def sign_code(vector: str) -> Column:
    """One bit per dimension, set where the value is above zero; up to 64 dimensions."""
    bits = f"transform({vector}, (x, i) -> if(x > 0, shiftleft(1L, i), 0L))"
    code = F.expr(f"aggregate({bits}, 0L, (s, x) -> s | x)")
    return F.when(F.size(vector) <= 64, code)


def checked_code(vector: str) -> Column:
    """The same, but an error for vectors that have no code for being too wide."""
    wide = F.concat(F.lit("codes hold 64 dimensions, a vector has "), F.size(vector).cast("string"))
    return F.when(F.size(vector) > 64, F.raise_error(wide)).otherwise(sign_code(vector))


def _masks(bits: int, weight: int) -> np.ndarray:
    """All numbers of ``bits`` bits of which ``weight`` are set."""
    return np.array([sum(1 << bit for bit in own) for own in combinations(range(bits), weight)], np.int64)


def _segments(frame: DataFrame) -> DataFrame:
    """One row per segment with its ``lead`` and ``low`` bits."""
    low_bits = SEGMENT_BITS - LEAD_BITS
    cut = frame.withColumn("segment", F.explode(F.array(*[F.lit(i) for i in range(SEGMENTS)])))
    value = F.expr(f"cast(shiftrightunsigned(code, segment * {SEGMENT_BITS}) & {2**SEGMENT_BITS - 1} AS int)")
    cut = cut.withColumn("value", value)
    return cut.withColumn("lead", F.shiftright("value", low_bits)).withColumn("low", F.col("value").bitwiseAND(2**low_bits - 1)).drop("value")


def _probe(radius: int, k: int):
    """A round's work in one cell: queries against the cell's codes."""
    low_bits = SEGMENT_BITS - LEAD_BITS
    room = 2_000_000

    def probe(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        names = {"query": "int64", "code": "int64", "distance": "int32", "least": "int64"}
        if not len(asked) or not len(held):
            return pd.DataFrame({name: [] for name in names}).astype(names)
        held = held.sort_values("low", kind="stable")
        codes, least = held["code"].to_numpy(np.int64), held["least"].to_numpy(np.int64)
        starts = np.searchsorted(held["low"].to_numpy(), np.arange(2**low_bits + 1))
        out = []
        for flipped, group in asked.groupby("flipped"):
            masks = _masks(low_bits, radius - int(flipped))
            query, low, bound = (group[name].to_numpy(np.int64) for name in ("code", "low", "bound"))
            step = max(1, int(room // max(1, len(masks) * max(1, len(codes) >> low_bits))))
            for at in range(0, len(query), step):
                own = slice(at, at + step)
                values = (low[own, None] ^ masks[None, :]).ravel()
                who = np.repeat(np.arange(at, min(at + step, len(query))), len(masks))
                count = starts[values + 1] - starts[values]
                spots = np.repeat(starts[values] - np.cumsum(count) + count, count) + np.arange(count.sum())
                who = np.repeat(who, count)
                distance = np.bitwise_count((query[who] ^ codes[spots]).view(np.uint64)).astype(np.int64)
                good = distance <= bound[who]
                who, spots, distance = who[good], spots[good], distance[good]
                # Only a cell's best k + 1 of a query can be among the best of all.
                order = np.lexsort((least[spots], distance, who))
                who, spots, distance = who[order], spots[order], distance[order]
                first = np.searchsorted(who, who, "left")
                best = np.arange(len(who)) - first <= k
                out.append(pd.DataFrame({"query": query[who[best]], "code": codes[spots[best]], "distance": distance[best], "least": least[spots[best]]}))
        return pd.concat(out).astype(names)

    return probe


def nearest(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``(query_id, neighbor_id, distance, rank)`` for ``queries(id, code)`` among ``rows(id, code)``."""
    known = rows.filter("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct()
    place = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    few = known.withColumn("place", place).filter(F.col("place") <= k + 1)
    entries = stored(few.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "entries")
    index = _segments(entries.select("code", F.col("ids")[0].alias("least")))
    counts = index.groupBy("segment", "lead").agg(F.ceil(F.count(F.lit(1)) / CELL_CODES).cast("int").alias("chunks"))
    counts = stored(counts, "cells")  # at most SEGMENTS * 2^LEAD_BITS rows
    chunk = F.pmod(F.xxhash64("code"), F.col("chunks")).cast("int")
    index = index.join(small_side(counts), ["segment", "lead"]).withColumn("chunk", chunk)
    index = stored(index.select("segment", "lead", "chunk", "low", "code", "least"), "index")

    asked = queries.filter("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct()
    open_queries = stored(asked.select("code").distinct().withColumn("bound", F.lit(64)), "open")
    found = done = None
    low_bits = SEGMENT_BITS - LEAD_BITS
    for radius in range(SEGMENT_BITS + 1):
        masks = [(w, m) for w in range(max(0, radius - low_bits), min(radius, LEAD_BITS) + 1) for m in _masks(LEAD_BITS, w).tolist()]
        flips = F.array(*[F.struct(F.lit(w).alias("flipped"), F.lit(m).alias("mask")) for w, m in masks])
        dealt = _segments(open_queries).withColumn("flip", F.explode(flips))
        dealt = dealt.withColumn("lead", F.col("lead").bitwiseXOR(F.col("flip.mask"))).withColumn("flipped", F.col("flip.flipped"))
        dealt = dealt.join(small_side(counts), ["segment", "lead"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        cells = ["segment", "lead", "chunk"]
        met = (
            dealt.select(*cells, "code", "low", "bound", "flipped").groupBy(*cells)
            .cogroup(index.groupBy(*cells))
            .applyInPandas(_probe(radius, k), "query long, code long, distance int, least long")
        )
        if found is not None:
            met = met.unionByName(found)
        rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "least"))
        best = stored(met.distinct().withColumn("rank", rank).filter(F.col("rank") <= k + 1).drop("rank"), "best")
        state = best.groupBy("query").agg(F.count(F.lit(1)).alias("hits"), F.max("distance").alias("far"))
        full = F.coalesce(F.col("hits"), F.lit(0)) == k + 1
        state = open_queries.select("code").join(state.withColumnRenamed("query", "code"), "code", "left")
        state = stored(state.select("code", F.when(full, F.col("far")).otherwise(64).alias("bound"), full.alias("full")), "state")
        covered = F.col("full") & (F.col("bound") <= SEGMENTS * (radius + 1) - 1) | F.lit(radius == SEGMENT_BITS)
        closed = best.join(state.filter(covered).select(F.col("code").alias("query")), "query", "left_semi")
        done = closed if done is None else done.unionByName(closed)
        open_queries = state.filter(~covered).select("code", "bound")
        if not open_queries.limit(1).count():
            break
        found = best.join(open_queries.select(F.col("code").alias("query")), "query", "left_semi")

    hits = done.join(entries, "code").select(F.col("query").alias("code"), "distance", F.explode("ids").alias("neighbor_id"))
    pairs = asked.withColumnRenamed("id", "query_id").join(hits, "code").filter("query_id <> neighbor_id")
    # An id with several codes counts with its nearest.
    pairs = pairs.groupBy("query_id", "neighbor_id").agg(F.min("distance").alias("distance"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbor_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "neighbor_id", "distance", "rank")


ORACLE = """
WITH codes AS (
    SELECT vec_id AS id,
           list_sum(list_transform(range(0, len(embedding)), lambda i: CASE WHEN embedding[i + 1] > 0 THEN 1::HUGEINT << i::INT ELSE 0::HUGEINT END))::HUGEINT AS code
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), pairs AS (
    SELECT q.id AS query_id, r.id AS neighbor_id, bit_count(xor(q.code, r.code))::INT AS distance
    FROM codes q JOIN codes r ON q.id <> r.id
    WHERE q.id % 20 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)::INT AS rank FROM pairs
)
SELECT query_id, neighbor_id, distance, rank FROM ranked WHERE rank <= 10
"""
