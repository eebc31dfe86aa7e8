"""Token files with a minimal perfect hash index from document keys to shard offsets.

A store is a folder of two tables of binary rows, written by Spark's committer
so that repeated tasks leave nothing behind:

``payload``  one row per block: shard, block, ``first`` (the shard's ids before
             it), documents' keys and lengths, and the raw ids as little-endian
             unsigned 32-bit integers. Documents ascend by id over shards,
             blocks and places; ids of NULL come first. A block closes at
             ``BLOCK_BYTES``; a document is never cut, so a longer one is a
             block of its own.
``index``    one row per hash bucket of about ``BUCKET_KEYS`` keys: a minimal
             perfect hash of the bucket's keys and one slot per key with a
             32-bit fingerprint, shard, offset in ids, and length.

The hash has levels of bits. A key that alone maps to a bit of a level owns
it; keys that meet go on to the next level. A key's slot is the number of bits
set before its own, so slots are numbered without gaps, and finding one takes
a fixed number of steps on average. A key that was never stored is told by its
fingerprint with a chance of error of 2^-32.

Rows of one id are stored each, under the key (id, copy) with copies counted
from 0. NULL and empty texts hold the end id alone. An empty table gives an
empty store. Other columns are not looked at. Rows should come from a scan.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowcast.llm.common import small_side, stored
from rowcast.llm.shingles import mix
from rowcast.llm.tokens import encoder, text_groups

BLOCK_BYTES = 1 << 20
BUCKET_KEYS = 16_384
ROOM = 1.6
LEVELS = 48
_U = np.uint64
_PAYLOAD = "shard int, block int, first long, missing int, keys binary, lengths binary, payload binary"


def _level_places(first: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = mix(np.array([level + 1], np.uint64))[0]
    return (mix(mix(first ^ seed) + second) % _U(size)).astype(np.int64)


def build_hash(first: np.ndarray, second: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels of bits and each key's slot, for distinct keys of two 64-bit halves."""
    left, levels, slots, taken = np.arange(len(first)), [], np.zeros(len(first), np.int64), 0
    while len(left):
        if len(levels) == LEVELS:
            raise ValueError("keys are not distinct")
        size = max(64, int(ROOM * len(left)))
        places = _level_places(first[left], second[left], len(levels), size)
        bits = np.bincount(places, minlength=size) == 1
        own = bits[places]
        rank = np.cumsum(bits) - 1
        slots[left[own]] = taken + rank[places[own]]
        taken += int(bits.sum())
        levels.append(bits)
        left = left[~own]
    return levels, slots


def find_slots(levels: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Slots of keys; -1 for keys that no level knows."""
    slots, left, taken = np.full(len(first), -1, np.int64), np.arange(len(first)), 0
    for level, bits in enumerate(levels):
        places = _level_places(first[left], second[left], level, len(bits))
        own = bits[places]
        rank = np.cumsum(bits) - 1
        slots[left[own]] = taken + rank[places[own]]
        taken += int(bits.sum())
        left = left[~own]
    return slots


def _packed(levels, prints, shard, offset, length) -> bytes:
    head = struct.pack("<4sII", b"MPH1", len(levels), len(prints))
    sizes = np.array([len(bits) for bits in levels], "<u4").tobytes()
    bits = b"".join(np.packbits(bits).tobytes() for bits in levels)
    slots = (prints.astype("<u4"), shard.astype("<u4"), offset.astype("<u8"), length.astype("<u8"))
    return head + sizes + bits + b"".join(part.tobytes() for part in slots)


def _unpacked(blob: bytes):
    magic, count, keys = struct.unpack_from("<4sII", blob)
    if magic != b"MPH1":
        raise ValueError("not an index")
    at = 12 + 4 * count
    sizes, levels = np.frombuffer(blob, "<u4", count, 12), []
    for size in sizes.tolist():
        width = (size + 7) // 8
        levels.append(np.unpackbits(np.frombuffer(blob, np.uint8, width, at), count=size).astype(bool))
        at += width
    out = []
    for kind in ("<u4", "<u4", "<u8", "<u8"):
        out.append(np.frombuffer(blob, kind, keys, at))
        at += out[-1].nbytes
    return levels, *out


def _hashes(keys: DataFrame) -> DataFrame:
    """``first`` and ``second``: 128 bits of (id, copy)."""
    name = F.coalesce(F.col("id").cast("string"), F.lit("-"))
    return keys.withColumn("first_half", F.xxhash64(name, "copy")).withColumn("second_half", F.xxhash64(F.lit("second"), "copy", name))


def _write_payload(docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str, text_col: str) -> None:
    end = int(end_id).to_bytes(4, "little")
    names = [part.split()[0] for part in _PAYLOAD.split(", ")]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def fill(batches):
        from pyspark import TaskContext

        shard, block, first = TaskContext.get().partitionId(), 0, 0
        words = encoder(vocabulary)
        keys, held, size = [], [], 0

        def closed():
            nonlocal keys, held, size, block, first
            missing = sum(key is None for key in keys)
            lengths = np.array([len(ids) // 4 for ids in held], "<u8")
            row = (shard, block, first, missing, np.array([k for k in keys if k is not None], "<i8").tobytes(), lengths.tobytes(), b"".join(held))
            first, block = first + int(lengths.sum()), block + 1
            keys, held, size = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        for batch in batches:
            own = batch.column(0).to_pylist()
            for part, texts in text_groups(batch.column(1)):
                for key, ids in zip(own[part], words.encode_many(texts)):
                    keys.append(key)
                    held.append(ids + end)
                    size += len(ids) + 4
                    if size >= BLOCK_BYTES:
                        yield closed()
        if keys:
            yield closed()

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.withColumn("place", F.monotonically_increasing_id())
    order = [F.col("id").asc_nulls_first(), F.col("place")]
    ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    rows = ordered.mapInArrow(fill, _PAYLOAD)
    rows.write.mode("overwrite").option("parquet.block.size", 16 << 20).parquet(f"{path}/payload")


def _payload(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_PAYLOAD).parquet(f"{path}/payload")


def _entries(spark: SparkSession, path: str) -> DataFrame:
    """``(id, copy, shard, offset, length)`` of every stored document, from keys and lengths alone."""

    def spread(batches):
        for batch in batches:
            for shard, block, first, missing, keys, lengths in zip(*(column.to_pylist() for column in batch.columns)):
                length = np.frombuffer(lengths, "<u8").astype(np.int64)
                key = np.frombuffer(keys, "<i8")
                ids = pa.array([None] * missing + key.tolist(), pa.int64())
                count = len(length)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.full(count, shard, np.int32)),
                        pa.array(np.full(count, block, np.int32)),
                        pa.array(np.arange(count, dtype=np.int32)),
                        pa.array(first + np.cumsum(length) - length),
                        pa.array(length),
                    ],
                    ["id", "shard", "block", "slot", "offset", "length"],
                )

    narrow = _payload(spark, path).select("shard", "block", "first", "missing", "keys", "lengths")
    # Written once, or every consumer below would unpack the payload's keys again.
    rows = stored(narrow.mapInArrow(spread, "id long, shard int, block int, slot int, offset long, length long"), "documents")
    # Copies of an id lie next to each other; most ids have one. Only ids that
    # repeat are numbered, per shard and then over shards.
    counts = rows.groupBy("id", "shard").agg(F.count(F.lit(1)).alias("rows"))
    many = counts.groupBy("id").agg(F.sum("rows").alias("all")).filter("all > 1").select("id")
    before = Window.partitionBy("id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("id").eqNullSafe(F.col("other"))
    many = many.withColumnRenamed("id", "other").withColumn("mark", F.lit(True))
    base = counts.join(many, same).drop("other", "mark").withColumn("base", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    base = base.select(F.col("id").alias("other"), F.col("shard").alias("in_shard"), "base", F.lit(True).alias("mark"))
    marked = rows.join(small_side(stored(base, "repeated")), same & (F.col("shard") == F.col("in_shard")), "left")
    within = Window.partitionBy("id", "shard").orderBy("block", "slot")
    single = marked.filter("mark IS NULL").withColumn("copy", F.lit(0).cast("long"))
    repeated = marked.filter("mark").withColumn("copy", F.col("base") + F.row_number().over(within) - 1)
    kept = ["id", "copy", "shard", "offset", "length"]
    return single.select(kept).unionByName(repeated.select(kept))


def write_store(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    *,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_keys: int = BUCKET_KEYS,
) -> None:
    """Write the payload of ``docs`` and its index under ``path``."""
    spark = docs.sparkSession
    _write_payload(docs, path, vocabulary, end_id, id_col, text_col)
    entries = stored(_hashes(_entries(spark, path)), "entries")
    buckets = max(1, -(-entries.count() // bucket_keys))
    bucket = F.pmod(F.col("first_half"), F.lit(buckets)).cast("int")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        first = group["first_half"].to_numpy(np.int64).view(np.uint64)
        second = group["second_half"].to_numpy(np.int64).view(np.uint64)
        levels, slots = build_hash(first, second)
        order = np.argsort(slots)
        prints = (mix(second ^ first) >> _U(32))[order]
        columns = [group[name].to_numpy()[order] for name in ("shard", "offset", "length")]
        return pd.DataFrame({"bucket": [int(group["bucket"].iat[0])], "buckets": [buckets], "blob": [_packed(levels, prints, *columns)]})

    rows = entries.withColumn("bucket", bucket).select("bucket", "first_half", "second_half", "shard", "offset", "length")
    built = rows.groupBy("bucket").applyInPandas(build, "bucket int, buckets int, blob binary")
    built.write.mode("overwrite").parquet(f"{path}/index")


def locate(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """``(id, copy, shard, offset, length)`` of those ``keys(id, copy)`` that are stored."""
    index = spark.read.schema("bucket int, buckets int, blob binary").parquet(f"{path}/index")
    count = index.agg(F.max("buckets")).first()[0] or 1
    wanted = _hashes(keys.select("id", "copy")).withColumn("bucket", F.pmod(F.col("first_half"), F.lit(count)).cast("int"))
    # A pandas column with a NULL would turn into floats, which large ids do not survive.
    wanted = wanted.withColumn("named", F.col("id").isNotNull()).withColumn("id", F.coalesce("id", F.lit(0).cast("long")))

    def look(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        names = ["named", "id", "copy", "shard", "offset", "length"]
        if not len(asked) or not len(held):
            return pd.DataFrame({name: [] for name in names})
        levels, prints, shard, offset, length = _unpacked(held["blob"].iat[0])
        first = asked["first_half"].to_numpy(np.int64).view(np.uint64)
        second = asked["second_half"].to_numpy(np.int64).view(np.uint64)
        slots = find_slots(levels, first, second)
        good = slots >= 0
        good[good] = prints[slots[good]] == (mix(second ^ first) >> _U(32))[good]
        slots = slots[good]
        return pd.DataFrame(
            {
                "named": asked["named"].to_numpy()[good], "id": asked["id"].to_numpy(np.int64)[good],
                "copy": asked["copy"].to_numpy()[good], "shard": shard[slots].astype(np.int32),
                "offset": offset[slots].astype(np.int64), "length": length[slots].astype(np.int64),
            }
        )

    both = wanted.groupBy("bucket").cogroup(index.select("bucket", "blob").groupBy("bucket"))
    found = both.applyInPandas(look, "named boolean, id long, copy long, shard int, offset long, length long")
    return found.withColumn("id", F.when(F.col("named"), F.col("id"))).drop("named")


def documents_of(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """``(shard, offset, n_tokens, ids_crc32)`` of every document in the payload, read in place."""
    schema = "shard int, offset long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    names = [part.split()[0] for part in schema.split(", ")]

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                shard, first = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                length = np.frombuffer(batch.column(2)[i].as_py(), "<u8").astype(np.int64)
                data = memoryview(batch.column(3)[i].as_buffer())
                ends = np.cumsum(length)
                parts = [data[4 * a : 4 * b] for a, b in zip((ends - length).tolist(), ends.tolist())]
                columns = [
                    pa.array(np.full(len(length), shard, np.int32)),
                    pa.array(first + ends - length),
                    pa.array(length),
                    pa.array([zlib.crc32(part) for part in parts], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([part.tobytes() for part in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    return _payload(spark, path).select("shard", "first", "lengths", "payload").mapInArrow(read, schema)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """``(shard, before)``: ids of all shards before. One row per shard, so one window holds them."""

    def count(batches):
        for batch in batches:
            total = [int(np.frombuffer(one.as_py(), "<u8").sum()) for one in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64())], ["shard", "total"])

    blocks = _payload(spark, path).select("shard", "lengths").mapInArrow(count, "shard int, total long")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("shard").agg(F.sum("total").alias("total"))
    return totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))


def read_by_key(spark: SparkSession, path: str, keys: DataFrame, *, with_ids: bool = False) -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` of stored ``keys(id, copy)``, found through the index."""
    found = locate(spark, path, keys)
    held = documents_of(spark, path, with_ids=with_ids)
    starts = stored(shard_starts(spark, path), "starts")
    rows = found.join(held, ["shard", "offset"]).join(small_side(starts), "shard")
    return rows.select("id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def keys_of(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, copy)`` of every row, counted per id."""
    counts = docs.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select("id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("copy"))
