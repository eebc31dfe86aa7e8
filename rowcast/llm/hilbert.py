"""Shards cut from a Hilbert curve over several metadata dimensions.

Every dimension is quantised to ``2^bits`` steps: numbers by their quantiles,
texts by a hash of the value. The steps are one cell of a grid, a Hilbert curve
numbers the cells so that near numbers are near in every dimension, and the
rows in curve order are cut into runs of equal counts. Each shard then covers
a small part of every dimension; ``shard_ranges`` lists the parts, and
``read_shards`` reads only those shards that can hold what is looked for.

Equal texts are one group: they share a cell (that of the largest value in each
dimension, where theirs differ) and lie together in it, in the order of a hash
of the text and then of their ids. So a cut between shards goes through at most
one group, and no other group is in two shards.

A row's place is counted, not sorted: cells are split by the leading bits of the
hash, these buckets are counted, counts are summed up along the curve, and only
rows of one bucket are put in order together. A text that very many rows have
is a stretch of its own in its cell and is split further by salts, so neither a
cell nor a text that holds a third of all rows is sorted by one task.

The law is ``rows``: shard counts are at most one apart. NULL values are a step
of their own with the smallest; NULL texts have size 1 and count as empty ones.
Rows without an id come first among their equals. Rows that are equal in id,
size and text checksum may change places; nothing they return differs. An empty
table gives no rows.

Only DataFrame and SQL functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowcast.llm.common import small_side, stored

SHARDS = 16
BITS = 3
# Rows that a bucket should have, were they spread evenly; a cell has at most ``2 ** MOST_BITS`` buckets.
BUCKET_ROWS = 20_000
MOST_BITS = 16
# A text with more rows than this, and with one in ``HOT_TEXTS`` of all, is split by salts.
HOT_ROWS = 100_000
HOT_TEXTS = 10_000
SALTS = 1024
ERROR = 10_000


def hilbert_index(steps: str, bits: int, dimensions: int) -> Column:
    """Curve number of a cell from its array column of steps, by exchanging and inverting bits.

    For every bit from the highest down, a dimension whose bit is set inverts
    the lower bits of the first, others exchange them with the first; a Gray
    code over all dimensions then gives the number.
    """
    text = "transform(steps, x -> cast(x AS bigint))"
    # One fold over (bit, dimension) pairs, highest bit first.
    undone = (
        f"aggregate(sequence(0, {bits * dimensions - 1}), {text}, (x, k) -> "
        f"transform(array(named_struct('q', shiftleft(1L, {bits - 1} - cast(k div {dimensions} AS int)), 'i', cast(k % {dimensions} AS int))), s -> "
        "transform(x, (v, j) -> CASE "
        "WHEN s.q <= 1 THEN v "
        "WHEN (x[s.i] & s.q) <> 0 THEN if(j = 0, v ^ (s.q - 1), v) "
        "WHEN j = 0 THEN v ^ ((x[0] ^ x[s.i]) & (s.q - 1)) "
        "WHEN j = s.i THEN v ^ ((x[0] ^ x[s.i]) & (s.q - 1)) "
        "ELSE v END))[0])"
    )
    gray = (
        f"transform(array({undone}), y -> aggregate(sequence(1, {dimensions - 1}), y, (x, k) -> "
        "transform(x, (v, j) -> if(j = k, v ^ x[k - 1], v))))[0]"
    )
    mask = (
        f"aggregate(sequence(1, {bits - 1}), 0L, (t, k) -> "
        f"if((z[{dimensions - 1}] & shiftleft(1L, {bits} - k)) <> 0, t ^ (shiftleft(1L, {bits} - k) - 1), t))"
        if bits > 1
        else "0L"
    )
    coded = f"transform(array({gray}), z -> transform(z, v -> v ^ {mask}))[0]"
    number = (
        f"transform(array({coded}), z -> aggregate(sequence(0, {bits * dimensions - 1}), 0L, (t, k) -> "
        f"t * 2 + (shiftright(z[cast(k % {dimensions} AS int)], {bits - 1} - cast(k div {dimensions} AS int)) & 1)))[0]"
    )
    return F.expr(f"transform(array({steps}), steps -> {number})[0]")


def _quantised(rows: DataFrame, numbers: list[str], texts: list[str], bits: int) -> DataFrame:
    """``steps_in``: the cell of every row."""
    parts = [i / 2**bits for i in range(1, 2**bits)]
    cuts = rows.agg(*[F.percentile_approx(name, parts, ERROR).alias(name) for name in numbers]).first() if numbers else {}
    steps = []
    for name in numbers:
        bounds = sorted(set(cuts[name] or []))
        above = [F.when(F.col(name) >= bound, 1).otherwise(0) for bound in bounds]
        steps.append(sum(above, F.lit(0)))
    for name in texts:
        steps.append(_text_step(F.col(name), bits))
    return rows.withColumn("steps_in", F.array(*[step.cast("bigint") for step in steps]))


def _text_step(value: Column, bits: int) -> Column:
    return F.when(value.isNull(), 0).otherwise(F.pmod(F.xxhash64(value), F.lit(2**bits)))


def _grouped(rows: DataFrame, dims: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with the dimensions of their group of equal texts, and ``(text_key, size, n)`` of the groups."""
    measured = [
        part
        for name in dims
        for part in (F.min(name).alias(f"least_{name}"), F.max(name).alias(f"most_{name}"), F.count(name).alias(f"known_{name}"))
    ]
    groups = stored(rows.groupBy("text_key", "size").agg(F.count(F.lit(1)).alias("n"), *measured), "texts")
    differs = F.lit(False)
    for name in dims:
        known = F.col(f"known_{name}")
        differs = differs | ((known > 0) & ((known < F.col("n")) | (F.col(f"least_{name}") != F.col(f"most_{name}"))))
    # Only groups whose rows differ have anything to look up.
    mixed = groups.filter(differs).select("text_key", "size", F.lit(True).alias("mixed_group"), *[F.col(f"most_{name}") for name in dims])
    joined = rows.join(small_side(mixed), ["text_key", "size"], "left")
    shared = {name: F.when(F.col("mixed_group"), F.col(f"most_{name}")).otherwise(F.col(name)) for name in dims}
    joined = joined.withColumns(shared).drop("mixed_group", *[f"most_{name}" for name in dims])
    return joined, groups.select("text_key", "size", "n")


def hilbert_shards(
    docs: DataFrame,
    *,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    number_dims: tuple[str, ...] = (),
    text_dims: tuple[str, ...] = ("lang", "source"),
    bits: int = BITS,
    keep: tuple[str, ...] = (),
    bucket_rows: int = BUCKET_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard, curve number and steps, own_steps, and ``kept``.

    ``steps`` are those of the row's group, ``own_steps`` those of its own text
    dimensions. Dimensions are the size, ``number_dims`` and ``text_dims``. ``keep`` names
    columns of ``docs`` to carry along, in a struct ``kept``.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
        # Written with the row, so that a salt stays what it is.
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).alias("salt"),
        *[F.col(name).cast("double").alias(f"n{i}") for i, name in enumerate(number_dims)],
        *[F.col(name).cast("string").alias(f"t{i}") for i, name in enumerate(text_dims)],
        *([F.struct(*[F.col(name) for name in keep]).alias("kept")] if keep else []),
    )
    rows = stored(narrow, "dimensions")
    numbers = ["size", *[f"n{i}" for i in range(len(number_dims))]]
    texts = [f"t{i}" for i in range(len(text_dims))]
    rows = rows.withColumn("own_steps", F.array(*[_text_step(F.col(name), bits).cast("bigint") for name in texts]))
    rows, groups = _grouped(rows, [*numbers[1:], *texts])
    rows = _quantised(rows, numbers, texts, bits)
    total = groups.agg(F.sum("n")).first()[0] or 0
    split_bits = min(MOST_BITS, max(1, (total // bucket_rows).bit_length()))
    # At most ``HOT_TEXTS`` texts, numbered among themselves.
    hot = groups.filter(F.col("n") > max(hot_rows, total // HOT_TEXTS)).select("text_key", "size")
    hot = F.broadcast(stored(hot.withColumn("hot", F.row_number().over(Window.orderBy("text_key", "size"))), "hot"))
    mixed = F.xxhash64("text_key", "size", "text_crc32")
    rows = rows.join(hot, ["text_key", "size"], "left").withColumn("mixed", mixed)
    split = F.when(F.col("hot").isNull(), F.shiftrightunsigned("mixed", 64 - split_bits)).otherwise(F.col("hot") + 2**split_bits)
    rows = rows.withColumn("split", split.cast("long")).withColumn("sub", F.when(F.col("hot").isNull(), F.lit(0)).otherwise(F.col("salt")))

    # At most 2^(bits * dimensions) cells: they are numbered and summed up whatever the table's size.
    counts = stored(rows.groupBy("steps_in", "split", "sub").agg(F.count(F.lit(1)).alias("rows")), "counts")
    cells = counts.groupBy("steps_in").agg(F.sum("rows").alias("cell_rows"))
    cells = cells.withColumn("curve", hilbert_index("steps_in", bits, len(numbers) + len(texts)))
    before = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("cell_start", F.coalesce(F.sum("cell_rows").over(before), F.lit(0)))
    inner = Window.partitionBy("steps_in").orderBy("split", "sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("split_start", F.coalesce(F.sum("rows").over(inner), F.lit(0)))
    start = (F.col("cell_start") + F.col("split_start")).alias("start")
    starts = stored(starts.join(cells, "steps_in").select("steps_in", "split", "sub", "curve", start), "starts")

    order = Window.partitionBy("steps_in", "split", "sub").orderBy("mixed", "id", "size", "text_crc32")
    placed = rows.withColumn("place", F.row_number().over(order) - 1).join(small_side(starts), ["steps_in", "split", "sub"])
    rank = F.col("start") + F.col("place")
    # Shard s starts at rank ceil(s * total / shards).
    shard = F.expr(f"(start + place) * {shards}L div {max(total, 1)}L")
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return (
        placed.withColumn("shard", shard)
        .withColumn("slot", rank - first)
        .select(
            F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
            "slot", F.lit(None).cast("int").alias("grown_shard"), "curve", F.col("steps_in").alias("steps"), "own_steps",
            *(["kept"] if keep else []),
        )
    )


def write_shards(docs: DataFrame, path: str, *, shards: int = SHARDS, text_dims: tuple[str, ...] = ("lang", "source"), bits: int = BITS, **options) -> None:
    """Write ``docs`` in shards, a folder each, in curve order, and beside them the range of every dimension in each."""
    sharded = stored(hilbert_shards(docs, shards=shards, text_dims=text_dims, bits=bits, keep=tuple(docs.columns), **options), "sharded")
    ranges = shard_ranges(sharded, len(text_dims), "own_steps")
    ranges.withColumn("bits", F.lit(bits)).withColumn("text_dims", F.array(*map(F.lit, text_dims))).write.mode("overwrite").parquet(f"{path}/ranges")
    ordered = sharded.select("shard", "slot", F.col("size").alias("text_bytes"), "kept").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.mode("overwrite").partitionBy("shard").parquet(f"{path}/rows")


def read_shards(spark: SparkSession, path: str, *, sizes: tuple[int, int] | None = None, **values: str) -> tuple[DataFrame, list[int]]:
    """Rows with a size (bytes and one) in ``sizes`` and the given ``values`` of text dimensions, and the shards that were read for them.

    A shard whose ranges exclude what is looked for is not opened.
    """
    ranges = spark.read.parquet(f"{path}/ranges")
    about = ranges.select("bits", "text_dims").first()
    kept, wanted = F.lit(True), F.lit(True)
    if sizes:
        kept = kept & (F.col("least_size") <= sizes[1]) & (F.col("most_size") >= sizes[0])
        wanted = wanted & F.col("text_bytes").between(*sizes)
    for name, value in values.items():
        place = about["text_dims"].index(name)
        step = _text_step(F.lit(value).cast("string"), about["bits"])
        kept = kept & step.between(F.col(f"least_{place}"), F.col(f"most_{place}"))
        wanted = wanted & (F.col(f"kept.{name}") == value)
    found = [r["shard"] for r in ranges.filter(kept).select("shard").orderBy("shard").collect()]
    schema = spark.read.parquet(f"{path}/rows").schema
    folders = [f"{path}/rows/shard={shard}" for shard in found]
    rows = spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(*folders) if found else spark.createDataFrame([], schema)
    return rows.filter(wanted).select("kept.*"), found


def shard_ranges(sharded: DataFrame, dimensions: int, steps: str = "steps") -> DataFrame:
    """Per shard: rows, bytes, curve and size range and the range of every dimension's steps, for pruning."""
    ranges = [
        part
        for i in range(dimensions)
        for part in (F.min(F.col(steps)[i]).alias(f"least_{i}"), F.max(F.col(steps)[i]).alias(f"most_{i}"))
    ]
    return sharded.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), F.min("curve").alias("first_curve"), F.max("curve").alias("last_curve"),
        F.min("size").alias("least_size"), F.max("size").alias("most_size"), *ranges,
    )
