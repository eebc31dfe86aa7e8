"""Feature and model queries over ``lineitem`` and ``embeddings``."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.operators import features, models, networks
from rowcast.plans.reuse import reused, settled
from rowcast.plans.scratch import scratch_path
from rowcast.sources import files
from rowcast.workloads.tables import rounded, rounded_sql, table

MEASURES = ["quantity", "price", "discount", "tax"]
WIDTH = 64
WIDTHS = (28, 64)
SEED = 7
SCORE_DIGITS = 3


def measured(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_returnflag").alias("target"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select("vec_id", "embedding", "label")


def features_standardized(spark: SparkSession, folder: str) -> DataFrame:
    scaled = features.standardized(measured(spark, folder), MEASURES)
    return scaled.withColumns({name: rounded(name) for name in MEASURES})


def _scores(spark: SparkSession, folder: str) -> DataFrame:
    return features.principal_components(
        measured(spark, folder), MEASURES, 2, "l_orderkey", "l_linenumber", "target"
    )


def features_pca(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder).withColumns(
        {name: rounded(name, SCORE_DIGITS) for name in ("pc1", "pc2")}
    )


def features_pca_classes(spark: SparkSession, folder: str) -> DataFrame:
    classes = features.class_summary(_scores(spark, folder), "target", ["pc1", "pc2"])
    return classes.withColumns(
        {name: rounded(name, SCORE_DIGITS) for name in ("mean_pc1", "mean_pc2")}
    )


def features_packed(spark: SparkSession, folder: str) -> DataFrame:
    """The packed vectors, unpacked again to one row per entry."""
    packed = features.pack_array(vectors(spark, folder), "embedding", "label", "vec_id")
    return packed.select(
        "vec_id", "label", F.posexplode(vector_to_array("features")).alias("position", "entry")
    )


def features_class_subset(spark: SparkSession, folder: str) -> DataFrame:
    return features.of_class(measured(spark, folder), "target", "R")


def features_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return features.histogram(vectors(spark, folder), "embedding", 101)


def _chained(spark: SparkSession, folder: str) -> DataFrame:
    """Gzipped CSV to numbers, packed to vectors: all rows of the table."""
    path = scratch_path(spark, "chain")
    rows = vectors(spark, folder).select(
        F.col("vec_id").cast("double").alias("label"),
        *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(WIDTH)],
    )
    files.write_csv(rows, path, header=False, compression="gzip")
    names = [f"f{i}" for i in range(WIDTH)]
    return features.pack(files.read_numeric_gzip(spark, path, WIDTH), names, "label")


def features_pca_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Two components of the first 28 entries of every vector, and of all 64."""
    found = []
    for width in WIDTHS:
        cut = vectors(spark, folder).select("vec_id", F.slice("embedding", 1, width).alias("entries"))
        scores = features.array_components(cut, "entries", 2, "vec_id")
        found.append(scores.select(F.lit(width).alias("width"), "vec_id", *[rounded(name, SCORE_DIGITS).alias(name) for name in ("pc1", "pc2")]))
    return found[0].unionByName(found[1])


def features_chain_whole(spark: SparkSession, folder: str) -> DataFrame:
    """The chain to a histogram of all packed rows, its counts told apart by the split that follows.

    The gzipped files are read once; the passes of the split and the histogram read the packed rows.
    """
    packed = _chained(spark, folder).select("label", vector_to_array("features").alias("entries"))
    with reused(packed, "packed") as rows:
        parted = features.with_part(rows, "label", validation=100)
        return settled(features.histogram(parted, "entries", 101, by="part", groups=features.PARTS), "histogram")


def features_split(spark: SparkSession, folder: str) -> DataFrame:
    """Both splits with their name: the first 100 rows, then up to 10000 more."""
    validation, train = features.split(
        vectors(spark, folder).select("vec_id", "label"), "vec_id", validation=100
    )
    return validation.withColumn("split", F.lit("validation")).unionByName(
        train.withColumn("split", F.lit("train"))
    )


def features_batches(spark: SparkSession, folder: str) -> DataFrame:
    keyed = table(spark, folder, "events").select("event_id", "value")
    return features.batches(keyed, "event_id", 500, SEED)


# Steps and step length of the sweeps; every step is a pass over all training rows.
CAPACITY_STEPS, PENALTY_STEPS, RATE = 3, 10, 0.5
# Penalties on the smallest network: strong enough to show after a few steps.
PENALTIES = {"none": (0.0, 0.0), "l1": (0.004, 0.0), "l2": (0.0, 0.004)}


def _swept(spark: SparkSession, folder: str, nets: list[networks.Network], steps: int) -> DataFrame:
    """Networks fitted on all training rows and scored on all rows of both splits."""
    parity = vectors(spark, folder).withColumn("label", F.col("label") % 2)
    held = models.held_out("vec_id")
    rows = parity.select("embedding", "label", F.when(held, "validation").otherwise("train").alias("split"))
    with reused(rows, "split") as stored:
        fit = networks.fitted(nets, stored.filter("split = 'train'"), "embedding", "label", steps, RATE)
        scores = settled(networks.scored(fit, stored, "embedding", "label", "split"), "scores")
    return scores.withColumns({name: rounded(name) for name in ("log_loss", "accuracy")})


def model_capacity_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """Cross-entropy and accuracy of networks of four sizes, after the same few steps."""
    nets = [networks.network(name, WIDTH, hidden) for name, hidden in models.CAPACITIES.items()]
    return _swept(spark, folder, nets, CAPACITY_STEPS)


def model_regularization_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """The same figures for one network without penalty, with an absolute and with a squared one."""
    nets = [networks.network(name, WIDTH, models.CAPACITIES["tiny"], l1, l2) for name, (l1, l2) in PENALTIES.items()]
    return _swept(spark, folder, nets, PENALTY_STEPS)


QUERIES = {
    "features_standardized": features_standardized,
    "features_pca": features_pca,
    "features_pca_classes": features_pca_classes,
    "features_pca_wide": features_pca_wide,
    "features_packed": features_packed,
    "features_class_subset": features_class_subset,
    "features_histogram": features_histogram,
    "features_split": features_split,
    "features_chain_whole": features_chain_whole,
    "features_batches": features_batches,
    "model_capacity_sweep": model_capacity_sweep,
    "model_regularization_sweep": model_regularization_sweep,
}

_MEASURED = """
WITH measured AS (
    SELECT l_orderkey, l_linenumber, l_returnflag AS target, l_quantity AS quantity,
           l_extendedprice AS price, l_discount AS discount, l_tax AS tax
    FROM lineitem
)
"""

_SCALED = (
    ", stats AS (SELECT "
    + ", ".join(f"AVG({m}) AS {m}_mean, STDDEV_POP({m}) AS {m}_dev" for m in MEASURES)
    + " FROM measured), scaled AS (SELECT l_orderkey, l_linenumber, target, "
    + ", ".join(f"({m} - {m}_mean) / {m}_dev AS {m}" for m in MEASURES)
    + " FROM measured, stats)"
)


def _leading_vector(name: str, matrix: str) -> str:
    """CTEs for the leading eigenvector of a symmetric matrix.

    ``matrix`` yields one row of entries ``a00 .. a33``. Squaring it 40 times,
    scaled to trace 1, leaves the outer product of the vector with itself. Its
    largest column gives the vector, turned so that its largest entry is
    positive.
    """
    size = range(len(MEASURES))
    cells = [(i, j) for i in size for j in size]
    trace = " + ".join(f"a{i}{i}" for i in size)
    squares = ", ".join(
        "(" + " + ".join(f"p.a{i}{k} * p.a{k}{j}" for k in size) + f") / p.scale AS a{i}{j}"
        for i, j in cells
    )
    norm = " + ".join(f"p.a{i}{j} * p.a{i}{j}" for i, j in cells)
    listed = ", ".join(f"a{i}{j}" for i, j in cells)
    diagonal = [f"a{i}{i}" for i in size]

    def column(j: int) -> str:
        return ", ".join(f"a{i}{j} / SQRT(a{j}{j}) AS v{i}" for i in size)

    picks = " UNION ALL ".join(
        f"SELECT {column(j)} FROM {name}_last WHERE a{j}{j} = GREATEST({', '.join(diagonal)})"
        for j in size
    )
    return f""", {name}_steps AS (
        SELECT 0 AS step, {listed} FROM ({matrix})
        UNION ALL
        SELECT step + 1, {squares}
        FROM (SELECT p.*, {norm} AS scale FROM {name}_steps p WHERE step < 40) p
    ), {name}_last AS (
        SELECT {", ".join(f"a{i}{j} / ({trace}) AS a{i}{j}" for i, j in cells)}
        FROM {name}_steps WHERE step = 40
    ), {name} AS (SELECT * FROM ({picks}) LIMIT 1)"""


_SIZE = range(len(MEASURES))
_CELLS = [(i, j) for i in _SIZE for j in _SIZE]
_ENERGY = " + ".join(f"a{i}{j} * v{i} * v{j}" for i, j in _CELLS)
_PCA = (
    _MEASURED.replace("WITH", "WITH RECURSIVE", 1)
    + _SCALED
    + ", moments AS (SELECT "
    + ", ".join(f"AVG({MEASURES[i]} * {MEASURES[j]}) AS a{i}{j}" for i, j in _CELLS)
    + " FROM scaled)"
    + _leading_vector("first", "SELECT * FROM moments")
    + ", deflated AS (SELECT "
    + ", ".join(f"a{i}{j} - ({_ENERGY}) * v{i} * v{j} AS a{i}{j}" for i, j in _CELLS)
    + " FROM moments, first)"
    + _leading_vector("second", "SELECT * FROM deflated")
    + ", scores AS (SELECT l_orderkey, l_linenumber, target, "
    + ", ".join(
        " + ".join(f"{m} * {part}.v{i}" for i, m in enumerate(MEASURES)) + f" AS pc{n}"
        for n, part in ((1, "first"), (2, "second"))
    )
    + " FROM scaled, first, second) "
)

_SPLIT = f"""SELECT vec_id AS id, embedding::DOUBLE[] AS x, (label % 2)::DOUBLE AS y,
    CASE WHEN CAST('0x' || MD5(CAST(vec_id AS VARCHAR))[1:4] AS INTEGER) < {int(0.1 * 65_536)}
    THEN 'validation' ELSE 'train' END AS split
    FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL"""


def _sweep_sql(nets: dict[str, tuple[list[int], float, float]], steps: int) -> str:
    listed = []
    for name, (hidden, l1, l2) in nets.items():
        parameters = networks.network(name, WIDTH, hidden).parameters
        fit = networks.oracle_sql(WIDTH, hidden, steps, RATE, _SPLIT, l1, l2)
        listed.append(
            f"SELECT '{name}' AS model, CAST({parameters} AS BIGINT) AS parameters, zero_weights, split, rows, "
            f"{rounded_sql('log_loss')} AS log_loss, {rounded_sql('accuracy')} AS accuracy FROM ({fit})"
        )
    return "\nUNION ALL ".join(listed)


def _turned(part: str) -> str:
    """The leading eigenvector of the matrix ``m`` (a list of rows) of the CTE ``part``, by squaring it 40 times."""
    size = f"len({part}_steps.m)"
    product = f"list_transform({part}_steps.m, lambda r: list_transform({part}_steps.m, lambda c: list_dot_product(r, c)))"
    norm = "sqrt(list_sum(list_transform(q, lambda r: list_dot_product(r, r))))"
    return f"""{part}_steps AS (
        SELECT 0 AS step, m FROM {part}
        UNION ALL
        SELECT step + 1, list_transform(q, lambda r: list_transform(r, lambda v: v / {norm}))
        FROM (SELECT step, {product} AS q FROM {part}_steps WHERE step < 40 AND {size} > 0)
    ), {part}_column AS (
        SELECT m[list_position(d, list_max(d))] AS u FROM (
            SELECT m, list_transform(range(1, len(m) + 1), lambda i: m[i][i]) AS d FROM {part}_steps WHERE step = 40)
    ), {part}_unit AS (
        SELECT list_transform(u, lambda v: v / sqrt(list_dot_product(u, u))) AS u FROM {part}_column
    ), {part}_vector AS (
        SELECT list_transform(u, lambda v: v * sign(u[list_position(list_transform(u, lambda x: abs(x)), list_max(list_transform(u, lambda x: abs(x))))])) AS u
        FROM {part}_unit
    )"""


def _wide_sql(width: int) -> str:
    return f"""SELECT * FROM (WITH RECURSIVE entries AS (
        SELECT vec_id, i, embedding[i]::DOUBLE AS x FROM embeddings, (SELECT unnest(range(1, {width + 1})) AS i)
    ), spread AS (
        SELECT i, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1 ELSE stddev_pop(x) END AS dev FROM entries GROUP BY i
    ), scaled AS (
        SELECT vec_id, list((x - mean) / dev ORDER BY i) AS z FROM entries JOIN spread USING (i) GROUP BY vec_id
    ), turned AS (
        SELECT i, list(z[i] ORDER BY vec_id) AS c FROM scaled, (SELECT unnest(range(1, {width + 1})) AS i) GROUP BY i
    ), first AS MATERIALIZED (
        SELECT list(r ORDER BY i) AS m FROM (
            SELECT a.i, list(list_dot_product(a.c, b.c) / len(a.c) ORDER BY b.i) AS r FROM turned a, turned b GROUP BY a.i)
    ), {_turned("first")}, second AS MATERIALIZED (
        SELECT list_transform(range(1, {width + 1}), lambda i: list_transform(range(1, {width + 1}), lambda j: m[i][j] - e * u[i] * u[j])) AS m
        FROM (SELECT m, u, list_dot_product(u, list_transform(m, lambda r: list_dot_product(r, u))) AS e FROM first, first_vector)
    ), {_turned("second")}
    SELECT {width}::INTEGER AS width, vec_id, {rounded_sql("list_dot_product(z, a.u)", SCORE_DIGITS)} AS pc1,
           {rounded_sql("list_dot_product(z, b.u)", SCORE_DIGITS)} AS pc2
    FROM scaled, first_vector a, second_vector b)"""


ORACLE = {
    "model_capacity_sweep": _sweep_sql({name: (hidden, 0.0, 0.0) for name, hidden in models.CAPACITIES.items()}, CAPACITY_STEPS),
    "model_regularization_sweep": _sweep_sql(
        {name: (models.CAPACITIES["tiny"], *penalty) for name, penalty in PENALTIES.items()}, PENALTY_STEPS
    ),
    "features_pca_wide": " UNION ALL ".join(map(_wide_sql, WIDTHS)),
    "features_pca": _PCA
    + f"""SELECT l_orderkey, l_linenumber, target, {rounded_sql("pc1", SCORE_DIGITS)} AS pc1,
    {rounded_sql("pc2", SCORE_DIGITS)} AS pc2 FROM scores""",
    "features_pca_classes": _PCA
    + f"""SELECT target, COUNT(*) AS row_count,
    {rounded_sql("AVG(pc1)", SCORE_DIGITS)} AS mean_pc1,
    {rounded_sql("AVG(pc2)", SCORE_DIGITS)} AS mean_pc2 FROM scores GROUP BY target""",
    "features_standardized": _MEASURED
    + _SCALED
    + " SELECT l_orderkey, l_linenumber, target, "
    + ", ".join(f"{rounded_sql(m)} AS {m}" for m in MEASURES)
    + " FROM scaled",
    "features_packed": """SELECT vec_id, label, CAST(n.i AS INTEGER) AS position,
    CAST(embedding[n.i + 1] AS DOUBLE) AS entry
    FROM embeddings JOIN (SELECT UNNEST(RANGE(64)) AS i) n ON n.i < LEN(embedding)""",
    "features_class_subset": _MEASURED + "SELECT * FROM measured WHERE target = 'R'",
    "features_histogram": """WITH entries AS (
        SELECT CAST(UNNEST(embedding) AS DOUBLE) AS x FROM embeddings
    ), span AS (
        SELECT MIN(x) AS low, MAX(x) - MIN(x) AS width FROM entries
    ), counted AS (
        SELECT CAST(LEAST(FLOOR((x - low) / width * 101.0), 100) AS INTEGER) AS bin,
               COUNT(*) AS n FROM entries, span GROUP BY 1
    )
    SELECT CAST(b.i AS INTEGER) AS bin,
    low + CAST(b.i AS DOUBLE) * width / CAST(101 AS DOUBLE) AS left_edge,
    COALESCE(n, 0) AS count
    FROM (SELECT UNNEST(RANGE(101)) AS i) b CROSS JOIN span LEFT JOIN counted ON bin = b.i""",
    "features_split": """WITH numbered AS (
        SELECT vec_id, label, ROW_NUMBER() OVER (ORDER BY vec_id) AS n FROM embeddings
    ) SELECT vec_id, label, CASE WHEN n <= 100 THEN 'validation' ELSE 'train' END AS split
    FROM numbered WHERE n <= 10100""",
    "features_batches": f"""WITH indexed AS (
        SELECT event_id, value,
        ROW_NUMBER() OVER (ORDER BY MD5('{SEED}:' || event_id), event_id) - 1 AS row_index
        FROM events
    ) SELECT *, row_index // 500 AS batch_id FROM indexed""",
}
# The counts of all rows by the part of the split.
ORACLE["features_chain_whole"] = """WITH parted AS (
    SELECT embedding, CASE WHEN place <= 100 THEN 'validation' WHEN place <= 10100 THEN 'train' ELSE 'rest' END AS part
    FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY vec_id) AS place FROM embeddings)
), entries AS (
    SELECT part, CAST(UNNEST(embedding) AS DOUBLE) AS x FROM parted
), span AS (
    SELECT MIN(x) AS low, MAX(x) - MIN(x) AS width FROM entries
), counted AS (
    SELECT part, CAST(LEAST(FLOOR((x - low) / width * 101.0), 100) AS INTEGER) AS bin,
           COUNT(*) AS n FROM entries, span GROUP BY 1, 2
)
SELECT p.part, CAST(b.i AS INTEGER) AS bin,
low + CAST(b.i AS DOUBLE) * width / CAST(101 AS DOUBLE) AS left_edge,
COALESCE(n, 0) AS count
FROM (SELECT UNNEST(RANGE(101)) AS i) b CROSS JOIN (SELECT UNNEST(['validation', 'train', 'rest']) AS part) p
CROSS JOIN span LEFT JOIN counted ON bin = b.i AND counted.part = p.part"""
