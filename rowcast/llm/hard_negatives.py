"""Hard negatives: per anchor and positive the best-scored rows of other labels inside a window of scores.

Scores are inner products of whole numbers, so they are exact. The anchors meet
all rows in cells of a grid (a block of anchors, a block of rows); a cell hands
on only what can still be among an anchor's first, so nothing quadratic moves.
Pairs travel as one binary key, (anchor, descending score, kind, id), are dealt
by anchor and sorted within partitions, and a streaming pass reads them in
order: a positive opens a window, the negatives that follow fall into the open
windows. It holds the open windows of one anchor, never an anchor's pairs. The
first pass finds the positives, the second the negatives in their windows.

Rows without an id, label or vector, or with a missing or non-finite component,
take no part. Rows that share an id count once, with the smallest (label,
vector). Components that a shorter vector lacks count as 0; scores beyond 64 bits
stay at the largest or smallest 64-bit number. Equal scores are ordered by id.
An anchor without other rows of its label, or with positives scored below 0,
gives no rows. Other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowcast.llm.common import stored

POSITIVES = 5
NEGATIVES = 10
# A negative's score in hundredths of its positive's.
LOW, HIGH = 30, 90
BLOCK_ROWS = 8192
BLOCK_ANCHORS = 2048
# Anchors whose scores a cell holds at once.
STRIPE = 256

_KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
_SIGN = np.uint64(1 << 63)
_POSITIVE, _NEGATIVE = 0, 1
PAIRS = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantised(vector: str, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component; NULL for a vector with a missing or non-finite one."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(sound, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


def pack_keys(anchor, score, kind, other) -> np.ndarray:
    """Keys whose byte order is anchor ascending, score descending, kind, id ascending."""
    keys = np.empty(len(other), dtype=_KEY)
    keys["anchor"] = np.asarray(anchor, np.int64).view(np.uint64) ^ _SIGN
    keys["score"] = ~(np.asarray(score, np.int64).view(np.uint64) ^ _SIGN)
    keys["kind"] = kind
    keys["id"] = np.asarray(other, np.int64).view(np.uint64) ^ _SIGN
    return keys


def unpack_keys(column: pa.Array) -> tuple[list[int], list[int], list[int], list[int]]:
    keys = np.frombuffer(b"".join(column.to_pylist()), dtype=_KEY)
    signed = lambda x: (x.astype(np.uint64) ^ _SIGN).view(np.int64).tolist()
    return signed(keys["anchor"]), signed(~keys["score"].astype(np.uint64)), keys["kind"].tolist(), signed(keys["id"])


def _binary(keys: np.ndarray) -> pa.Array:
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(_KEY.itemsize), len(keys), [None, pa.py_buffer(keys.tobytes())])
    return fixed.cast(pa.binary())


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, int)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _width(column: pa.ChunkedArray) -> int:
    return max((len(x) for x in column), default=0) if len(column) else 0


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of all pairs, exact; doubles while they hold every sum, else Python's numbers."""
    top = [int(max(m.max(initial=0), -int(m.min(initial=0)))) for m in (anchors, rows)]
    if top[0] * top[1] * max(1, rows.shape[1]) < 1 << 53:
        return (anchors.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    exact = anchors.astype(object) @ rows.T.astype(object)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _first(values: np.ndarray, among: np.ndarray, count: int) -> np.ndarray:
    """Of the places ``among`` (ascending ids) the ``count`` with the largest values, ties by place."""
    if len(among) <= count:
        return among
    own = values[among]
    bar = np.partition(own, len(own) - count)[len(own) - count]
    above = among[own > bar]
    return np.concatenate([above, among[own == bar][: count - len(above)]])


def _cell(pick, kind: int):
    """A function of one cell: the pairs that ``pick`` keeps for each anchor, as keys."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and anchors.num_rows:
            rows = rows.sort_by("id")
            width = max(_width(rows["code"]), _width(anchors["vector"]))
            ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
            right, left = _matrix(rows["code"], width), _matrix(anchors["vector"], width)
            names, own = anchors["anchor"].to_numpy(), anchors["own"].to_numpy()
            aims = anchors["aims"].to_pylist() if "aims" in anchors.column_names else [None] * len(names)
            for start in range(0, len(names), STRIPE):
                part = scores(left[start : start + STRIPE], right)
                for i, values in enumerate(part, start):
                    places = pick(values, labels == own[i], ids != names[i], aims[i])
                    found.append(pack_keys(np.full(len(places), names[i]), values[places], kind, ids[places]))
        # Joined as they are: numpy would turn the bytes of big-endian fields round.
        keys = np.concatenate(found, dtype=_KEY) if found else np.zeros(0, _KEY)
        return pa.table({"key": _binary(keys)})

    return run


def _window(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores between ``low`` and ``high`` hundredths of ``score``, both included."""
    return -(-low * score // 100), high * score // 100


def _dealt(pairs: DataFrame) -> DataFrame:
    """Every anchor's keys in one partition, in order."""
    return pairs.repartition(F.substring("key", 1, 8)).sortWithinPartitions("key")


def _leading(count: int):
    """Streaming pass over sorted keys: the first ``count`` of each anchor."""

    def run(batches):
        current, taken = None, 0
        for batch in batches:
            out = []
            for i, (anchor, score, _, other) in enumerate(zip(*unpack_keys(batch.column(0)))):
                if anchor != current:
                    current, taken = anchor, 0
                if taken < count:
                    taken += 1
                    out.append((i, anchor, other, score))
            place, *columns = zip(*out) if out else ((), (), (), ())
            keys = batch.column(0).take(pa.array(place, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, *[pa.array(c, pa.int64()) for c in columns]], ["key", "anchor", "positive_id", "score"])

    return run


def _opened(positives: int, count: int, low: int, high: int):
    """Streaming pass over sorted keys: positives open windows, negatives are emitted for the open ones."""

    def run(batches):
        current, windows, seen = None, [], 0
        for batch in batches:
            out = []
            for anchor, score, kind, other in zip(*unpack_keys(batch.column(0))):
                if anchor != current:
                    current, windows, seen = anchor, [], 0
                if kind == _POSITIVE:
                    seen += 1
                    if seen <= positives:
                        windows.append([other, score, *_window(score, low, high), 0])
                    continue
                # Scores only fall from here on, so a window past its lower end is done.
                windows = [w for w in windows if w[4] < count and score >= w[2]]
                for window in windows:
                    if score <= window[3]:
                        window[4] += 1
                        out.append((anchor, window[0], window[4], other, window[1], score))
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int32() if i == 2 else pa.int64() for i in range(6)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [part.split()[0] for part in PAIRS.split(", ")])

    return run


def hard_negatives(
    rows: DataFrame,
    is_anchor: str,
    *,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_rows: int = BLOCK_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """Negatives of ``rows`` (``id long, label int, code array<long>``) for the anchors among them.

    ``is_anchor`` is a condition on ``id`` and ``label``. An anchor's positives
    are its first ``positives`` other rows of its label; per anchor and positive
    come the first ``negatives`` rows of other labels whose score is between
    ``low`` and ``high`` hundredths of the positive's, with their rank from 1.
    """
    sound = rows.select("id", "label", "code").filter("id IS NOT NULL AND label IS NOT NULL AND code IS NOT NULL")
    one = sound.groupBy("id").agg(F.min(F.struct("label", "code")).alias("row")).select("id", "row.label", "row.code")
    one = stored(one, "rows")
    anchors = one.filter(is_anchor).select(F.col("id").alias("anchor"), F.col("label").alias("own"), F.col("code").alias("vector"))
    sizes = [one.count(), anchors.count()]
    row_blocks, anchor_blocks = max(1, -(-sizes[0] // block_rows)), max(1, -(-sizes[1] // block_anchors))
    spread = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")
    axis = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def cells(aimed: DataFrame, pick, kind: int) -> DataFrame:
        right = one.withColumn("b", spread("id", row_blocks)).withColumn("a", axis(anchor_blocks))
        left = aimed.withColumn("a2", spread("anchor", anchor_blocks)).withColumn("b2", axis(row_blocks))
        return right.groupBy("a", "b").cogroup(left.groupBy("a2", "b2")).applyInArrow(_cell(pick, kind), "key binary")

    def closest(values, same, other, aims):
        return _first(values, np.flatnonzero(same & other), positives)

    found = _dealt(cells(anchors, closest, _POSITIVE)).mapInArrow(_leading(positives), "key binary, anchor long, positive_id long, score long")
    found = stored(found, "positives")
    # At most ``positives`` scores an anchor.
    aims = found.groupBy("anchor").agg(F.collect_set("score").alias("aims"))

    def inside(values, same, other, aims):
        kept = [np.zeros(0, np.int64)]
        for aim in aims:
            least, most = _window(aim, low, high)
            kept.append(_first(values, np.flatnonzero(~same & other & (values >= least) & (values <= most)), negatives))
        return np.unique(np.concatenate(kept))

    pairs = cells(anchors.join(aims, "anchor"), inside, _NEGATIVE).unionByName(found.select("key"))
    return _dealt(pairs).mapInArrow(_opened(positives, negatives, low, high), PAIRS)


ORACLE = """
WITH sound AS (
    SELECT vec_id AS id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS code
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), one AS (
    SELECT id, label, code FROM sound QUALIFY row_number() OVER (PARTITION BY id ORDER BY label, code) = 1
), scored AS (
    SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, list_inner_product(a.code, r.code)::BIGINT AS score
    FROM one a JOIN one r ON a.id <> r.id AND a.id % 100 = 0
), positive AS (
    SELECT anchor_id, id, score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), ranked AS (
    SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank
    FROM positive p JOIN scored n
      ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""
