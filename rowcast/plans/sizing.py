"""Size checks taken from Catalyst's own estimates.

Building a query should cost no pass over its inputs, so small inputs are told
by the bytes of their files alone, which Catalyst knows when a table is opened.
A job runs only where much hangs on the answer: before a broadcast that Spark
would not make by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType

# A build side is broadcast only while its estimate stays under this.
BROADCAST_BYTES = 32 * 1024 * 1024
# Stored bytes say little about a table of repeated rows, so rows are limited as well.
BROADCAST_ROWS = 2_000_000
# What the rows hold once decoded: well-compressed text can be far larger than its file.
BROADCAST_PAYLOAD = 64 * 1024 * 1024
# Inputs below this fit a few tasks whatever their keys look like; AQE splits what is skewed among them.
SKEW_FLOOR_BYTES = 2 * 1024 * 1024 * 1024


def _optimized(df: DataFrame):
    try:
        return df._jdf.queryExecution().optimizedPlan()
    except AttributeError:
        return None


def plan_bytes(df: DataFrame) -> int | None:
    """Estimated output bytes, or None where the plan is out of reach."""
    plan = _optimized(df)
    return None if plan is None else int(plan.stats().sizeInBytes())


def input_bytes(df: DataFrame) -> int | None:
    """Estimated bytes of all inputs the plan reads.

    Without column statistics a join's output estimate is the product of its
    sides, so questions about how much data is involved look at the inputs.
    """
    plan = _optimized(df)
    if plan is None:
        return None
    leaves = plan.collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def payload(df: DataFrame) -> Column:
    """Bytes a row holds: texts and binaries as they are, numbers as eight, nested values as JSON."""
    total = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            size = F.octet_length(column)
        elif isinstance(field.dataType, AtomicType):
            size = F.lit(8)
        else:
            size = F.octet_length(F.to_json(F.struct(column)))
        total = total + F.coalesce(size, F.lit(0))
    return total


def broadcastable(df: DataFrame) -> bool:
    """True only for an output estimated small, counted short and measured small.

    Rows are counted and their bytes summed in one job, and only after the
    estimate has passed, so that job reads little.
    """
    estimate = plan_bytes(df)
    if estimate is None or estimate > BROADCAST_BYTES:
        return False
    seen = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(payload(df)), F.lit(0)).alias("bytes")).first()
    return seen["rows"] <= BROADCAST_ROWS and seen["bytes"] <= BROADCAST_PAYLOAD


def left_to_spark(df: DataFrame) -> bool:
    """Whether Spark broadcasts ``df`` on its own estimate, under the session's threshold."""
    estimate = plan_bytes(df)
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    number = text.rstrip("bkmgt")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}.get(text[len(number) : len(number) + 1], 1)
    return estimate is not None and estimate <= int(number) * scale


def modest(*frames: DataFrame) -> bool:
    """True only when the files behind all frames are small together; no job is run."""
    sizes = [input_bytes(df) for df in frames]
    return None not in sizes and sum(sizes) <= SKEW_FLOOR_BYTES
