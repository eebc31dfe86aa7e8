"""Access logs and application logs, parsed from a ``value`` column of lines.

Full parsing matches every line once for all its fields. The counts need one
field each and match for that field alone, which is cheaper still.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowcast.functions.logtext import (
    ACCESS_FIELDS,
    ACCESS_LINE,
    APP_FIELDS,
    APP_LINE,
    capture,
    captures,
    clf_epoch,
    group_of,
    words,
)


def parse_access(lines: DataFrame) -> DataFrame:
    """Seven fields per line plus the time in epoch seconds.

    A line in another format keeps its row with empty texts and no numbers;
    a size of ``-`` is NULL.
    """
    width = len(ACCESS_FIELDS)
    parts = lines.select("value", captures("value", ACCESS_LINE, width).alias("_parts"))
    group = {name: group_of("_parts", i, width) for i, name in enumerate(ACCESS_FIELDS)}
    fields = {name: F.coalesce(text, F.lit("")) for name, text in group.items()}
    fields["status"] = group["status"].try_cast("int")
    fields["size"] = group["size"].try_cast("bigint")
    fields["epoch_seconds"] = clf_epoch(group["timestamp"])
    return parts.withColumns(fields).drop("_parts")


def _field(lines: DataFrame, name: str) -> DataFrame:
    text = capture("value", ACCESS_LINE, ACCESS_FIELDS.index(name) + 1)
    return lines.select((text.try_cast("int") if name == "status" else text).alias(name))


def status_counts(lines: DataFrame) -> DataFrame:
    """Requests per status code, ordered by code; unparsed lines under NULL."""
    return (
        _field(lines, "status")
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("status")
    )


def top_urls(lines: DataFrame) -> DataFrame:
    """Requests per URL, most requested first."""
    return (
        _field(lines, "url")
        .groupBy("url")
        .agg(F.count(F.lit(1)).alias("hits"))
        .orderBy(F.desc("hits"), "url")
    )


def error_rate(lines: DataFrame) -> DataFrame:
    """All requests, those answered 4xx or 5xx, and their share, in one pass."""
    failed = (F.col("status") >= 400) & (F.col("status") < 600)
    return (
        _field(lines, "status")
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            F.count_if(failed).alias("error_count"),
        )
        .withColumn(
            "error_rate",
            F.when(
                F.col("total_requests") > 0, F.col("error_count") / F.col("total_requests")
            ).otherwise(0.0),
        )
    )


def parse_app(lines: DataFrame) -> DataFrame:
    """Time, level and message per line; NULL in all three for other lines."""
    width = len(APP_FIELDS)
    parts = lines.select("value", captures("value", APP_LINE, width).alias("_parts"))
    fields = {name: group_of("_parts", i, width) for i, name in enumerate(APP_FIELDS)}
    fields["timestamp"] = fields["timestamp"].try_cast("timestamp_ntz")
    return parts.withColumns(fields).drop("_parts")


def _level():
    return capture("value", APP_LINE, APP_FIELDS.index("level") + 1)


def level_counts(lines: DataFrame) -> DataFrame:
    """Lines per level, most frequent first; lines without a level are left out."""
    return (
        lines.select(_level().alias("level"))
        .filter(F.col("level") != "")
        .groupBy("level")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "level")
    )


def errors(lines: DataFrame) -> DataFrame:
    """The ERROR lines with their fields."""
    return parse_app(lines.filter(_level() == "ERROR"))


def top_words(lines: DataFrame, count: int = 10) -> DataFrame:
    """Most frequent words of the messages; ties in alphabetical order."""
    message = capture("value", APP_LINE, APP_FIELDS.index("message") + 1)
    return (
        lines.select(F.explode(words(message)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "word")
        .limit(count)
    )
