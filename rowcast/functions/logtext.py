"""Patterns for access logs and application logs, and columns built with them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two line formats and the word pattern.
ACCESS_LINE = r'^(\S+) \S+ \S+ \[([^\]]+)\] "(\S+) (.*?) (HTTP/\d\.\d)" (\d{3}) (\S+)'
APP_LINE = r"\[(.*?)\]\s+(INFO|WARN|ERROR)\s+(.*)"
WORD = "[a-zA-Z]+"
CLF_TIME = "dd/MMM/yyyy:HH:mm:ss Z"

ACCESS_FIELDS = ("ip", "timestamp", "method", "url", "http_ver", "status", "size")
APP_FIELDS = ("timestamp", "level", "message")


def capture(line: Column | str, pattern: str, group: int) -> Column:
    """One capture group of the first match; empty without a match.

    As in Python, only a line feed ends a line for the pattern.
    """
    return F.regexp_extract(line, f"(?d){pattern}", group)


def captures(line: Column | str, pattern: str, count: int) -> Column:
    """All capture groups of the first match as an array of ``count`` texts.

    The line is matched once and rewritten to its groups set apart by line
    feeds, which a line read from a text file cannot contain. Without a match
    the array has another size; ``group_of`` tells the two apart.
    """
    lead = "^" if pattern.startswith("^") else "(?s:^.*?)"
    whole = f"(?d){lead}{pattern.removeprefix('^')}(?s:.*)$"
    groups = "\n".join(f"${i}" for i in range(1, count + 1))
    return F.split(F.regexp_replace(line, whole, groups), "\n", -1)


def group_of(parts: str, index: int, count: int) -> Column:
    """Group ``index`` of a ``captures`` column; NULL where the line did not match."""
    return F.when(F.size(parts) == count, F.get(parts, F.lit(index)))


def words(text: Column) -> Column:
    """Lower-case ASCII words of a text."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def clf_epoch(text: Column) -> Column:
    """Seconds since 1970 of an access-log time with offset; NULL if malformed."""
    return F.unix_timestamp(F.try_to_timestamp(text, F.lit(CLF_TIME)))
