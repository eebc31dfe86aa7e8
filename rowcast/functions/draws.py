"""Repeatable pseudo-random columns computed from a row id.

``rand(seed)`` depends on how rows are laid out over partitions; these draws
depend on the id and a stream number only, so a lost task, another cluster
size or another engine gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the integer mixer: a prime modulus and its multipliers.
# Every product stays under 2**63, so ANSI arithmetic never overflows.
PRIME = 2147483647
STRIDE = 104729
TWIST = 7919
FOLD = 69621
SPREAD = 48271


def draw(row_id: Column | str, stream: int) -> Column:
    """Integer in ``[0, PRIME)``."""
    row_id = F.col(row_id) if isinstance(row_id, str) else row_id
    prime = F.lit(PRIME).cast("bigint")
    whole = row_id.cast("bigint")
    # What lies above the modulus takes part as well, so ids do not repeat there.
    high = F.pmod(F.call_function("div", whole, prime), prime)
    start = (F.pmod(whole, prime) * SPREAD + high * FOLD + stream * STRIDE) % prime
    return (start * (start + TWIST) + stream) % prime * SPREAD % prime


def below(row_id: Column | str, stream: int, size: int) -> Column:
    """Integer in ``[0, size)``; ``size`` up to 4 billion."""
    scaled = draw(row_id, stream) * F.lit(size).cast("bigint")
    return F.call_function("div", scaled, F.lit(PRIME).cast("bigint"))


def unit(row_id: Column | str, stream: int) -> Column:
    """Double in ``(0, 1)``."""
    return (draw(row_id, stream) + 0.5) / float(PRIME)


def pick(values: Sequence[str], row_id: Column | str, stream: int) -> Column:
    """One of ``values``."""
    options = F.array(*[F.lit(value) for value in values])
    return F.element_at(options, (below(row_id, stream, len(values)) + 1).cast("int"))


def normal(row_id: Column | str, stream: int, mean: float, deviation: float) -> Column:
    """Normal draw by the Box-Muller transform of two uniform draws."""
    radius = F.sqrt(F.log(unit(row_id, stream)) * -2.0)
    angle = F.cos(unit(row_id, stream + 1) * 6.283185307179586)
    return radius * angle * deviation + mean


def clock_text(day: str, row_id: Column | str, stream: int) -> Column:
    """``day HH:MM:00`` with drawn hour and minute."""
    hour = F.lpad(below(row_id, stream, 24).cast("string"), 2, "0")
    minute = F.lpad(below(row_id, stream + 1, 60).cast("string"), 2, "0")
    return F.concat(F.lit(day + " "), hour, F.lit(":"), minute, F.lit(":00"))
