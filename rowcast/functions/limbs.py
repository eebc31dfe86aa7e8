"""Sums of doubles without any rounding, in any order.

A double is a whole number times a power of two. It is cut into digits of 24
bits on a fixed grid of exponents, digit by digit from the top: what is taken
off is exact, and so is what remains. Digits are added up as whole numbers, with
map-side combining; carries are settled once at the end. Nothing is rounded
until the sum becomes a double again, and then once.

The grid reaches from ``2 ** -96`` to ``2 ** 96``: values of 7.9e28 and more are
refused, and bits below 1.3e-29 are cut. A digit's sum holds 2 ** 39 rows.
NULL, NaN and infinite values are left out.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24
LOWEST = -96
# Exponents of the digits, from the highest down.
GRID = list(range(LOWEST + 7 * BITS, LOWEST - 1, -BITS))
_LIMIT = float(2 ** (GRID[0] + BITS))


def digits(value: Column | str) -> Column:
    """The digits of a double as an array of whole numbers, all of the sign of the value."""
    value = F.col(value) if isinstance(value, str) else value
    value = value.cast("double")
    wide = F.raise_error(F.lit(f"a value of {_LIMIT:.0e} or more cannot be summed exactly"))
    rest = F.when(F.abs(value) < F.lit(float("inf")), F.when(F.abs(value) < F.lit(_LIMIT), value).otherwise(wide.cast("double")))
    # One fold over the grid: the digit taken off is exact, and so is what is left.
    steps = F.array(*[F.lit(float(2.0**e)) for e in GRID])
    start = F.struct(rest.alias("rest"), F.array().cast("array<bigint>").alias("taken"))

    def take(state: Column, step: Column) -> Column:
        digit = F.when(state["rest"] >= 0, F.floor(state["rest"] / step)).otherwise(F.ceil(state["rest"] / step)).cast("bigint")
        return F.struct((state["rest"] - digit.cast("double") * step).alias("rest"), F.concat(state["taken"], F.array(digit)).alias("taken"))

    return F.when(rest.isNotNull(), F.aggregate(steps, start, take, lambda state: state["taken"]))


def exact_sums(df: DataFrame, value: Column | str, *keys: str) -> DataFrame:
    """``keys``, ``value_count`` and ``sum`` (digits, settled) of ``value``: one aggregation."""
    rows = df.select(*keys, digits(value).alias("_d"))
    sums = [F.sum(F.col("_d")[i]).alias(f"_s{i}") for i in range(len(GRID))]
    summed = rows.groupBy(*keys).agg(F.count("_d").alias("value_count"), *sums)
    total = settled(F.array(*[F.col(f"_s{i}") for i in range(len(GRID))]))
    return summed.select(*keys, "value_count", F.when(F.col("value_count") > 0, total).alias("sum"))


def settled(sums: Column) -> Column:
    """Digit sums with carries taken upwards: every digit but the first is from 0 to ``2 ** 24 - 1``, so equal sums are equal arrays."""
    base = F.lit(1 << BITS).cast("bigint")
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("done"))

    def carry(state: Column, digit: Column) -> Column:
        whole = digit + state["carry"]
        low = F.pmod(whole, base)
        return F.struct(F.call_function("div", whole - low, base).alias("carry"), F.concat(F.array(low), state["done"]).alias("done"))

    def close(state: Column) -> Column:
        # What is left over goes back into the first digit, which so keeps the sign.
        first = state["done"][0] + state["carry"] * base
        return F.concat(F.array(first), F.slice(state["done"], 2, len(GRID) - 1))

    return F.aggregate(F.reverse(sums), start, carry, close)


def added(one: Column, other: Column) -> Column:
    """The exact sum of two settled sums, such as those of parts of a table."""
    return settled(F.zip_with(one, other, lambda a, b: a + b))


def negated(one: Column) -> Column:
    return settled(F.transform(one, lambda digit: -digit))


def _weighed(total: Column, low: int, high: int) -> Column:
    """Digits of exponents from ``low`` to below ``high``, in units of ``2 ** low``, as a decimal without decimals."""
    kept = [(i, e - low) for i, e in enumerate(GRID) if low <= e < high]
    terms = [(total[i].cast("decimal(38,0)") * F.lit(Decimal(1 << power)).cast("decimal(38,0)")).cast("decimal(38,0)") for i, power in kept]
    whole = terms[-1]
    for term in terms[-2::-1]:
        whole = (whole + term).cast("decimal(38,0)")
    return whole


def whole_part(total: Column | str) -> Column:
    """A settled sum rounded down to a whole number; sums of 1e38 and more are refused."""
    total = F.col(total) if isinstance(total, str) else total
    return _weighed(total, 0, GRID[0] + BITS)


def fraction(total: Column | str, bits: int = 72) -> Column:
    """What ``whole_part`` leaves, in units of ``2 ** -bits`` (a multiple of 24), rounded down."""
    total = F.col(total) if isinstance(total, str) else total
    return _weighed(total, -bits, 0)


def as_double(total: Column | str) -> Column:
    """A settled sum as the nearest double (ties to even): rounded once."""
    total = F.col(total) if isinstance(total, str) else total
    sign = F.when(total[0] < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    size = F.when(total[0] < 0, negated(total)).otherwise(total)
    # The first digit may hold many bits, so it is taken apart; then the leading 53 bits and more are in few digits.
    base = F.lit(1 << BITS).cast("bigint")
    wide = F.concat(
        F.array(F.call_function("div", size[0], base * base), F.pmod(F.call_function("div", size[0], base), base), F.pmod(size[0], base)),
        F.slice(size, 2, len(GRID) - 1),
    )
    exponents = F.array(*[F.lit(e) for e in [GRID[0] + 2 * BITS, GRID[0] + BITS, *GRID]])
    places = F.filter(F.sequence(F.lit(0), F.lit(len(GRID) + 1)), lambda i: F.get(wide, i) != 0)
    first = F.coalesce(F.get(places, F.lit(0)), F.lit(len(GRID) + 1))
    digit = lambda k: F.coalesce(F.get(wide, first + k), F.lit(0).cast("bigint"))
    # Three digits hold 49 to 72 bits. Whatever follows only decides ties, as one odd bit at the end.
    follows = F.exists(F.slice(wide, first + 4, len(GRID) + 2), lambda d: d != 0)
    lead = digit(0).cast("decimal(38,0)") * Decimal(1 << (2 * BITS + BITS + 2))
    rest = digit(1).cast("decimal(38,0)") * Decimal(1 << (2 * BITS + 2)) + digit(2).cast("decimal(38,0)") * Decimal(1 << (BITS + 2))
    rest = rest + digit(3).cast("decimal(38,0)") * Decimal(4) + F.when(follows, F.lit(Decimal(1))).otherwise(F.lit(Decimal(0)))
    exact = (lead + rest).cast("decimal(38,0)").cast("double")
    scale = F.pow(F.lit(2.0), (F.get(exponents, first) - (3 * BITS + 2)).cast("double"))
    return F.when(total.isNotNull(), sign * exact * scale)
