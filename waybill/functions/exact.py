"""Sums of doubles that are the same in whatever order they are added up.

A double below 2**62 is a whole number and a fraction. The fraction is cut into
an upper and a lower part of 50 bits, which are whole numbers too; each step is
exact, as scaling by a power of two and taking the whole part off lose nothing.
The three are summed as decimals of 38 digits, of fixed width and without
rounding, so sums of sums are sums: over tasks, batches or refreshes.

Bits below 2**-100, which only a value under 2**-47 has, are cut off from each value by itself.
A value of 2**62 or more, infinite or not a number makes the mean that: infinite,
with the sign of the greatest in magnitude, or not a number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = float(1 << 50)
LIMIT = float(1 << 62)
PARTS = ("whole", "upper", "lower")
# A value out of range: 1 and 2 are infinite, minus and plus; 3 is no number. The greatest counts.
BEYOND = "beyond"


def exact_sum(value: Column, name: str) -> list[Column]:
    """Aggregates whose sums and, for `beyond`, maxima are those of all rows. NULLs do not count."""
    inside = F.abs(value) < LIMIT
    whole = _toward_zero(value)
    scaled = (value - whole) * SCALE
    upper = _toward_zero(scaled)
    lower = _toward_zero((scaled - upper) * SCALE)
    parts = dict(zip(PARTS, (whole, upper, lower)))
    sums = [F.coalesce(F.sum(F.when(inside, part.cast("bigint").cast("decimal(20,0)"))), F.lit(0)).cast("decimal(38,0)")
            .alias(f"{name}_{label}") for label, part in parts.items()]
    beyond = F.when(F.isnan(value), 3).when(value >= LIMIT, 2).when(value <= -LIMIT, 1)
    return [*sums, F.max(beyond).alias(f"{name}_{BEYOND}")]


def _toward_zero(value: Column) -> Column:
    """The whole part with the value's sign; what is left then has no more bits than the value."""
    return F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)).cast("double")


def names(name: str) -> tuple[str, ...]:
    return tuple(f"{name}_{label}" for label in (*PARTS, BEYOND))


def exact_total(name: str) -> Column:
    """The sum as a double: the parts carried over and added from the least."""
    whole, upper, lower = (F.col(f"{name}_{label}") for label in PARTS)
    unit = F.lit(1 << 50)

    def carried(part: Column) -> Column:
        return F.call_function("div", part, unit)

    upper = upper + carried(lower)
    rest = ((upper % unit).cast("double") + (lower % unit).cast("double") / SCALE) / SCALE
    total = (whole + carried(upper)).cast("double") + rest
    beyond = F.col(f"{name}_{BEYOND}")
    return (F.when(beyond == 3, F.lit(float("nan"))).when(beyond == 2, F.lit(float("inf")))
            .when(beyond == 1, F.lit(float("-inf"))).otherwise(total))


def exact_mean(name: str, count: Column) -> Column:
    """The mean from the parts and the number of values; NULL without values."""
    return F.when(count > 0, exact_total(name) / count)
