"""Sums of doubles that don't depend on the order of addition.

Each value is cut into whole multiples of fixed units, 2^24 apart. Those are integers and
add up exactly in longs; the total is put together once, at the end. So the same rows give
the same bits however they are partitioned, and no rounding hides in between."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP_BITS = 24
# Exponents of the units. Values below 2^60 in size are cut, and what is left of a value below
# half of the last unit (4e-19) doesn't count. A part is at most 2^24, so some 5 x 10^11
# rows fit into one sum; beyond that Spark raises an overflow.
UNITS = (36, 12, -12, -36, -60)
LIMIT = 2.0**60


def _parts(value: Column) -> list[Column]:
    wholes = [F.rint(value * F.lit(2.0**-unit)) for unit in UNITS]
    step = F.lit(2.0**STEP_BITS)
    return [wholes[0], *[low - high * step for high, low in zip(wholes, wholes[1:])]]


def _put_together(sums: list[Column]) -> Column:
    """The total of sums that are not below zero in all: carried upwards, then added from
    the smallest unit to the largest."""
    carried = [sums[-1]]
    for s in reversed(sums[:-1]):
        carried.append(s + F.shiftright(carried[-1], STEP_BITS))
    rest = F.lit(2**STEP_BITS - 1).cast("long")
    total = F.lit(0.0)
    for unit, c in zip(reversed(UNITS), carried):
        part = c if unit == UNITS[0] else c.bitwiseAND(rest)
        total = total + part.cast("double") * F.lit(2.0**unit)
    return total


def exact_sum(value: Column) -> Column:
    """Aggregate: the sum of all non-null values, within an ulp of the true one and equal in every
    bit for any order of rows; null without any. Values of 2^60 and more, infinities and
    NaN are added as plain doubles and give up that promise for their group."""
    value = value.cast("double")
    inside = F.abs(value) < F.lit(LIMIT)
    sums = [F.coalesce(F.sum(F.when(inside, p).cast("long")), F.lit(0).cast("long")) for p in _parts(value)]
    negated = [-s for s in sums]
    # The top unit alone doesn't tell the sign; what is carried into it does.
    top = sums[-1]
    for s in reversed(sums[:-1]):
        top = s + F.shiftright(top, STEP_BITS)
    total = F.when(top < 0, -_put_together(negated)).otherwise(_put_together(sums))
    outside = F.coalesce(F.sum(F.when(~inside, value)), F.lit(0.0))
    return F.when(F.count(value) > 0, total + outside)


def exact_mean(value: Column) -> Column:
    """Aggregate: ``exact_sum`` over the number of non-null values."""
    return exact_sum(value) / F.count(value)
