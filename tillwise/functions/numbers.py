"""Money sums and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minor_units(amount: Column, scale: int = 2) -> Column:
    """Amount as a whole number of 10^-scale units (cents by default). An amount with more decimals
    fails the job: rounding each row would change the sum."""
    units = amount * F.lit(float(10**scale))
    whole_units = F.rint(units)
    # a double with `scale` decimals, or a product of two, is a few units in the last place away from whole units
    near = F.abs(units - whole_units) <= F.greatest(F.abs(units) * F.lit(1e-15), F.lit(1e-6))
    refused = F.raise_error(F.concat(F.lit(f"more than {scale} decimals: "), amount.cast("string"))).cast("double")
    return F.when(amount.isNull() | near, whole_units).otherwise(refused).cast("bigint")


def exact_sum(amount: Column, scale: int = 2) -> Column:
    """Sum of amounts with `scale` decimals, the same whatever order the rows arrive in.

    Summing doubles depends on row order. Whole units add up exactly, and a BIGINT buffer stays in
    the fast hash aggregate, which a wide decimal does not. An overflow fails under ANSI mode.
    """
    return F.sum(minor_units(amount, scale)).cast("double") / F.lit(float(10**scale))


def whole(c: Column) -> Column:
    """Float to integer, rounding halves away from zero (a plain Spark cast cuts off)."""
    return F.round(c).cast("bigint")


def one_percent(c: Column) -> Column:
    """One percent of the whole-number amount, in double arithmetic."""
    return whole(c) * F.lit(0.01)
