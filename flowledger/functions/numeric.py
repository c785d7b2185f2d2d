"""Division, units and empty-table defaults."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Floating division; NULL where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def gib(amount: Column) -> Column:
    return amount / F.lit(1073741824.0)


def mib(amount: Column) -> Column:
    return amount / F.lit(1048576.0)


def total(column: str | Column) -> Column:
    """Sum that is 0, not NULL, over no rows; NULL beyond 64 bits or where an addend is unknown."""
    return F.when(F.count(F.lit(1)) == 0, F.lit(0).cast("bigint")).otherwise(try_total(column))


def try_total(value: str | Column) -> Column:
    """Sum that is NULL beyond 64 bits, and NULL if one addend is: an unknown part makes the whole unknown."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(F.count(value) == F.count(F.lit(1)), F.try_sum(value))


def peak(column: str) -> Column:
    """Maximum that is 0, not NULL, over no rows."""
    return F.coalesce(F.max(column), F.lit(0).cast("bigint"))
