"""Clustering on two columns at once: a space-filling curve over quantile ranks.

Rows sorted by one column keep narrow ranges of that column in each file, row group and page, and the whole range of any
other. Sorted by the interleaved bits of two ranks, they keep narrow ranges of both, so filters on either skip most of
the data. Ranks are those among quantiles of a bounded sample: they decide where rows lie, never what a query returns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

RANK_BITS = 6  # ranks from 0 to 2 ** RANK_BITS - 1
SAMPLE = 20_000  # rows the quantiles are taken from; as many go to the driver


def borders(rows: DataFrame, *values: Column) -> list[list]:
    """The quantiles between neighbouring ranks, one list for each value. A value with many rows is a border several
    times; the ranks between stay unused, and its rows are told apart by the other value."""
    n = rows.count()
    if not n:
        return [[] for _ in values]
    sample = rows.select(*[value.alias(f"v{k}") for k, value in enumerate(values)]).sample(min(1.0, SAMPLE / n), seed=0).collect()
    found = []
    for k in range(len(values)):
        held = sorted(row[k] for row in sample if row[k] is not None)
        found.append([held[len(held) * rank >> RANK_BITS] for rank in range(1, 1 << RANK_BITS)] if held else [])
    return found


def rank(value: Column, between: list) -> Column:
    """Number of borders up to the value; 0 for NULL."""
    if not between:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, between)), lambda border: border <= value)), F.lit(0))


def interleaved(first: Column, second: Column) -> Column:
    """The bits of both ranks in turn, those of ``first`` in the higher places."""
    bits = []
    for k in range(RANK_BITS):
        for place, value in ((2 * k + 1, first), (2 * k, second)):
            bits.append(F.shiftleft(F.shiftright(value, k).bitwiseAND(1), place))
    return reduce(Column.__add__, bits)


def with_curve(rows: DataFrame, first: Column, second: Column, name: str = "curve") -> DataFrame:
    """The rows with their place on the curve, by which they can be range-partitioned and sorted."""
    between = borders(rows, first, second)
    ranked = rows.withColumns({f"{name}_first": rank(first, between[0]), f"{name}_second": rank(second, between[1])})
    return ranked.withColumn(name, interleaved(F.col(f"{name}_first"), F.col(f"{name}_second"))).drop(f"{name}_first", f"{name}_second")
