"""Traffic per second, minute and hour, each made from the finer one, and the fewest of its rows that cover a range.

Times of records are whole seconds, so buckets of seconds answer any range; whole minutes and hours inside it are taken
from the coarser tables, and only the ragged ends from the finer ones.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from flowledger.functions.numeric import try_total
from flowledger.operators.rollups import SESSIONS

UNITS = ("second", "minute", "hour")
SUMS = ("bytes_in", "bytes_out", "bytes_total")
RETENTION_DAYS = 90


def as_series(records: DataFrame) -> DataFrame:
    """Records as the finest series there is: one row each."""
    day = [F.col("day")] if "day" in records.columns else []
    return records.select(F.col("timestamp").alias("t"), *day, F.lit(1).cast("bigint").alias(SESSIONS), *SUMS)


def added_up(series: DataFrame, unit: str) -> DataFrame:
    """Rows of a finer series, or parts of the same one, put together: (t, day, session_count, sums)."""
    grouped = series.groupBy(F.date_trunc(unit, "t").alias("t"), F.to_date("t").alias("day"))
    return grouped.agg(F.sum(SESSIONS).alias(SESSIONS), *[try_total(name).alias(name) for name in SUMS])


def all_series(records: DataFrame) -> dict[str, DataFrame]:
    """The series of all units."""
    series, finer = {}, as_series(records)
    for unit in UNITS:
        finer = series[unit] = added_up(finer, unit)
    return series


def _up(moment: Column, unit: str) -> Column:
    start = F.date_trunc(unit, moment)
    return F.when(start == moment, start).otherwise(start + F.expr(f"INTERVAL 1 {unit}"))


def _between(start: Column, stop: Column) -> Column:
    """``start <= t < stop``, with the days this implies, so that scans skip partitions."""
    return (F.col("t") >= start) & (F.col("t") < stop) & F.col("day").between(F.to_date(start), F.to_date(stop))


def covering(series_of: Callable[[str], DataFrame], start: Column, end: Column, coarsest: str = "hour") -> DataFrame:
    """Rows whose buckets together are ``start <= time <= end``, from the coarsest units that fit, up to ``coarsest``."""
    stop = F.date_trunc("second", end) + F.expr("INTERVAL 1 SECOND")
    units = UNITS[: UNITS.index(coarsest) + 1]
    spans = [(_up(start, unit), F.date_trunc(unit, stop)) for unit in units]
    parts = []
    for k, unit in enumerate(units):
        low, high = spans[k]
        wanted = _between(low, high)
        if k + 1 < len(units):  # what the coarser unit has stays out; it may have nothing
            inner_low, inner_high = spans[k + 1]
            wanted = F.when(inner_low < inner_high, _between(low, F.least(inner_low, high)) | _between(F.greatest(inner_high, low), high)).otherwise(wanted)
        parts.append(series_of(unit).filter(wanted))
    return reduce(DataFrame.unionByName, parts)
