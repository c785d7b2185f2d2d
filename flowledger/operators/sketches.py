"""Theta sketches in place of distinct members: bounded bytes a key, merged by union, counted within a known error.

A sketch of up to ``2 ** LOG_ENTRIES`` values counts exactly. Beyond that the relative standard error of a count is
``2 ** (-LOG_ENTRIES / 2)``, 1.6 %; for an intersection or a difference of two sketches it is that share of the larger
one. Sketches are built and united before the shuffle, so a busy key sends one sketch a task, whatever its members.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowledger.operators.rollups import SESSIONS, Rollup, finished, measures_part, merge_measures

LOG_ENTRIES = 12
STANDARD_ERROR = 2 ** (-LOG_ENTRIES / 2)


def sketch_name(measure: str) -> str:
    return f"{measure}_theta"


def sketch_of(value: Column) -> Column:
    # sketches leave out empty text, which is a value like any other here; NULL stays none
    return F.theta_sketch_agg(F.concat(F.lit("="), value.cast("string")), LOG_ENTRIES)


def united(sketch: str) -> Column:
    return F.theta_union_agg(sketch, LOG_ENTRIES)


def sketched_part(records: DataFrame, rollup: Rollup) -> DataFrame:
    """Additive measures of one batch with a sketch for each distinct count."""
    return measures_part(records, rollup, more=[sketch_of(F.col(source)).alias(sketch_name(name)) for name, source in rollup.uniques.items()])


def merge_sketched(parts: DataFrame, rollup: Rollup) -> DataFrame:
    """Parts of equal keys folded into one; in any order the same counts."""
    return merge_measures(parts, rollup, more=[united(sketch_name(name)).alias(sketch_name(name)) for name in rollup.uniques])


def counted(parts: DataFrame, rollup: Rollup, closed: DataFrame | None = None) -> DataFrame:
    """Rollup rows from sketched parts; ``closed`` has finished counts, whose members all count as other ones."""
    additive = [*rollup.group_keys, SESSIONS, *rollup.sums, *rollup.maxima]
    names = {name: sketch_name(name) for name in rollup.uniques}
    rows = parts.select(*additive, *names.values(), *[F.lit(None).cast("bigint").alias(name) for name in names])
    if closed is not None:
        rows = rows.unionByName(closed.select(*additive, *[F.lit(None).cast("binary").alias(sketch) for sketch in names.values()], *names))
    known = lambda name: F.coalesce(F.sum(name), F.lit(0).cast("bigint"))
    counts = [(F.coalesce(F.theta_sketch_estimate(united(sketch)), F.lit(0).cast("bigint")) + known(name)).alias(name) for name, sketch in names.items()]
    return finished(merge_measures(rows, rollup, more=counts), rollup)


# Subscribers per day


def days_of(records: DataFrame) -> DataFrame:
    """(day, subscribers): a sketch of each day's subscribers."""
    return records.groupBy(F.to_date("timestamp").alias("day")).agg(sketch_of(F.col("subscriber_id")).alias("subscribers"))


def united_days(days: DataFrame) -> DataFrame:
    """One row a day."""
    return days.groupBy("day").agg(united("subscribers").alias("subscribers"))


def active_per_day(days: DataFrame) -> DataFrame:
    """(day, active_subscribers)"""
    return days.groupBy("day").agg(F.theta_sketch_estimate(united("subscribers")).alias("active_subscribers"))


def active_in_all(days: DataFrame) -> DataFrame:
    """(total): subscribers of all given days together."""
    return days.agg(F.coalesce(F.theta_sketch_estimate(united("subscribers")), F.lit(0).cast("bigint")).alias("total"))


def new_and_returning(days: DataFrame, since: Column) -> DataFrame:
    """(day, new_subscribers, returning_subscribers) from a day on: what a day's sketch has beyond the union of all
    earlier days, and in common with it.

    The window runs over one row of at most ``2 ** LOG_ENTRIES`` hashes for each kept day, not over subscribers.
    """
    before = united("subscribers").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1))
    rows = united_days(days).withColumn("before", before).filter(F.col("day") >= since)
    seen = F.theta_sketch_estimate("subscribers")
    new, returning = (F.theta_sketch_estimate(both("subscribers", "before")) for both in (F.theta_difference, F.theta_intersection))
    return rows.select("day", F.coalesce(new, seen).alias("new_subscribers"), F.coalesce(returning, F.lit(0).cast("bigint")).alias("returning_subscribers"))
