"""Derived views over reports: alert levels, a usage histogram, and first-seen subscribers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowledger.functions.timestamps import Clock
from flowledger.operators import sketches
from flowledger.plans.reports import error_rate, peak_bandwidth, subscriber_usage_values, tcp_bandwidth_share
from flowledger.plans.tables import Tables

# Fixed values: (yellow from, red from) per report.
ERROR_RATE_STEPS = (1, 5)
TCP_SHARE_STEPS = (50, 90)
PEAK_BANDWIDTH_STEPS = (1_000_000_000, 10_000_000_000)


def level(value: Column, steps: tuple[float, float]) -> Column:
    """``green`` below the first step, ``yellow`` from it on, ``red`` from the second; NULL counts as green."""
    yellow, red = steps
    return F.when(value >= red, "red").when(value >= yellow, "yellow").otherwise("green")


def error_rate_level(tables: Tables, clock: Clock) -> DataFrame:
    return error_rate(tables, clock).withColumn("level", level(F.col("pct"), ERROR_RATE_STEPS))


def tcp_share_level(tables: Tables, clock: Clock) -> DataFrame:
    return tcp_bandwidth_share(tables, clock).withColumn("level", level(F.col("tcp_pct"), TCP_SHARE_STEPS))


def peak_bandwidth_level(tables: Tables, clock: Clock) -> DataFrame:
    return peak_bandwidth(tables, clock).withColumn("level", level(F.col("peak"), PEAK_BANDWIDTH_STEPS))


def usage_histogram(tables: Tables, clock: Clock, width: int = 1_048_576) -> DataFrame:
    """Number of today's subscriber rows per fixed-width band of bytes."""
    start = F.floor(F.col("total_bytes") / F.lit(float(width))) * F.lit(width)
    bands = subscriber_usage_values(tables, clock).groupBy(start.cast("bigint").alias("bucket_start"))
    return bands.agg(F.count(F.lit(1)).alias("subscriber_rows")).orderBy("bucket_start")


def new_and_returning(tables: Tables, clock: Clock, days: int = 7) -> DataFrame:
    """Per day, subscribers seen for the first time in the kept data and those seen before.

    Where a store keeps first days, both are counted from the last days alone; then first means of all lines ever stored,
    expired or not. Else the rollup is reduced to one row per subscriber and day, so a window never holds more rows than
    there are kept days, however busy the subscriber. A store with sketches takes differences and intersections of those of
    the days.
    """
    since = clock.days_ago(days)
    if tables.day_sketches is not None:
        return sketches.new_and_returning(tables.day_sketches, since).orderBy("day")
    new = tables.newcomers(since)
    if new is not None:
        seen = tables.subscribers.filter(F.col("day") >= since).groupBy("day").agg(F.count_distinct("subscriber_id").alias("seen"))
        newly = F.coalesce(F.col("new_subscribers"), F.lit(0).cast("bigint"))
        counted = seen.join(new, "day", "left").select("day", newly.alias("new_subscribers"), (F.col("seen") - newly).alias("returning_subscribers"))
        return counted.orderBy("day")
    seen = tables.subscribers.select("day", "subscriber_id").distinct()
    first_day = F.min("day").over(Window.partitionBy("subscriber_id"))
    is_new = F.col("day") == F.col("first_day")
    return (
        seen.withColumn("first_day", first_day)
        .filter(F.col("day") >= since)
        .groupBy("day")
        .agg(F.count_if(is_new).alias("new_subscribers"), F.count_if(~is_new).alias("returning_subscribers"))
        .orderBy("day")
    )
