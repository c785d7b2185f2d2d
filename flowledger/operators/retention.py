"""Row-level retention: what a table still shows at a given moment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowledger.schema import RECORD_RETENTION_DAYS
from flowledger.operators.rollups import Rollup


def retained(table: DataFrame, column: str, days: int, now: Column) -> DataFrame:
    """Rows younger than ``days``; bounds are on bare columns, so they reach the scan and prune partitions."""
    oldest = now - F.make_dt_interval(F.lit(days))
    if column == "day":
        return table.filter(F.col("day") > F.to_date(oldest))
    rows = table.filter(F.col(column) > oldest)
    return rows.filter(F.col("day") >= F.to_date(oldest)) if "day" in table.columns else rows


def retained_records(records: DataFrame, now: Column) -> DataFrame:
    return retained(records, "timestamp", RECORD_RETENTION_DAYS, now)


def retained_rollup(table: DataFrame, rollup: Rollup, now: Column) -> DataFrame:
    return retained(table, rollup.bucket, rollup.retention_days, now)


def expired_count(records: DataFrame, now: Column) -> DataFrame:
    """Number of records past retention, among them those whose time could not be read (epoch)."""
    oldest = now - F.make_dt_interval(F.lit(RECORD_RETENTION_DAYS))
    return records.agg(
        F.count_if(F.col("timestamp") <= oldest).alias("expired"),
        F.count_if(F.col("timestamp") == F.lit("1970-01-01 00:00:00").cast("timestamp")).alias("unreadable_time"),
    )
