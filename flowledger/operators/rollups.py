"""The five rollup tables: what they hold, how they are computed, and how partial ones are put together.

A rollup can be computed in one go from all records of its keys (:func:`build`), or kept up batch by batch: each
batch adds one part of additive measures and one part of distinct members (:func:`measures_part`,
:func:`members_part`), and :func:`merge_parts` gives the same rows as :func:`build` would over all batches.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from flowledger.functions.numeric import safe_div, try_total

_TRAFFIC_SUMS = {
    "total_bytes_in": "bytes_in",
    "total_bytes_out": "bytes_out",
    "total_bytes": "bytes_total",
    "total_packets_in": "packets_in",
    "total_packets_out": "packets_out",
    "total_duration_sec": "duration_seconds",
}
_ERRORS = {"error_count": "CASE WHEN status <> 'success' THEN 1L ELSE 0L END"}
SESSIONS = "session_count"


@dataclass(frozen=True)
class Rollup:
    """One rollup table: time bucket, other keys, measures, and days to keep."""

    name: str
    bucket: str
    keys: tuple[str, ...]
    sums: Mapping[str, str]
    uniques: Mapping[str, str]
    columns: tuple[str, ...]
    retention_days: int
    maxima: Mapping[str, str] = field(default_factory=dict)

    @property
    def group_keys(self) -> tuple[str, ...]:
        return (self.bucket, *self.keys)

    @property
    def bucket_start(self) -> Column:
        if self.bucket == "hour":
            return F.date_trunc("hour", "timestamp").alias("hour")
        return F.to_date("timestamp").alias("day")


DAILY = Rollup(
    name="daily_aggregation",
    bucket="day",
    keys=("subscriber_id", "service_type", "apn", "rat_type"),
    sums={**_TRAFFIC_SUMS, **_ERRORS},
    maxima={"max_duration_sec": "duration_seconds"},
    uniques={"unique_destinations": "destination_ip", "unique_cells": "cell_id"},
    columns=(
        "session_count", "total_bytes_in", "total_bytes_out", "total_bytes", "total_packets_in", "total_packets_out",
        "avg_duration_sec", "max_duration_sec", "total_duration_sec", "error_count", "unique_destinations",
        "unique_cells",
    ),
    retention_days=365,
)
HOURLY = Rollup(
    name="hourly_traffic",
    bucket="hour",
    keys=("service_type", "protocol", "rat_type"),
    sums={**_TRAFFIC_SUMS, **_ERRORS},
    uniques={"unique_subscribers": "subscriber_id", "unique_destinations": "destination_ip"},
    columns=(
        "session_count", "total_bytes_in", "total_bytes_out", "total_bytes", "total_packets_in", "total_packets_out",
        "total_duration_sec", "avg_duration_sec", "unique_subscribers", "unique_destinations", "error_count",
    ),
    retention_days=90,
)
DESTINATIONS = Rollup(
    name="top_destinations",
    bucket="day",
    keys=("destination_ip", "service_type", "protocol"),
    sums={
        "total_bytes": "bytes_total",
        "total_packets": "try_add(packets_in, packets_out)",
        "total_duration_sec": "duration_seconds",
    },
    uniques={"unique_subscribers": "subscriber_id", "unique_source_ports": "source_port"},
    columns=(
        "session_count", "total_bytes", "total_packets", "total_duration_sec", "unique_subscribers",
        "unique_source_ports",
    ),
    retention_days=90,
)
APPLICATIONS = Rollup(
    name="top_applications",
    bucket="day",
    keys=("service_type", "protocol", "apn"),
    sums=_TRAFFIC_SUMS,
    uniques={"unique_subscribers": "subscriber_id"},
    columns=(
        "session_count", "total_bytes_in", "total_bytes_out", "total_bytes", "total_packets_in", "total_packets_out",
        "total_duration_sec", "avg_duration_sec", "unique_subscribers", "bytes_per_second",
    ),
    retention_days=180,
)
SUBSCRIBERS = Rollup(
    name="subscriber_bandwidth",
    bucket="day",
    keys=("subscriber_id", "service_type", "rat_type"),
    sums={**_TRAFFIC_SUMS, **_ERRORS},
    maxima={
        "max_bytes_in_session": "bytes_in",
        "max_bytes_out_session": "bytes_out",
        "max_duration_sec": "duration_seconds",
    },
    uniques={"unique_destinations": "destination_ip", "unique_apns": "apn"},
    columns=(
        "session_count", "total_bytes_in", "total_bytes_out", "total_bytes", "max_bytes_in_session",
        "max_bytes_out_session", "total_packets_in", "total_packets_out", "total_duration_sec", "avg_duration_sec",
        "max_duration_sec", "error_count", "unique_destinations", "unique_apns",
    ),
    retention_days=365,
)
ROLLUPS = {rollup.name: rollup for rollup in (DAILY, HOURLY, DESTINATIONS, APPLICATIONS, SUBSCRIBERS)}


def _derived() -> dict[str, Column]:
    """Measures that follow from the additive ones, so that merged and direct rows agree."""
    duration, sessions = F.col("total_duration_sec"), F.col(SESSIONS)
    return {
        "avg_duration_sec": safe_div(duration, sessions),
        "bytes_per_second": F.when(duration > 0, safe_div(F.col("total_bytes"), duration)).otherwise(F.lit(0.0)),
    }


def finished(table: DataFrame, rollup: Rollup) -> DataFrame:
    derived = _derived()
    return table.select(
        *rollup.group_keys, *[derived[name].alias(name) if name in derived else F.col(name) for name in rollup.columns]
    )


def _additive(rollup: Rollup) -> list[Column]:
    # counters that add up beyond 64 bits give NULL, in one go or merged, instead of failing the whole job
    return [
        F.count(F.lit(1)).alias(SESSIONS),
        *[try_total(F.expr(value)).alias(name) for name, value in rollup.sums.items()],
        *[F.max(F.expr(value)).alias(name) for name, value in rollup.maxima.items()],
    ]


def _grouped(records: DataFrame, rollup: Rollup):
    return records.groupBy(rollup.bucket_start, *rollup.keys)


def build(records: DataFrame, rollup: Rollup, approx: bool = False) -> DataFrame:
    """The rollup over all given records.

    Distinct counts are exact unless ``approx``. Exact ones are spread over the distinct values before they are
    counted, and all measures are combined before the shuffle, so a key with most of the rows is no hot spot.
    """
    count_unique = F.approx_count_distinct if approx else F.count_distinct
    uniques = [count_unique(F.col(source)).alias(name) for name, source in rollup.uniques.items()]
    return finished(_grouped(records, rollup).agg(*_additive(rollup), *uniques), rollup)


def measures_part(records: DataFrame, rollup: Rollup, sketches: bool = False, more: Iterable[Column] = ()) -> DataFrame:
    """Additive measures of one batch; with ``sketches`` also one HyperLogLog sketch per distinct count. ``more``: further
    aggregates."""
    sketched = [
        F.hll_sketch_agg(F.col(source).cast("string")).alias(f"{name}_sketch")
        for name, source in rollup.uniques.items()
        if sketches
    ]
    return _grouped(records, rollup).agg(*_additive(rollup), *sketched, *more)


def members_part(records: DataFrame, rollup: Rollup) -> DataFrame:
    """Distinct (keys, measure, member) rows of one batch, from which distinct counts are exact after any merge."""
    members = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), F.col(source).cast("string").alias("member"))
            for name, source in rollup.uniques.items()
        ]
    )
    return records.select(rollup.bucket_start, *rollup.keys, F.inline(members)).distinct()


def merge_measures(parts: DataFrame, rollup: Rollup, more: Iterable[Column] = ()) -> DataFrame:
    """Parts of equal keys folded into one: sums added, maxima kept. Folding in any order gives the same rows."""
    sketches = [f"{name}_sketch" for name in rollup.uniques if f"{name}_sketch" in parts.columns]
    return parts.groupBy(*rollup.group_keys).agg(
        F.sum(SESSIONS).alias(SESSIONS),
        *[try_total(name).alias(name) for name in rollup.sums],
        *[F.max(name).alias(name) for name in rollup.maxima],
        *[F.hll_union_agg(name).alias(name) for name in sketches],
        *more,
    )


def merge_members(parts: DataFrame, rollup: Rollup) -> DataFrame:
    return parts.select(*rollup.group_keys, "measure", "member").distinct()


def merge_parts(measures: DataFrame, rollup: Rollup, members: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Rollup rows from parts: distinct counts as given in ``counts``, from ``members`` (exact), else from sketches in
    ``measures``.

    The member side joins on the rollup's own keys, which are unique on both sides; a report that reads no distinct
    count leaves it out of its plan altogether.
    """
    merged = merge_measures(measures, rollup)
    if counts is not None:
        return finished(merged.join(counts, list(rollup.group_keys), "left"), rollup)
    if members is None:
        estimates = {name: F.hll_sketch_estimate(f"{name}_sketch") for name in rollup.uniques}
        return finished(merged.withColumns(estimates), rollup)
    counts = (
        merge_members(members, rollup)
        .groupBy(*rollup.group_keys)
        .agg(*[F.count_if(F.col("measure") == name).alias(name) for name in rollup.uniques])
    )
    return finished(merged.join(counts, list(rollup.group_keys), "left"), rollup)


def merge_rollups(
    old: DataFrame, delta: DataFrame, rollup: Rollup, old_members: DataFrame | None = None,
    delta_members: DataFrame | None = None,
) -> DataFrame:
    """Rollup rows of two parts, as :func:`merge_parts` gives them for their union."""
    members = None if old_members is None else old_members.unionByName(delta_members)
    return merge_parts(old.unionByName(delta), rollup, members)
