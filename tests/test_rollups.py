"""Properties of rollups and of putting them together from parts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowledger.operators.rollups import (
    ROLLUPS, build, measures_part, members_part, merge_measures, merge_members, merge_parts,
)
from flowledger.plans.queries import records_of
from tests.compare import spark_rows


@pytest.fixture(scope="module")
def records(spark, sf_dir):
    kept = records_of(spark, sf_dir).cache()
    yield kept
    kept.unpersist()


@pytest.mark.parametrize("name", ROLLUPS)
def test_sessions_add_up_to_records(name, records):
    total = build(records, ROLLUPS[name]).agg(F.sum("session_count")).first()[0]
    assert total == records.count()


@pytest.mark.parametrize("name", ["daily_aggregation", "hourly_traffic"])
def test_merge_is_the_same_in_any_order_and_grouping(name, records):
    rollup = ROLLUPS[name]
    thirds = [records.filter(F.hour("timestamp").between(low, low + 7)) for low in (0, 8, 16)]
    measures = [measures_part(part, rollup) for part in thirds]
    members = [members_part(part, rollup) for part in thirds]

    def union(parts):
        first, *rest = parts
        for part in rest:
            first = first.unionByName(part)
        return first

    left = union([merge_measures(union(measures[:2]), rollup), measures[2]])
    left_members = union([merge_members(union(members[:2]), rollup), members[2]])
    right = union([measures[2], merge_measures(union([measures[1], measures[0]]), rollup)])
    right_members = union([members[2], merge_members(union([members[1], members[0]]), rollup)])
    expected = spark_rows(build(records, rollup))
    assert spark_rows(merge_parts(left, rollup, left_members)) == expected
    assert spark_rows(merge_parts(right, rollup, right_members)) == expected


def test_sketches_estimate_distinct_counts(records):
    rollup = ROLLUPS["hourly_traffic"]
    exact = {tuple(r[k] for k in rollup.group_keys): r for r in build(records, rollup).collect()}
    parts = measures_part(records, rollup, sketches=True)
    for row in merge_parts(parts, rollup).collect():
        true = exact[tuple(row[k] for k in rollup.group_keys)]
        assert row.session_count == true.session_count
        for name in rollup.uniques:
            assert abs(row[name] - true[name]) <= max(1, 0.05 * true[name])


def test_approximate_build_keeps_exact_sums(records):
    rollup = ROLLUPS["top_applications"]
    columns = ["day", *rollup.keys, "session_count", "total_bytes"]
    assert spark_rows(build(records, rollup, approx=True).select(columns)) == spark_rows(
        build(records, rollup).select(columns)
    )


def test_sums_beyond_64_bits_do_not_fail(records):
    rollup = ROLLUPS["subscriber_bandwidth"]
    huge = records.limit(50).withColumns({"bytes_in": F.lit(2**62), "bytes_total": F.lit(2**62)})
    same_key = huge.withColumns({k: F.lit("x") for k in rollup.keys}).withColumn(
        "timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp")
    )
    row = build(same_key, rollup).first()
    assert (row.session_count, row.total_bytes, row.max_bytes_in_session) == (50, None, 2**62)


def test_hot_key_is_spread_by_distinct_value(records):
    """The first shuffle of a distinct count is on keys and value, after map-side combining."""
    hot = records.withColumn("service_type", F.lit("hot"))
    plan = build(hot, ROLLUPS["hourly_traffic"])._jdf.queryExecution().executedPlan().toString()
    first_exchange = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line][-1]
    assert "subscriber_id" in first_exchange and "destination_ip" in first_exchange
