"""Stores whose distinct counts come from theta sketches: exact below the sketch's size, close above, in every form of a day."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from flowledger.functions.timestamps import Clock
from flowledger.operators import sketches
from flowledger.operators.parse import parse_records
from flowledger.operators.rollups import DAILY, HOURLY, ROLLUPS, build, merge_parts
from flowledger.plans.reports import REPORTS
from flowledger.plans.tables import Tables
from flowledger.plans.views import new_and_returning
from flowledger.sources.store import Store
from flowledger.streaming.ingest import write_batch
from tests.compare import spark_rows
from tests.test_days import DAY, OTHER, rows_of, same_as_batch, some


def files_of(store, name):
    return [os.path.join(at, f) for at, _, files in os.walk(store.base) if f"/{name}" in at for f in files]


def test_every_form_of_a_day(spark, tmp_path):
    """Few members, so the counts are exact: open, folded, closed, reopened by a late batch, rebuilt."""
    store = Store(spark, str(tmp_path), "sketch")
    first, second, late = some(0, 60) + some(0, 20, OTHER), some(30, 50), some(40, 90, addresses=14) + some(0, 5, OTHER)
    write_batch(store, rows_of(spark, first), 0)
    write_batch(store, rows_of(spark, second), 1)
    same_as_batch(store, rows_of(spark, first, second))
    store.compact([DAY, OTHER])
    same_as_batch(store, rows_of(spark, first, second))
    assert store.day_sketches().count() == 2
    store.close([DAY, OTHER])
    assert store.closed_days() == [OTHER, DAY] and store.measures(HOURLY).count() == 0
    same_as_batch(store, rows_of(spark, first, second))
    write_batch(store, rows_of(spark, late), 2)
    assert store.closed_days() == []
    same_as_batch(store, rows_of(spark, first, second, late))
    write_batch(store, rows_of(spark, late), 2)  # delivered again
    store.rebuild_rollups([DAY, OTHER])
    same_as_batch(store, rows_of(spark, first, second, late))
    assert not any(files_of(store, name) for name in ("members", "dictionary", "first_seen"))


def test_reports_on_subscribers_from_sketches_of_days(spark, tmp_path):
    store = Store(spark, str(tmp_path), "sketch")
    batches = [some(0, 60) + some(0, 20, OTHER), some(10, 80)]
    for number, batch in enumerate(batches):
        write_batch(store, rows_of(spark, batch), number)
    store.close(OTHER)
    clock, exact = Clock(f"{DAY}T20:00:00", f"{DAY}T00:00:00", f"{DAY}T20:00:00"), Tables.from_records(parse_records(rows_of(spark, *batches)))
    for plan in (REPORTS["Q33_subscriber_count_trend_7d"], REPORTS["Q35_subscribers_30d"], new_and_returning):
        found = plan(store.tables(), clock)
        assert spark_rows(found) == spark_rows(plan(exact, clock))
        assert all("/rollups/subscribers/sketches/" in file for file in found.inputFiles())
    rows = {r.day: (r.new_subscribers, r.returning_subscribers) for r in new_and_returning(store.tables(), clock).collect()}
    assert rows == {OTHER: (20, 0), DAY: (60, 20)}
    empty = sketches.active_in_all(store.day_sketches().limit(0)).first()
    assert empty.total == 0


def test_a_store_keeps_to_its_kind(spark, tmp_path):
    write_batch(Store(spark, str(tmp_path / "s"), "sketch"), rows_of(spark, some(0, 3)), 0)
    write_batch(Store(spark, str(tmp_path / "e")), rows_of(spark, some(0, 3)), 0)
    for name, other in (("s", "exact"), ("e", "sketch")):
        with pytest.raises(ValueError, match="begun with"):
            Store(spark, str(tmp_path / name), other)
    with pytest.raises(ValueError, match="'exact' or 'sketch'"):
        Store(spark, str(tmp_path), "guess")
    assert Store(spark, str(tmp_path / "e")).day_sketches() is None


def test_large_sets_are_close_and_odd_members_count(spark):
    """A key with most rows, merged from uneven parts that overlap; empty text is a value, NULL is none."""
    ids = spark.range(60_000, numPartitions=8)
    columns = {"timestamp": F.lit("2024-01-30 10:00:00").cast("timestamp"), "subscriber_id": F.concat(F.lit("u"), F.col("id") % 30_000), "service_type": F.lit("a"), "apn": F.lit(None).cast("string"), "rat_type": F.lit("")}
    destination = F.when(F.col("id") % 10 == 0, "").when(F.col("id") % 10 == 1, None).otherwise(F.lit("x"))
    numbers = {name: F.lit(1).cast("bigint") for name in ("bytes_in", "bytes_out", "bytes_total", "packets_in", "packets_out", "duration_seconds")}
    records = ids.withColumns({**columns, **numbers, "destination_ip": destination, "protocol": F.lit("tcp"), "status": F.lit("success"), "cell_id": F.lit(None).cast("string"), "source_port": F.lit(1)})
    parts = [records.filter("id < 50000"), records.filter("id >= 40000"), records.limit(0)]
    merged = sketches.counted(sketches.merge_sketched(sketches.sketched_part(parts[0], HOURLY).unionByName(sketches.sketched_part(parts[1], HOURLY)), HOURLY).unionByName(sketches.sketched_part(parts[2], HOURLY)), HOURLY).collect()
    assert len(merged) == 1 and merged[0].session_count == 70_000
    assert abs(merged[0].unique_subscribers - 30_000) <= 3 * sketches.STANDARD_ERROR * 30_000
    assert merged[0].unique_destinations == 2
    daily = sketches.counted(sketches.sketched_part(records.filter("id < 100"), DAILY), DAILY)
    assert spark_rows(daily) == spark_rows(build(records.filter("id < 100"), DAILY))
    for rollup in ROLLUPS.values():
        assert sketches.counted(sketches.sketched_part(parts[2], rollup), rollup).columns == merge_parts(sketches.sketched_part(parts[2], rollup), rollup, counts=build(parts[2], rollup).select(*rollup.group_keys, *rollup.uniques)).columns
