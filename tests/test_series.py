"""Traffic series: any range from the fewest rows, and reports that read no records."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowledger.functions.timestamps import Clock, literal_timestamp
from flowledger.operators import series
from flowledger.operators.parse import parse_records
from flowledger.plans.reports import REPORTS
from flowledger.plans.tables import Tables
from flowledger.sources.store import Store
from flowledger.streaming.ingest import write_batch
from tests.compare import spark_rows
from tests.test_days import lines_of

RANGE_REPORTS = ("Q01_logs_per_second", "Q02_bytes_per_second", "Q40_sessions_per_second", "Q41_throughput_per_minute", "Q46_sessions_in_range", "Q47_avg_bytes_per_session")
FIRST = dt.datetime(2024, 1, 29, 21, 0, 0)


def some_times(count, seed):
    rng = np.random.default_rng(seed)
    seconds = rng.integers(0, 6 * 3600, count)
    return [(f"u{i}", "10.0.0.1", (FIRST + dt.timedelta(seconds=int(s))).isoformat()) for i, s in enumerate(seconds)]


@pytest.fixture(scope="module")
def rows():
    edges = [(f"u{k}", "10.0.0.2", f"2024-01-29T{t}") for k, t in enumerate(["22:00:00", "22:59:59", "23:00:00", "23:59:59", "21:30:00", "21:30:59"])]
    return some_times(400, 1) + edges


@pytest.fixture(scope="module")
def store(spark, rows, tmp_path_factory):
    """Two batches, of which one day is folded, and a late one."""
    store = Store(spark, str(tmp_path_factory.mktemp("series")))
    write_batch(store, lines_of(spark, rows[::3]), 0)
    write_batch(store, lines_of(spark, rows[1::3]), 1)
    store.compact(FIRST.date())
    write_batch(store, lines_of(spark, rows[2::3]), 2)
    return store


RANGES = [
    ("2024-01-29 21:00:00", "2024-01-30 02:59:59"), ("2024-01-29 21:17:13", "2024-01-30 01:02:03"), ("2024-01-29 22:00:00", "2024-01-29 22:59:59"),
    ("2024-01-29 22:00:01", "2024-01-29 23:00:00"), ("2024-01-29 22:10:00", "2024-01-29 22:20:30"), ("2024-01-29 22:10:10", "2024-01-29 22:10:40"),
    ("2024-01-29 22:10:40", "2024-01-29 22:11:20"), ("2024-01-29 23:59:59", "2024-01-29 23:59:59"), ("2024-01-29 21:00:00.5", "2024-01-29 23:00:00.9"), ("2024-01-30 02:00:00", "2024-01-29 22:00:00"),
]


@pytest.mark.parametrize("start, end", RANGES)
def test_ranges_are_covered_once(store, rows, start, end):
    """Every second of the range lies in exactly one bucket, for each coarsest unit."""
    low, high = (dt.datetime.fromisoformat(x) for x in (start, end))
    inside = [t for _, _, t in rows if low <= dt.datetime.fromisoformat(t) <= high]
    for unit in series.UNITS:
        found = store.traffic(literal_timestamp(start), literal_timestamp(end), unit).agg(F.sum("session_count"), F.sum("bytes_in")).first()
        assert (found[0] or 0, found[1] or 0) == (len(inside), 5 * len(inside)), unit


def test_reports_agree_with_records(spark, store, rows):
    direct = Tables.from_records(parse_records(lines_of(spark, rows)))
    clock = Clock("2024-01-30 12:00:00", "2024-01-29 21:17:13", "2024-01-30 01:02:03")
    for name in RANGE_REPORTS:
        assert spark_rows(REPORTS[name](store.tables(), clock)) == spark_rows(REPORTS[name](direct, clock)), name
    # 90 days before lies the last day's first hour: what is older has expired
    as_of = F.lit("2024-04-29 00:10:00").cast("timestamp")
    kept = store.tables(as_of)
    assert REPORTS["Q46_sessions_in_range"](kept, clock).first().sessions == kept.records.filter("timestamp <= '2024-01-30 01:02:03'").count() > 0


def test_whole_buckets_come_from_no_records(store):
    clock = Clock("2024-01-30 12:00:00", "2024-01-29 21:17:13", "2024-01-30 01:02:03")
    for name in RANGE_REPORTS:
        plan = REPORTS[name](store.tables(), clock)._jdf.queryExecution().executedPlan().toString()
        assert "raw_message" not in plan and "/records" not in plan and "series" in plan, name
    plan = REPORTS["Q46_sessions_in_range"](store.tables(), clock)._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" not in plan.split("Filter")[1]  # the ends are known when the query is planned
    hours = store.traffic(clock.range_start, clock.range_end).groupBy("t").count().count()
    assert hours < 3 + 2 * 59 + 2 * 60


def test_series_are_kept_with_closed_and_rebuilt_days(spark, rows, tmp_path):
    store = Store(spark, str(tmp_path))
    write_batch(store, lines_of(spark, rows[::2]), 0)
    store.close(FIRST.date())
    write_batch(store, lines_of(spark, rows[1::2]), 1)  # reopens the day
    for unit in series.UNITS:
        expected = series.all_series(parse_records(lines_of(spark, rows)))[unit]
        assert spark_rows(store.series(unit).select(expected.columns)) == spark_rows(expected), unit
