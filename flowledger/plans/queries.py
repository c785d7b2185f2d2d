"""Every query by name, each a function of a session and a folder that holds ``events.parquet``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowledger.oracle import AS_OF, END, RETENTION_NOW, START
from flowledger.functions.timestamps import Clock
from flowledger.operators.parse import parse_records
from flowledger.operators.rollups import DAILY, HOURLY, ROLLUPS, SUBSCRIBERS, Rollup
from flowledger.plans import field_queries, stored_queries, views
from flowledger.plans.event_lines import event_lines, read_events
from flowledger.plans.reports import REPORTS
from flowledger.plans.tables import Tables
from flowledger.session import configure

Query = Callable[[SparkSession, str], DataFrame]
CLOCK = Clock(AS_OF, START, END)


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    # parsing costs far more than moving a row once, so the rows of a single file are dealt over all cores
    return read_events(configure(spark), sf_dir).repartition(spark.sparkContext.defaultParallelism)


def records_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_records(event_lines(events_of(spark, sf_dir)))


def tables_of(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables.from_records(records_of(spark, sf_dir))


def plain_times(table: DataFrame) -> DataFrame:
    """Timestamps without time zone, as readers without a session time zone expect them."""
    return table.select(
        *[
            F.col(f.name).cast("timestamp_ntz") if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in table.schema.fields
        ]
    )


def _of_tables(plan: Callable[[Tables, Clock], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain_times(plan(tables_of(spark, sf_dir), CLOCK))


def _rollup(name: str) -> Query:
    return lambda spark, sf_dir: plain_times(tables_of(spark, sf_dir).rollup(name))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(records_of(spark, sf_dir))


RECORD_QUERIES: dict[str, Query] = {"P_records": _parsed}
ROLLUP_QUERIES: dict[str, Query] = {
    f"R{number}_{name}": _rollup(name) for number, name in enumerate(ROLLUPS, start=1)
}
REPORT_QUERIES: dict[str, Query] = {name: _of_tables(plan) for name, plan in REPORTS.items()}
VIEW_QUERIES: dict[str, Query] = {
    "G1_error_rate_level": _of_tables(views.error_rate_level),
    "G1_tcp_share_level": _of_tables(views.tcp_share_level),
    "G1_peak_bandwidth_level": _of_tables(views.peak_bandwidth_level),
    "G2_usage_histogram": _of_tables(views.usage_histogram),
    "G3_new_and_returning_7d": _of_tables(views.new_and_returning),
}


def _of_events(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain_times(plan(events_of(spark, sf_dir)))


def _of_records(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain_times(plan(records_of(spark, sf_dir)))


def _stored(plan: Callable[[SparkSession, str], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain_times(plan(spark, sf_dir))


def _streamed_rollup(rollup: Rollup) -> Query:
    return _stored(lambda spark, sf_dir: stored_queries.streamed_rollup(spark, sf_dir, rollup))


def _stored_report(name: str) -> Query:
    return _stored(lambda spark, sf_dir: REPORTS[name](stored_queries.streamed_store(spark, sf_dir).tables(), CLOCK))


def _retained_rollup(rollup: Rollup) -> Query:
    return _stored(lambda spark, sf_dir: stored_queries.retained_stored_rollup(spark, sf_dir, rollup))


def _merged_rollup(rollup: Rollup) -> Query:
    return _of_records(lambda records: stored_queries.merged_halves(records, rollup))


def _sketched_rollup(rollup: Rollup) -> Query:
    return lambda spark, sf_dir: plain_times(stored_queries.sketched_rollup(spark, sf_dir, records_of(spark, sf_dir), rollup))


def _sketched_report(plan: Callable[[Tables, Clock], DataFrame], keys: list[str]) -> Query:
    return lambda spark, sf_dir: plain_times(
        stored_queries.sketched_report(spark, sf_dir, records_of(spark, sf_dir), lambda tables: plan(tables, CLOCK), keys)
    )


FIELD_QUERIES: dict[str, Query] = {
    "S2_split_lines": _of_events(field_queries.lines_of_messages),
    "P_quarantine": _of_events(field_queries.quarantined_lines),
    "P_status_by_message_kind": _of_events(field_queries.records_by_message_kind),
    "P_strip_header": _of_events(field_queries.records_behind_header),
    "P_protocol_name": _of_records(field_queries.sessions_per_protocol_name),
    "X5_best_effort_timestamp": _of_events(field_queries.times),
    "X6_canonical_ip": _of_events(field_queries.addresses),
    "X7_unsigned_or_zero": _of_events(field_queries.ports),
    "X11_fifteen_minute_buckets": _of_records(field_queries.sessions_per_bucket),
}
STORED_QUERIES: dict[str, Query] = {
    "W1_streamed_records": _stored(stored_queries.streamed_records),
    **{f"W2_streamed_{name}": _streamed_rollup(rollup) for name, rollup in ROLLUPS.items()},
    **{f"R6_merged_{name}": _merged_rollup(rollup) for name, rollup in ROLLUPS.items()},
    "R6_merged_sketches_hourly_traffic": _of_records(lambda records: stored_queries.merged_sketches(records, HOURLY)),
    **{f"R6_sketch_store_{rollup.name}": _sketched_rollup(rollup) for rollup in (HOURLY, SUBSCRIBERS)},
    "Q33_sketch_store_subscriber_count_trend_7d": _sketched_report(REPORTS["Q33_subscriber_count_trend_7d"], ["day"]),
    "Q35_sketch_store_subscribers_30d": _sketched_report(REPORTS["Q35_subscribers_30d"], []),
    "G3_sketch_store_new_and_returning_7d": _sketched_report(views.new_and_returning, ["day"]),
    "W5_retained_per_day": _of_records(lambda records: stored_queries.retained_per_day(records, RETENTION_NOW)),
    "W7_live_per_second": _stored(lambda spark, sf_dir: stored_queries.live_rates(spark, sf_dir, per_second=True)),
    "W7_live_per_minute": _stored(lambda spark, sf_dir: stored_queries.live_rates(spark, sf_dir, per_second=False)),
    "W7_live_with_fast_clock": _stored(
        lambda spark, sf_dir: stored_queries.live_rates(spark, sf_dir, per_second=True, fast_clocks=True)
    ),
    "W3_closed_days": _stored(lambda spark, sf_dir: stored_queries.closed_days(spark, sf_dir, DAILY)),
    "W3_rebuilt_rollup": _stored(lambda spark, sf_dir: stored_queries.rebuilt_rollup(spark, sf_dir, HOURLY)),
    "W1_replay_after_compaction": _stored(stored_queries.streamed_records),
    "W6_new_checkpoint": _stored(stored_queries.records_of_two_streams),
    "W6_duplicate_delivery": _stored(stored_queries.records_delivered_twice),
    "P_quarantine_stored": _stored(stored_queries.stored_quarantine),
    "A2_large_counters": _of_events(stored_queries.large_counters),
    **{f"W5_retained_{name}": _retained_rollup(rollup) for name, rollup in ROLLUPS.items()},
    **{f"stored_{name}": _stored_report(name) for name in REPORTS},
    "G3_stored_new_and_returning_7d": _stored(
        lambda spark, sf_dir: views.new_and_returning(stored_queries.streamed_store(spark, sf_dir).tables(), CLOCK)
    ),
    "X15_records_per_month": _stored(stored_queries.records_per_month),
    "E3_adhoc_sql": _of_tables(lambda tables, clock: stored_queries.adhoc_sql(tables)),
}


def all_queries() -> dict[str, Query]:
    return {
        **RECORD_QUERIES,
        **ROLLUP_QUERIES,
        **REPORT_QUERIES,
        **VIEW_QUERIES,
        **FIELD_QUERIES,
        **STORED_QUERIES,
    }
