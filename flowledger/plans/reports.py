"""Operational reports: each takes the tables and a clock and returns a DataFrame.

Ties in ranked reports are broken by the key columns, so a top-k is always the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from flowledger.functions.numeric import gib, mib, peak, safe_div, total, try_total
from flowledger.functions.timestamps import Clock, bucket, hour_text, since
from flowledger.operators import sketches
from flowledger.plans.tables import Tables

Report = Callable[[Tables, Clock], DataFrame]
REPORTS: dict[str, Report] = {}


def report(name: str) -> Callable[[Report], Report]:
    """Registers a report under its name."""

    def register(function: Report) -> Report:
        REPORTS[name] = function
        return function

    return register


def _gb(column: str = "total_bytes", name: str = "gb") -> Column:
    return gib(try_total(column)).alias(name)


def _sum(column: str, name: str) -> Column:
    return try_total(column).alias(name)


def _top(table: DataFrame, measure: str, keys: list[str], count: int) -> DataFrame:
    return table.orderBy(F.desc(measure), *keys).limit(count)


def _in_range(tables: Tables, clock: Clock, coarsest: str) -> DataFrame:
    return tables.traffic(clock.range_start, clock.range_end, coarsest)


def _records_today(tables: Tables, clock: Clock) -> DataFrame:
    return since(tables.records, "timestamp", clock.midnight)


def _today(table: DataFrame, clock: Clock) -> DataFrame:
    return table.filter(F.col("day") == clock.today)


def _last_days(table: DataFrame, clock: Clock, days: int) -> DataFrame:
    """The last ``days`` whole days and today; like the source reports, without an upper bound."""
    return table.filter(F.col("day") >= clock.days_ago(days))


# Traffic over time


@report("Q01_logs_per_second")
def logs_per_second(tables: Tables, clock: Clock) -> DataFrame:
    per_second = _in_range(tables, clock, "second").groupBy(bucket("t", "second").alias("t"))
    return per_second.agg(F.sum("session_count").alias("c")).orderBy("t")


@report("Q02_bytes_per_second")
def bytes_per_second(tables: Tables, clock: Clock) -> DataFrame:
    per_second = _in_range(tables, clock, "second").groupBy(bucket("t", "second").alias("t"))
    return per_second.agg(_sum("bytes_total", "bytes")).orderBy("t")


@report("Q03_sessions_today")
def sessions_today(tables: Tables, clock: Clock) -> DataFrame:
    return _records_today(tables, clock).agg(F.count(F.lit(1)).alias("total"))


@report("Q04_active_subscribers_5m")
def active_subscribers(tables: Tables, clock: Clock) -> DataFrame:
    recent = since(tables.records, "timestamp", clock.ago("300 SECOND"))
    return recent.agg(F.count_distinct("subscriber_id").alias("active"))


@report("Q05_bandwidth_today")
def bandwidth_today(tables: Tables, clock: Clock) -> DataFrame:
    return _records_today(tables, clock).agg(total("bytes_total").alias("total"))


@report("Q06_error_rate_5m")
def error_rate(tables: Tables, clock: Clock) -> DataFrame:
    recent = since(tables.records, "timestamp", clock.ago("300 SECOND"))
    share = safe_div(F.count_if(F.col("status") != "success"), F.count(F.lit(1)))
    return recent.agg((share * 100).alias("pct"))


@report("Q07_hourly_traffic_24h")
def hourly_traffic(tables: Tables, clock: Clock) -> DataFrame:
    last_day = since(tables.hourly, "hour", clock.ago("1 DAY"))
    return last_day.groupBy(hour_text("hour").alias("h")).agg(_gb()).orderBy("h")


@report("Q08_top_applications_today")
def top_applications(tables: Tables, clock: Clock) -> DataFrame:
    keys = ["service_type", "protocol"]
    ranked = (
        _today(tables.applications, clock)
        .groupBy(*keys)
        .agg(_gb(), _sum("session_count", "sessions"), _sum("unique_subscribers", "users"))
    )
    return _top(ranked, "gb", keys, 10)


@report("Q09_top_subscribers_today")
def top_subscribers(tables: Tables, clock: Clock) -> DataFrame:
    today = _today(tables.subscribers, clock)
    rows = _top(today, "total_bytes", ["subscriber_id", "service_type", "rat_type"], 10)
    return rows.select("subscriber_id", gib(F.col("total_bytes")).alias("gb"), "session_count", "error_count")


@report("Q10_collectors")
def collectors(tables: Tables, clock: Clock) -> DataFrame:
    return tables.collectors.orderBy("collector_id")


# Bandwidth


@report("Q11_bandwidth_by_service")
def bandwidth_by_service(tables: Tables, clock: Clock) -> DataFrame:
    by_service = _today(tables.applications, clock).groupBy("service_type").agg(_gb())
    return _top(by_service, "gb", ["service_type"], 15)


@report("Q12_bandwidth_by_apn")
def bandwidth_by_apn(tables: Tables, clock: Clock) -> DataFrame:
    named = _today(tables.applications, clock).filter(F.col("apn") != "")
    return named.groupBy("apn").agg(_gb()).orderBy(F.desc("gb"), "apn")


@report("Q13_bandwidth_by_rat")
def bandwidth_by_rat(tables: Tables, clock: Clock) -> DataFrame:
    named = _today(tables.subscribers, clock).filter(F.col("rat_type") != "")
    return named.groupBy("rat_type").agg(_gb()).orderBy(F.desc("gb"), "rat_type")


@report("Q14_daily_bandwidth_trend_30d")
def daily_bandwidth_trend(tables: Tables, clock: Clock) -> DataFrame:
    return (
        _last_days(tables.daily, clock, 30)
        .groupBy("day")
        .agg(_sum("total_bytes_in", "downstream"), _sum("total_bytes_out", "upstream"), _sum("total_bytes", "total"))
        .orderBy("day")
    )


@report("Q15_top_app_apn_7d")
def top_application_apn(tables: Tables, clock: Clock) -> DataFrame:
    keys = ["service_type", "protocol", "apn"]
    ranked = (
        _last_days(tables.applications, clock, 7)
        .groupBy(*keys)
        .agg(
            _gb(),
            _gb("total_bytes_in", "gb_in"),
            _gb("total_bytes_out", "gb_out"),
            _sum("session_count", "sessions"),
            _sum("unique_subscribers", "users"),
        )
    )
    return _top(ranked, "gb", keys, 10)


@report("Q16_service_bandwidth_daily_7d")
def service_bandwidth_daily(tables: Tables, clock: Clock) -> DataFrame:
    daily = _last_days(tables.applications, clock, 7).groupBy("day", "service_type").agg(_gb())
    return daily.orderBy("day", "service_type")


@report("Q17_service_throughput_7d")
def service_throughput(tables: Tables, clock: Clock) -> DataFrame:
    timed = _last_days(tables.applications, clock, 7).filter(F.col("total_duration_sec") > 0)
    rate = safe_div(try_total("total_bytes"), try_total("total_duration_sec"))
    return timed.groupBy("day", "service_type").agg(rate.alias("throughput")).orderBy("day", "service_type")


@report("Q18_bandwidth_total_today")
def bandwidth_total(tables: Tables, clock: Clock) -> DataFrame:
    return bandwidth_today(tables, clock)


@report("Q19_peak_hourly_bandwidth_today")
def peak_hourly_bandwidth(tables: Tables, clock: Clock) -> DataFrame:
    today = since(tables.hourly, "hour", clock.midnight)
    return today.agg(mib(peak("total_bytes")).alias("peak_mb"))


@report("Q20_avg_bandwidth_per_service")
def average_bandwidth_per_service(tables: Tables, clock: Clock) -> DataFrame:
    share = safe_div(try_total("total_bytes"), F.count_distinct("service_type"))
    return _today(tables.applications, clock).agg(mib(share).alias("avg_mb"))


# Protocols and applications


@report("Q21_protocol_sessions_today")
def protocol_sessions(tables: Tables, clock: Clock) -> DataFrame:
    named = _today(tables.applications, clock).filter(F.col("protocol") != "")
    return named.groupBy("protocol").agg(_sum("session_count", "sessions")).orderBy(F.desc("sessions"), "protocol")


@report("Q22_protocol_bandwidth_today")
def protocol_bandwidth(tables: Tables, clock: Clock) -> DataFrame:
    named = _today(tables.applications, clock).filter(F.col("protocol") != "")
    return named.groupBy("protocol").agg(_gb()).orderBy(F.desc("gb"), "protocol")


@report("Q23_protocol_trend_7d")
def protocol_trend(tables: Tables, clock: Clock) -> DataFrame:
    named = _last_days(tables.applications, clock, 7).filter(F.col("protocol") != "")
    return named.groupBy("day", "protocol").agg(_sum("session_count", "sessions")).orderBy("day", "protocol")


@report("Q24_top_destinations_today")
def top_destinations(tables: Tables, clock: Clock) -> DataFrame:
    keys = ["destination_ip", "protocol"]
    ranked = (
        _today(tables.destinations, clock)
        .groupBy(*keys)
        .agg(_gb(), _sum("session_count", "sessions"), _sum("unique_subscribers", "users"))
    )
    return _top(ranked, "gb", keys, 20)


@report("Q25_application_distribution")
def application_distribution(tables: Tables, clock: Clock) -> DataFrame:
    named = _today(tables.applications, clock).filter(F.col("service_type") != "")
    return _top(named.groupBy("service_type").agg(_gb()), "gb", ["service_type"], 10)


@report("Q26_protocol_application_matrix")
def protocol_application_matrix(tables: Tables, clock: Clock) -> DataFrame:
    keys = ["protocol", "service_type"]
    ranked = (
        _today(tables.applications, clock)
        .filter((F.col("protocol") != "") & (F.col("service_type") != ""))
        .groupBy(*keys)
        .agg(
            _gb(),
            _gb("total_bytes_in", "gb_in"),
            _gb("total_bytes_out", "gb_out"),
            _sum("session_count", "sessions"),
            _sum("unique_subscribers", "users"),
            safe_div(try_total("total_bytes"), try_total("total_duration_sec")).alias("avg_throughput"),
        )
    )
    return _top(ranked, "gb", keys, 20)


@report("Q27_top_ports_today")
def top_ports(tables: Tables, clock: Clock) -> DataFrame:
    keys = ["destination_port", "protocol"]
    used = _records_today(tables, clock).filter(F.col("destination_port") > 0)
    ranked = used.groupBy(*keys).agg(F.count(F.lit(1)).alias("sessions"), _gb("bytes_total"))
    return _top(ranked, "sessions", keys, 20)


@report("Q28_unique_protocols_today")
def unique_protocols(tables: Tables, clock: Clock) -> DataFrame:
    named = _today(tables.applications, clock).filter(F.col("protocol") != "")
    return named.agg(F.count_distinct("protocol").alias("count"))


@report("Q29_tcp_bandwidth_share")
def tcp_bandwidth_share(tables: Tables, clock: Clock) -> DataFrame:
    tcp = try_total(F.when(F.col("protocol") == "tcp", F.col("total_bytes")).otherwise(0))
    share = safe_div(tcp, try_total("total_bytes"))
    return _today(tables.applications, clock).agg((share * 100).alias("tcp_pct"))


@report("Q30_unique_services_today")
def unique_services(tables: Tables, clock: Clock) -> DataFrame:
    named = _today(tables.applications, clock).filter(F.col("service_type") != "")
    return named.agg(F.count_distinct("service_type").alias("count"))


# Subscribers


@report("Q31_top20_subscribers_today")
def top20_subscribers(tables: Tables, clock: Clock) -> DataFrame:
    today = _today(tables.subscribers, clock)
    rows = _top(today, "total_bytes", ["subscriber_id", "service_type", "rat_type"], 20)
    return rows.select(
        "subscriber_id",
        gib(F.col("total_bytes")).alias("gb"),
        gib(F.col("total_bytes_in")).alias("gb_in"),
        gib(F.col("total_bytes_out")).alias("gb_out"),
        "session_count",
        "error_count",
        "unique_destinations",
        "unique_apns",
    )


@report("Q32_top_subscribers_7d")
def top_subscribers_week(tables: Tables, clock: Clock) -> DataFrame:
    ranked = (
        _last_days(tables.subscribers, clock, 7)
        .groupBy("subscriber_id")
        .agg(
            _gb(),
            _sum("session_count", "sessions"),
            _sum("error_count", "errors"),
            F.count_distinct("service_type").alias("services_used"),
        )
    )
    return _top(ranked, "gb", ["subscriber_id"], 10)


@report("Q33_subscriber_count_trend_7d")
def subscriber_count_trend(tables: Tables, clock: Clock) -> DataFrame:
    if tables.day_sketches is not None:
        return sketches.active_per_day(_last_days(tables.day_sketches, clock, 7)).orderBy("day")
    daily = _last_days(tables.subscribers, clock, 7).groupBy("day")
    return daily.agg(F.count_distinct("subscriber_id").alias("active_subscribers")).orderBy("day")


@report("Q34_subscribers_with_errors")
def subscribers_with_errors(tables: Tables, clock: Clock) -> DataFrame:
    failing = _today(tables.subscribers, clock).filter(F.col("error_count") > 0)
    rows = _top(failing, "error_count", ["subscriber_id", "service_type", "rat_type"], 20)
    return rows.select(
        "subscriber_id",
        "session_count",
        "error_count",
        (safe_div(F.col("error_count"), F.col("session_count")) * 100).alias("error_pct"),
        gib(F.col("total_bytes")).alias("gb"),
    )


@report("Q35_subscribers_30d")
def subscribers_month(tables: Tables, clock: Clock) -> DataFrame:
    if tables.day_sketches is not None:
        return sketches.active_in_all(_last_days(tables.day_sketches, clock, 30))
    return _last_days(tables.subscribers, clock, 30).agg(F.count_distinct("subscriber_id").alias("total"))


@report("Q36_avg_usage_per_subscriber_7d")
def average_usage_per_subscriber(tables: Tables, clock: Clock) -> DataFrame:
    share = safe_div(try_total("total_bytes"), F.count_distinct("subscriber_id"))
    return _last_days(tables.subscribers, clock, 7).agg(share.alias("avg_bytes"))


@report("Q37_subscriber_usage_values")
def subscriber_usage_values(tables: Tables, clock: Clock) -> DataFrame:
    return _today(tables.subscribers, clock).select("total_bytes")


@report("Q38_subscriber_rows_daily_7d")
def subscriber_rows_daily(tables: Tables, clock: Clock) -> DataFrame:
    if tables.day_sketches is not None:
        return sketches.active_per_day(_last_days(tables.day_sketches, clock, 7)).orderBy("day")
    daily = _last_days(tables.subscribers, clock, 7).groupBy("day")
    return daily.agg(F.count(F.lit(1)).alias("subscribers")).orderBy("day")


@report("Q39_top_subscriber_service")
def top_subscriber_service(tables: Tables, clock: Clock) -> DataFrame:
    keys = ["subscriber_id", "service_type"]
    ranked = _today(tables.subscribers, clock).groupBy(*keys).agg(_gb(), _sum("session_count", "sessions"))
    return _top(ranked, "gb", keys, 20)


# Traffic volume


@report("Q40_sessions_per_second")
def sessions_per_second(tables: Tables, clock: Clock) -> DataFrame:
    return logs_per_second(tables, clock).withColumnRenamed("c", "sessions")


@report("Q41_throughput_per_minute")
def throughput_per_minute(tables: Tables, clock: Clock) -> DataFrame:
    per_minute = _in_range(tables, clock, "minute").groupBy(bucket("t", "minute").alias("t"))
    return per_minute.agg(_sum("bytes_in", "downstream"), _sum("bytes_out", "upstream")).orderBy("t")


@report("Q42_hourly_pattern_24h")
def hourly_pattern(tables: Tables, clock: Clock) -> DataFrame:
    return hourly_traffic(tables, clock)


@report("Q43_traffic_by_rat_24h")
def traffic_by_rat(tables: Tables, clock: Clock) -> DataFrame:
    last_day = since(tables.hourly, "hour", clock.ago("1 DAY"))
    by_rat = last_day.groupBy(bucket("hour", "hour").alias("t"), "rat_type")
    return by_rat.agg(mib(try_total("total_bytes")).alias("mb")).orderBy("t", "rat_type")


@report("Q44_peak_hour_heatmap_7d")
def peak_hour_heatmap(tables: Tables, clock: Clock) -> DataFrame:
    week = since(tables.hourly, "hour", clock.ago("7 DAY"))
    by_hour = week.groupBy(bucket("hour", "hour").alias("t"), hour_text("hour").alias("h"))
    return by_hour.agg(mib(try_total("total_bytes")).alias("mb")).orderBy("t", "h")


@report("Q45_daily_traffic_trend_30d")
def daily_traffic_trend(tables: Tables, clock: Clock) -> DataFrame:
    month = since(tables.hourly, "hour", clock.ago("30 DAY"))
    by_day = month.groupBy(bucket("hour", "day").alias("t"))
    return by_day.agg(_sum("session_count", "sessions"), _gb()).orderBy("t")


@report("Q46_sessions_in_range")
def sessions_in_range(tables: Tables, clock: Clock) -> DataFrame:
    return _in_range(tables, clock, "hour").agg(total("session_count").alias("sessions"))


@report("Q47_avg_bytes_per_session")
def average_bytes_per_session(tables: Tables, clock: Clock) -> DataFrame:
    share = safe_div(try_total("bytes_total"), F.sum("session_count"))
    return _in_range(tables, clock, "hour").agg(share.alias("avg_bytes"))


@report("Q48_peak_bandwidth_5m")
def peak_bandwidth(tables: Tables, clock: Clock) -> DataFrame:
    recent = since(tables.hourly, "hour", clock.ago("5 MINUTE"))
    return recent.agg(peak("total_bytes").alias("peak"))


@report("Q49_latest_records")
def latest_records(tables: Tables, clock: Clock) -> DataFrame:
    shown = ["subscriber_id", "source_ip", "destination_ip", "protocol"]
    return tables.latest(5).orderBy(F.desc("timestamp"), *shown).limit(5).select(*shown)
