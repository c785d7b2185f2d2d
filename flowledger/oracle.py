"""DuckDB SQL that gives the same rows as the package's queries, written from the query meanings alone."""

from __future__ import annotations

from flowledger.plans.event_lines import INGEST_TS, LARGE_LINE_SQL, LINE_SQL
from flowledger.plans.field_queries import PORT_TEXT_SQL

AS_OF = "2024-01-30 22:00:00"
START = "2024-01-30 00:00:00"
END = "2024-01-30 23:59:59"
RETENTION_EDGE = "2024-01-15 12:00:00"  # a retention that ends here cuts the data in two
RETENTION_NOW = "2024-04-15 12:00:00"

NOW = f"TIMESTAMP '{AS_OF}'"
TODAY = f"CAST({NOW} AS DATE)"

RAW = f"raw AS (SELECT event_id, {LINE_SQL} AS raw_message FROM events)"


def _json(key: str) -> str:
    return f"coalesce(json_extract_string(j, '$.{key}'), '')"


def _re(pattern: str, group: int = 1) -> str:
    quoted = pattern.replace("'", "''")
    return f"regexp_extract(raw_message, '{quoted}', {group})"


def _first(*options: str, default: str = "''") -> str:
    return "coalesce(" + ", ".join(f"nullif({option}, '')" for option in options) + f", {default})"


_QUAD = r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"


def _ip(text: str) -> str:
    return f"CASE WHEN {text} LIKE '%.%' THEN '::ffff:' || {text} ELSE {text} END"


def _number(key: str) -> str:
    return f"coalesce(TRY_CAST(nullif({_json(key)}, '') AS BIGINT), 0)"


# Patterns and keys of the line formats.
_TEXTS = {
    "time_text": _first(_json("ISODATE"), _re(r"time='([^']+)'"), _re(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2})")),
    "collector_id": _first(_json("collector_id"), _re(r"^\S+\s+\S+\s+(\S+)"), _re(r"(\S+:\s+\S+)\s+forward:")),
    "subscriber_id": _first(_json("subscriber_id"), _re(r'USERNAME="([^"]+)"'), _re(r"in:<([^>]+)>")),
    "source_text": _first(_json("source_ip"), _re(r'ISADDR="([^"]+)"'), _re(rf"({_QUAD}):[0-9]+\s*->"), default="'::'"),
    "destination_text": _first(_json("destination_ip"), _re(r'IDADDR="([^"]+)"'), _re(rf"->\s*({_QUAD}):[0-9]+"), default="'::'"),
    "source_port_text": _first(_json("source_port"), _re(r'ISPORT="([^"]+)"'), _re(rf"\b{_QUAD}:([0-9]+)\s*->"), default="'0'"),
    "destination_port_text": _first(_json("destination_port"), _re(r'IDPORT="([^"]+)"'), _re(rf"->\s*{_QUAD}:([0-9]+)"), default="'0'"),
    "protocol": "lower(" + _first(_json("protocol"), _re(r'PROTO="([^"]+)"'), _re(r"proto\s+(\w+)")) + ")",
    "service_type": _first(_json("service_type"), default="'nat_session'"),
    "apn": _json("apn"),
    "rat_type": _first(_json("rat_type"), _re(r'IATYP="([^"]+)"')),
    "bytes_in": _number("bytes_in"),
    "bytes_out": _number("bytes_out"),
    "packets_in": _number("packets_in"),
    "packets_out": _number("packets_out"),
    "duration_seconds": _number("duration_seconds"),
    "status": f"CASE WHEN {_json('status')} <> '' THEN {_json('status')} WHEN contains(raw_message, 'SADD') THEN 'active'"
    " WHEN contains(raw_message, 'SDEL') THEN 'success' ELSE '' END",
}


def parsed_from(raw: str = "raw") -> str:
    texts = ", ".join(f"{sql} AS {name}" for name, sql in _TEXTS.items())
    return (
        f"parsed AS (SELECT event_id, raw_message, {texts} FROM (SELECT *,"
        f" nullif(regexp_extract(raw_message, '\\{{.*\\}}', 0), '')::JSON AS j FROM {raw}))"
    )


PARSED = parsed_from()
RECORDS = f"""records AS (SELECT event_id, CAST(replace(time_text, 'T', ' ') AS TIMESTAMP) AS timestamp, collector_id,
  subscriber_id, '::' AS subscriber_ip, '' AS imsi, '' AS imei, '' AS msisdn, {_ip('source_text')} AS source_ip,
  {_ip('destination_text')} AS destination_ip, CAST(source_port_text AS INTEGER) AS source_port,
  CAST(destination_port_text AS INTEGER) AS destination_port, protocol, service_type, apn, rat_type, '' AS cell_id,
  bytes_in, bytes_out, bytes_in + bytes_out AS bytes_total, packets_in, packets_out, duration_seconds, status,
  '' AS cause_code, '' AS charging_id, raw_message, TIMESTAMP '{INGEST_TS}' AS parsed_at
  FROM parsed WHERE subscriber_id <> '')"""

_N = "CAST(count(*) AS BIGINT) AS session_count"
_ERR = "CAST(sum(CASE WHEN status <> 'success' THEN 1 ELSE 0 END) AS BIGINT) AS error_count"


def _s(column: str, name: str) -> str:
    return f"CAST(sum({column}) AS BIGINT) AS {name}"


def _u(column: str, name: str) -> str:
    return f"CAST(count(DISTINCT {column}) AS BIGINT) AS {name}"


_BYTES = ", ".join([_s("bytes_in", "total_bytes_in"), _s("bytes_out", "total_bytes_out"), _s("bytes_total", "total_bytes")])
_PACKETS = ", ".join([_s("packets_in", "total_packets_in"), _s("packets_out", "total_packets_out")])
_DURATION = _s("duration_seconds", "total_duration_sec")
_AVG_DURATION = "avg(duration_seconds) AS avg_duration_sec"
_DAY = "CAST(timestamp AS DATE) AS day"

# Keys and measures of the rollup tables.
ROLLUP_SQL = {
    "daily_aggregation": f"""SELECT {_DAY}, subscriber_id, service_type, apn, rat_type, {_N}, {_BYTES}, {_PACKETS},
      {_AVG_DURATION}, max(duration_seconds) AS max_duration_sec, {_DURATION}, {_ERR},
      {_u('destination_ip', 'unique_destinations')}, {_u('cell_id', 'unique_cells')}
      FROM records GROUP BY ALL""",
    "hourly_traffic": f"""SELECT date_trunc('hour', timestamp) AS hour, service_type, protocol, rat_type, {_N}, {_BYTES},
      {_PACKETS}, {_DURATION}, {_AVG_DURATION}, {_u('subscriber_id', 'unique_subscribers')},
      {_u('destination_ip', 'unique_destinations')}, {_ERR} FROM records GROUP BY ALL""",
    "top_destinations": f"""SELECT {_DAY}, destination_ip, service_type, protocol, {_N}, {_s('bytes_total', 'total_bytes')},
      {_s('packets_in + packets_out', 'total_packets')}, {_DURATION}, {_u('subscriber_id', 'unique_subscribers')},
      {_u('source_port', 'unique_source_ports')} FROM records GROUP BY ALL""",
    "top_applications": f"""SELECT {_DAY}, service_type, protocol, apn, {_N}, {_BYTES}, {_PACKETS}, {_DURATION},
      {_AVG_DURATION}, {_u('subscriber_id', 'unique_subscribers')},
      CASE WHEN sum(duration_seconds) > 0 THEN CAST(sum(bytes_total) AS DOUBLE) / CAST(sum(duration_seconds) AS DOUBLE)
        ELSE 0.0::DOUBLE END AS bytes_per_second FROM records GROUP BY ALL""",
    "subscriber_bandwidth": f"""SELECT {_DAY}, subscriber_id, service_type, rat_type, {_N}, {_BYTES},
      max(bytes_in) AS max_bytes_in_session, max(bytes_out) AS max_bytes_out_session, {_PACKETS}, {_DURATION},
      {_AVG_DURATION}, max(duration_seconds) AS max_duration_sec, {_ERR},
      {_u('destination_ip', 'unique_destinations')}, {_u('apn', 'unique_apns')} FROM records GROUP BY ALL""",
}


def with_records(select: str, raw: str = RAW) -> str:
    return f"WITH {raw}, {PARSED}, {RECORDS} {select}"


def with_rollup(name: str, select: str) -> str:
    return f"WITH {RAW}, {PARSED}, {RECORDS}, {name} AS ({ROLLUP_SQL[name]}) {select}"


_D, _H, _DST, _APP, _SUB = "daily_aggregation", "hourly_traffic", "top_destinations", "top_applications", "subscriber_bandwidth"
_RANGE = f"timestamp >= TIMESTAMP '{START}' AND timestamp <= TIMESTAMP '{END}'"
_SINCE_MIDNIGHT = f"timestamp >= date_trunc('day', {NOW})"
_IS_TODAY = f"day = {TODAY}"
_LAST_7 = f"day >= {TODAY} - 7"
_LAST_30 = f"day >= {TODAY} - 30"


def _gb(column: str = "total_bytes", name: str = "gb") -> str:
    return f"CAST(sum({column}) AS BIGINT) / 1073741824.0::DOUBLE AS {name}"


def _mb(column: str = "total_bytes", name: str = "mb") -> str:
    return f"CAST(sum({column}) AS BIGINT) / 1048576.0::DOUBLE AS {name}"


def _d(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def _ratio(numerator: str, denominator: str) -> str:
    return f"{_d(numerator)} / nullif({_d(denominator)}, 0)"


_SESSIONS = _s("session_count", "sessions")
_USERS = _s("unique_subscribers", "users")
_ERROR_SHARE = _ratio("sum(CASE WHEN status <> 'success' THEN 1 ELSE 0 END)", "count(*)") + " * 100"
_TCP_SHARE = _ratio("sum(CASE WHEN protocol = 'tcp' THEN total_bytes ELSE 0 END)", "sum(total_bytes)") + " * 100"
_BY_HOUR_TEXT = (
    f"SELECT CAST(hour(hour) AS VARCHAR) AS h, {_gb()} FROM {_H} WHERE hour >= {NOW} - INTERVAL 1 DAY GROUP BY 1 ORDER BY h"
)
_TODAY_BYTES = f"SELECT CAST(coalesce(sum(bytes_total), 0) AS BIGINT) AS total FROM records WHERE {_SINCE_MIDNIGHT}"
_PER_SECOND = f"FROM records WHERE {_RANGE} GROUP BY 1 ORDER BY 1"
_SUB_KEYS = "subscriber_id, service_type, rat_type"

# The reports. report -> (table it reads, SELECT)
REPORT_SELECTS: dict[str, tuple[str, str]] = {
    "Q01_logs_per_second": ("records", f"SELECT date_trunc('second', timestamp) AS t, count(*) AS c {_PER_SECOND}"),
    "Q02_bytes_per_second": ("records", f"SELECT date_trunc('second', timestamp) AS t, {_s('bytes_total', 'bytes')} {_PER_SECOND}"),
    "Q03_sessions_today": ("records", f"SELECT count(*) AS total FROM records WHERE {_SINCE_MIDNIGHT}"),
    "Q04_active_subscribers_5m": ("records", f"SELECT count(DISTINCT subscriber_id) AS active FROM records WHERE timestamp >= {NOW} - INTERVAL 300 SECOND"),
    "Q05_bandwidth_today": ("records", _TODAY_BYTES),
    "Q06_error_rate_5m": ("records", f"SELECT {_ERROR_SHARE} AS pct FROM records WHERE timestamp >= {NOW} - INTERVAL 300 SECOND"),
    "Q07_hourly_traffic_24h": (_H, _BY_HOUR_TEXT),
    "Q08_top_applications_today": (_APP, f"SELECT service_type, protocol, {_gb()}, {_SESSIONS}, {_USERS} FROM {_APP} WHERE {_IS_TODAY} GROUP BY ALL ORDER BY gb DESC, service_type, protocol LIMIT 10"),
    "Q09_top_subscribers_today": (_SUB, f"SELECT subscriber_id, total_bytes / 1073741824.0::DOUBLE AS gb, session_count, error_count FROM {_SUB} WHERE {_IS_TODAY} ORDER BY total_bytes DESC, {_SUB_KEYS} LIMIT 10"),
    "Q10_collectors": ("records", "SELECT DISTINCT collector_id FROM records ORDER BY collector_id"),
    "Q11_bandwidth_by_service": (_APP, f"SELECT service_type, {_gb()} FROM {_APP} WHERE {_IS_TODAY} GROUP BY ALL ORDER BY gb DESC, service_type LIMIT 15"),
    "Q12_bandwidth_by_apn": (_APP, f"SELECT apn, {_gb()} FROM {_APP} WHERE {_IS_TODAY} AND apn <> '' GROUP BY ALL ORDER BY gb DESC, apn"),
    "Q13_bandwidth_by_rat": (_SUB, f"SELECT rat_type, {_gb()} FROM {_SUB} WHERE {_IS_TODAY} AND rat_type <> '' GROUP BY ALL ORDER BY gb DESC, rat_type"),
    "Q14_daily_bandwidth_trend_30d": (_D, f"SELECT day, {_s('total_bytes_in', 'downstream')}, {_s('total_bytes_out', 'upstream')}, {_s('total_bytes', 'total')} FROM {_D} WHERE {_LAST_30} GROUP BY ALL ORDER BY day"),
    "Q15_top_app_apn_7d": (_APP, f"SELECT service_type, protocol, apn, {_gb()}, {_gb('total_bytes_in', 'gb_in')}, {_gb('total_bytes_out', 'gb_out')}, {_SESSIONS}, {_USERS} FROM {_APP} WHERE {_LAST_7} GROUP BY ALL ORDER BY gb DESC, service_type, protocol, apn LIMIT 10"),
    "Q16_service_bandwidth_daily_7d": (_APP, f"SELECT day, service_type, {_gb()} FROM {_APP} WHERE {_LAST_7} GROUP BY ALL ORDER BY day, service_type"),
    "Q17_service_throughput_7d": (_APP, f"SELECT day, service_type, {_ratio('sum(total_bytes)', 'sum(total_duration_sec)')} AS throughput FROM {_APP} WHERE {_LAST_7} AND total_duration_sec > 0 GROUP BY ALL ORDER BY day, service_type"),
    "Q18_bandwidth_total_today": ("records", _TODAY_BYTES),
    "Q19_peak_hourly_bandwidth_today": (_H, f"SELECT coalesce(max(total_bytes), 0) / 1048576.0::DOUBLE AS peak_mb FROM {_H} WHERE hour >= date_trunc('day', {NOW})"),
    "Q20_avg_bandwidth_per_service": (_APP, f"SELECT {_ratio('sum(total_bytes)', 'count(DISTINCT service_type)')} / 1048576.0::DOUBLE AS avg_mb FROM {_APP} WHERE {_IS_TODAY}"),
    "Q21_protocol_sessions_today": (_APP, f"SELECT protocol, {_SESSIONS} FROM {_APP} WHERE {_IS_TODAY} AND protocol <> '' GROUP BY ALL ORDER BY sessions DESC, protocol"),
    "Q22_protocol_bandwidth_today": (_APP, f"SELECT protocol, {_gb()} FROM {_APP} WHERE {_IS_TODAY} AND protocol <> '' GROUP BY ALL ORDER BY gb DESC, protocol"),
    "Q23_protocol_trend_7d": (_APP, f"SELECT day, protocol, {_SESSIONS} FROM {_APP} WHERE {_LAST_7} AND protocol <> '' GROUP BY ALL ORDER BY day, protocol"),
    "Q24_top_destinations_today": (_DST, f"SELECT destination_ip, protocol, {_gb()}, {_SESSIONS}, {_USERS} FROM {_DST} WHERE {_IS_TODAY} GROUP BY ALL ORDER BY gb DESC, destination_ip, protocol LIMIT 20"),
    "Q25_application_distribution": (_APP, f"SELECT service_type, {_gb()} FROM {_APP} WHERE {_IS_TODAY} AND service_type <> '' GROUP BY ALL ORDER BY gb DESC, service_type LIMIT 10"),
    "Q26_protocol_application_matrix": (_APP, f"SELECT protocol, service_type, {_gb()}, {_gb('total_bytes_in', 'gb_in')}, {_gb('total_bytes_out', 'gb_out')}, {_SESSIONS}, {_USERS}, {_ratio('sum(total_bytes)', 'sum(total_duration_sec)')} AS avg_throughput FROM {_APP} WHERE {_IS_TODAY} AND protocol <> '' AND service_type <> '' GROUP BY ALL ORDER BY gb DESC, protocol, service_type LIMIT 20"),
    "Q27_top_ports_today": ("records", f"SELECT destination_port, protocol, count(*) AS sessions, {_gb('bytes_total')} FROM records WHERE {_SINCE_MIDNIGHT} AND destination_port > 0 GROUP BY ALL ORDER BY sessions DESC, destination_port, protocol LIMIT 20"),
    "Q28_unique_protocols_today": (_APP, f"SELECT count(DISTINCT protocol) AS count FROM {_APP} WHERE {_IS_TODAY} AND protocol <> ''"),
    "Q29_tcp_bandwidth_share": (_APP, f"SELECT {_TCP_SHARE} AS tcp_pct FROM {_APP} WHERE {_IS_TODAY}"),
    "Q30_unique_services_today": (_APP, f"SELECT count(DISTINCT service_type) AS count FROM {_APP} WHERE {_IS_TODAY} AND service_type <> ''"),
    "Q31_top20_subscribers_today": (_SUB, f"SELECT subscriber_id, total_bytes / 1073741824.0::DOUBLE AS gb, total_bytes_in / 1073741824.0::DOUBLE AS gb_in, total_bytes_out / 1073741824.0::DOUBLE AS gb_out, session_count, error_count, unique_destinations, unique_apns FROM {_SUB} WHERE {_IS_TODAY} ORDER BY total_bytes DESC, {_SUB_KEYS} LIMIT 20"),
    "Q32_top_subscribers_7d": (_SUB, f"SELECT subscriber_id, {_gb()}, {_SESSIONS}, {_s('error_count', 'errors')}, count(DISTINCT service_type) AS services_used FROM {_SUB} WHERE {_LAST_7} GROUP BY ALL ORDER BY gb DESC, subscriber_id LIMIT 10"),
    "Q33_subscriber_count_trend_7d": (_SUB, f"SELECT day, count(DISTINCT subscriber_id) AS active_subscribers FROM {_SUB} WHERE {_LAST_7} GROUP BY ALL ORDER BY day"),
    "Q34_subscribers_with_errors": (_SUB, f"SELECT subscriber_id, session_count, error_count, {_d('error_count')} / {_d('session_count')} * 100 AS error_pct, total_bytes / 1073741824.0::DOUBLE AS gb FROM {_SUB} WHERE {_IS_TODAY} AND error_count > 0 ORDER BY error_count DESC, {_SUB_KEYS} LIMIT 20"),
    "Q35_subscribers_30d": (_SUB, f"SELECT count(DISTINCT subscriber_id) AS total FROM {_SUB} WHERE {_LAST_30}"),
    "Q36_avg_usage_per_subscriber_7d": (_SUB, f"SELECT {_ratio('sum(total_bytes)', 'count(DISTINCT subscriber_id)')} AS avg_bytes FROM {_SUB} WHERE {_LAST_7}"),
    "Q37_subscriber_usage_values": (_SUB, f"SELECT total_bytes FROM {_SUB} WHERE {_IS_TODAY}"),
    "Q38_subscriber_rows_daily_7d": (_SUB, f"SELECT day, count(*) AS subscribers FROM {_SUB} WHERE {_LAST_7} GROUP BY ALL ORDER BY day"),
    "Q39_top_subscriber_service": (_SUB, f"SELECT subscriber_id, service_type, {_gb()}, {_SESSIONS} FROM {_SUB} WHERE {_IS_TODAY} GROUP BY ALL ORDER BY gb DESC, subscriber_id, service_type LIMIT 20"),
    "Q40_sessions_per_second": ("records", f"SELECT date_trunc('second', timestamp) AS t, count(*) AS sessions {_PER_SECOND}"),
    "Q41_throughput_per_minute": ("records", f"SELECT date_trunc('minute', timestamp) AS t, {_s('bytes_in', 'downstream')}, {_s('bytes_out', 'upstream')} {_PER_SECOND}"),
    "Q42_hourly_pattern_24h": (_H, _BY_HOUR_TEXT),
    "Q43_traffic_by_rat_24h": (_H, f"SELECT date_trunc('hour', hour) AS t, rat_type, {_mb()} FROM {_H} WHERE hour >= {NOW} - INTERVAL 1 DAY GROUP BY ALL ORDER BY t, rat_type"),
    "Q44_peak_hour_heatmap_7d": (_H, f"SELECT date_trunc('hour', hour) AS t, CAST(hour(hour) AS VARCHAR) AS h, {_mb()} FROM {_H} WHERE hour >= {NOW} - INTERVAL 7 DAY GROUP BY ALL ORDER BY t, h"),
    "Q45_daily_traffic_trend_30d": (_H, f"SELECT CAST(date_trunc('day', hour) AS TIMESTAMP) AS t, {_SESSIONS}, {_gb()} FROM {_H} WHERE hour >= {NOW} - INTERVAL 30 DAY GROUP BY ALL ORDER BY t"),
    "Q46_sessions_in_range": ("records", f"SELECT count(*) AS sessions FROM records WHERE {_RANGE}"),
    "Q47_avg_bytes_per_session": ("records", f"SELECT {_ratio('sum(bytes_total)', 'count(*)')} AS avg_bytes FROM records WHERE {_RANGE}"),
    "Q48_peak_bandwidth_5m": (_H, f"SELECT coalesce(max(total_bytes), 0) AS peak FROM {_H} WHERE hour >= {NOW} - INTERVAL 5 MINUTE"),
    "Q49_latest_records": ("records", "SELECT subscriber_id, source_ip, destination_ip, protocol FROM records ORDER BY timestamp DESC, subscriber_id, source_ip, destination_ip, protocol LIMIT 5"),
}


def _level(value: str, yellow: float, red: float) -> str:
    return f"CASE WHEN {value} >= {red} THEN 'red' WHEN {value} >= {yellow} THEN 'yellow' ELSE 'green' END AS level"


VIEW_SELECTS: dict[str, tuple[str, str]] = {
    "G1_error_rate_level": ("records", f"SELECT pct, {_level('pct', 1, 5)} FROM ({REPORT_SELECTS['Q06_error_rate_5m'][1]})"),
    "G1_tcp_share_level": (_APP, f"SELECT tcp_pct, {_level('tcp_pct', 50, 90)} FROM ({REPORT_SELECTS['Q29_tcp_bandwidth_share'][1]})"),
    "G1_peak_bandwidth_level": (_H, f"SELECT peak, {_level('peak', 1000000000, 10000000000)} FROM ({REPORT_SELECTS['Q48_peak_bandwidth_5m'][1]})"),
    "G2_usage_histogram": (_SUB, f"SELECT CAST(floor(total_bytes / 1048576.0::DOUBLE) AS BIGINT) * 1048576 AS bucket_start, count(*) AS subscriber_rows FROM {_SUB} WHERE {_IS_TODAY} GROUP BY 1 ORDER BY 1"),
    "G3_new_and_returning_7d": (_SUB, f"SELECT day, CAST(count(*) FILTER (WHERE day = first_day) AS BIGINT) AS new_subscribers, CAST(count(*) FILTER (WHERE day <> first_day) AS BIGINT) AS returning_subscribers FROM (SELECT DISTINCT day, subscriber_id FROM {_SUB}) JOIN (SELECT subscriber_id, min(day) AS first_day FROM {_SUB} GROUP BY 1) USING (subscriber_id) WHERE {_LAST_7} GROUP BY day ORDER BY day"),
}


def select_sql(table: str, select: str) -> str:
    return with_records(select) if table == "records" else with_rollup(table, select)


_SECOND = "date_trunc('second', ts)"
_DAY_START = "date_trunc('day', ts)"
TIMES_SELECT = f"""SELECT event_id, CAST(CASE event_id % 8
    WHEN 0 THEN {_SECOND}
    WHEN 1 THEN {_SECOND}
    WHEN 2 THEN {_SECOND} - INTERVAL 5 HOUR
    WHEN 3 THEN {_DAY_START}
    WHEN 4 THEN {_DAY_START} + INTERVAL 86398 SECOND
    WHEN 5 THEN {_DAY_START} + INTERVAL 36672 SECOND
    WHEN 6 THEN make_timestamp((1700000000 + event_id) * 1000000)
    ELSE TIMESTAMP '1970-01-01 00:00:00' END AS TIMESTAMP) AS timestamp FROM events"""
ADDRESSES_SELECT = """SELECT event_id, CASE event_id % 8
    WHEN 0 THEN '::ffff:10.0.' || CAST(user_id % 250 AS VARCHAR) || '.' || CAST(event_id % 250 AS VARCHAR)
    WHEN 1 THEN '2001:db8::' || lower(hex(1 + event_id % 65535))
    WHEN 2 THEN '2001:db8::1:0:0:' || lower(hex(1 + event_id % 65535))
    WHEN 3 THEN '::ffff:192.0.2.' || CAST(event_id % 250 AS VARCHAR)
    WHEN 4 THEN 'fe80::' || lower(hex(1 + user_id)) || ':0:0:1'
    WHEN 5 THEN '::ffff:10.1.0.' || CAST(event_id % 250 AS VARCHAR)
    ELSE NULL END AS ip FROM events"""
PORTS_SELECT = f"""SELECT event_id, CAST(CASE WHEN regexp_full_match(p, '[0-9]{{1,9}}') AND TRY_CAST(p AS BIGINT) <= 65535
    THEN TRY_CAST(p AS BIGINT) ELSE 0 END AS INTEGER) AS port FROM (SELECT event_id, {PORT_TEXT_SQL} AS p FROM events)"""
SPLIT_SELECT = f"""WITH {RAW} SELECT raw_message FROM raw
    UNION ALL SELECT 'device up ' || CAST(event_id AS VARCHAR) FROM raw"""
_GARBLED = f"""lines AS (SELECT event_id, {LINE_SQL} AS raw_message FROM events),
    raw AS (SELECT event_id, regexp_replace(raw_message, '203\\.0\\.113\\.', '203.0.913.', 'g') AS raw_message FROM lines)"""
QUARANTINE_SELECT = f"""WITH {_GARBLED}, {PARSED} SELECT raw_message, 'destination_ip: ' || destination_text AS reason
    FROM parsed WHERE subscriber_id <> '' AND destination_text LIKE '203.0.913.%'"""
BY_KIND_SELECT = """SELECT CASE WHEN json_extract_string(j, '$.status') <> '' THEN json_extract_string(j, '$.status')
    WHEN regexp_matches(raw_message, '\\bSADD\\b') THEN 'active'
    WHEN regexp_matches(raw_message, '\\bSDEL\\b') THEN 'success' ELSE '' END AS status, count(*) AS sessions
    FROM (SELECT *, nullif(regexp_extract(raw_message, '\\{.*\\}', 0), '')::JSON AS j FROM records) GROUP BY 1"""
PROTOCOL_SELECT = """SELECT protocol, CASE protocol WHEN '6' THEN 'tcp' WHEN '17' THEN 'udp' WHEN '1' THEN 'icmp'
    WHEN '47' THEN 'gre' ELSE protocol END AS protocol_name, count(*) AS sessions FROM records GROUP BY ALL"""
HEADER_SELECT = "SELECT collector_id, count(*) AS sessions, CAST(sum(bytes_total) AS BIGINT) AS total_bytes FROM records GROUP BY 1"
BUCKET_SELECT = "SELECT time_bucket(INTERVAL 15 MINUTE, timestamp) AS t, count(*) AS sessions FROM records GROUP BY 1"
RETAINED_SELECT = f"""SELECT CAST(timestamp AS DATE) AS day, count(*) AS sessions FROM records
    WHERE timestamp > TIMESTAMP '{RETENTION_NOW}' - INTERVAL 90 DAY GROUP BY 1"""
MONTH_SELECT = "SELECT strftime(timestamp, '%Y%m') AS yyyymm, count(*) AS sessions FROM records GROUP BY 1"
ADHOC_SELECT = """SELECT service_type, count(*) AS sessions, CAST(sum(bytes_total) AS BIGINT) AS total_bytes
    FROM records GROUP BY 1"""


def _live(unit: str, measures: str) -> str:
    closed = "(SELECT max(timestamp) - INTERVAL 10 MINUTE FROM records)"
    return (
        f"SELECT * FROM (SELECT date_trunc('{unit}', timestamp) AS t, {measures} FROM records GROUP BY 1)"
        f" WHERE t + INTERVAL 1 {unit} <= {closed}"
    )


LARGE_SELECT = f"""WITH raw AS (SELECT ts, user_id, event_id, {LARGE_LINE_SQL} AS raw_message FROM events),
    counters AS (SELECT CAST(ts AS DATE) AS day, 'cust' || CAST(user_id % 40 AS VARCHAR) AS subscriber_id,
      CAST(json_extract_string(raw_message, '$.bytes_in') AS HUGEINT) AS bytes_in,
      CAST(json_extract_string(raw_message, '$.bytes_out') AS HUGEINT) AS bytes_out FROM raw)
    SELECT day, subscriber_id, count(*) AS session_count, TRY_CAST(sum(bytes_in) AS BIGINT) AS total_bytes_in,
      TRY_CAST(sum(bytes_out) AS BIGINT) AS total_bytes_out, TRY_CAST(sum(bytes_in + bytes_out) AS BIGINT) AS total_bytes
    FROM counters GROUP BY ALL"""


def _retained(name: str) -> str:
    edge = f"TIMESTAMP '{RETENTION_EDGE}'"
    bucket = "hour > " + edge if name == _H else f"day > CAST({edge} AS DATE)"
    return with_rollup(name, f"SELECT * FROM {name} WHERE {bucket}")


_SKETCHED_SUB = "* EXCLUDE (unique_destinations, unique_apns), true AS unique_destinations_close, true AS unique_apns_close"
_SKETCHED = "* EXCLUDE (unique_subscribers, unique_destinations), true AS unique_subscribers_close, true AS unique_destinations_close"
_RECORD_COLUMNS = "* EXCLUDE (event_id)"


def all_sql() -> dict[str, str]:
    """SQL by query name."""
    records = with_records(f"SELECT {_RECORD_COLUMNS} FROM records")
    same_records = ("P_records", "W1_streamed_records", "W1_replay_after_compaction", "W6_new_checkpoint", "W6_duplicate_delivery")
    sql = dict.fromkeys(same_records, records)
    sql |= {f"stored_{name}": select_sql(table, select) for name, (table, select) in REPORT_SELECTS.items()}
    sql |= {f"W5_retained_{name}": _retained(name) for name in ROLLUP_SQL}
    for number, name in enumerate(ROLLUP_SQL, start=1):
        sql[f"R{number}_{name}"] = with_records(ROLLUP_SQL[name])
        sql[f"R6_merged_{name}"] = with_records(ROLLUP_SQL[name])
        sql[f"W2_streamed_{name}"] = with_records(ROLLUP_SQL[name])
    for name, (table, select) in {**REPORT_SELECTS, **VIEW_SELECTS}.items():
        sql[name] = select_sql(table, select)
    return {
        **sql,
        "G3_stored_new_and_returning_7d": sql["G3_new_and_returning_7d"],
        "W3_closed_days": with_records(ROLLUP_SQL["daily_aggregation"]),
        "W3_rebuilt_rollup": with_records(ROLLUP_SQL["hourly_traffic"]),
        "S2_split_lines": SPLIT_SELECT,
        "P_quarantine": QUARANTINE_SELECT,
        "P_status_by_message_kind": with_records(BY_KIND_SELECT),
        "P_strip_header": with_records(HEADER_SELECT),
        "P_protocol_name": with_records(PROTOCOL_SELECT),
        "X5_best_effort_timestamp": TIMES_SELECT,
        "X6_canonical_ip": ADDRESSES_SELECT,
        "X7_unsigned_or_zero": PORTS_SELECT,
        "X11_fifteen_minute_buckets": with_records(BUCKET_SELECT),
        "X15_records_per_month": with_records(MONTH_SELECT),
        "W5_retained_per_day": with_records(RETAINED_SELECT),
        "W7_live_per_second": with_records(_live("second", f"count(*) AS sessions, {_s('bytes_total', 'bytes')}")),
        "W7_live_per_minute": with_records(
            _live("minute", f"{_s('bytes_in', 'downstream')}, {_s('bytes_out', 'upstream')}")
        ),
        "W7_live_with_fast_clock": with_records(_live("second", f"count(*) AS sessions, {_s('bytes_total', 'bytes')}")),
        "P_quarantine_stored": QUARANTINE_SELECT,
        "A2_large_counters": LARGE_SELECT,
        "R6_sketch_store_hourly_traffic": with_rollup(_H, f"SELECT {_SKETCHED} FROM {_H}"),
        "R6_sketch_store_subscriber_bandwidth": with_rollup(_SUB, f"SELECT {_SKETCHED_SUB} FROM {_SUB}"),
        "Q33_sketch_store_subscriber_count_trend_7d": with_rollup(_SUB, f"SELECT DISTINCT day, true AS active_subscribers_close FROM {_SUB} WHERE {_LAST_7}"),
        "Q35_sketch_store_subscribers_30d": "SELECT true AS total_close",
        "G3_sketch_store_new_and_returning_7d": with_rollup(_SUB, f"SELECT DISTINCT day, true AS new_subscribers_close, true AS returning_subscribers_close FROM {_SUB} WHERE {_LAST_7}"),
        "R6_merged_sketches_hourly_traffic": with_rollup(_H, f"SELECT {_SKETCHED} FROM {_H}"),
        "E3_adhoc_sql": with_records(ADHOC_SELECT),
    }
