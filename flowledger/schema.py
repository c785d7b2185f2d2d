"""Column layout of raw lines, session records and rollup tables."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_LINES = T.StructType(
    [
        T.StructField("raw_message", T.StringType()),
        T.StructField("ingest_ts", T.TimestampType()),
    ]
)

# Keys of the JSON line format.
JSON_KEYS = (
    "ISODATE",
    "collector_id",
    "subscriber_id",
    "source_ip",
    "destination_ip",
    "source_port",
    "destination_port",
    "protocol",
    "service_type",
    "apn",
    "rat_type",
    "bytes_in",
    "bytes_out",
    "packets_in",
    "packets_out",
    "duration_seconds",
    "status",
)

# Every value is read as text: numbers may be bare or quoted, and the checks come later.
JSON_OBJECT = T.StructType([T.StructField(key, T.StringType()) for key in JSON_KEYS])

RECORDS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("collector_id", T.StringType()),
        T.StructField("subscriber_id", T.StringType()),
        T.StructField("subscriber_ip", T.StringType()),
        T.StructField("imsi", T.StringType()),
        T.StructField("imei", T.StringType()),
        T.StructField("msisdn", T.StringType()),
        T.StructField("source_ip", T.StringType()),
        T.StructField("destination_ip", T.StringType()),
        T.StructField("source_port", T.IntegerType()),
        T.StructField("destination_port", T.IntegerType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("service_type", T.StringType()),
        T.StructField("apn", T.StringType()),
        T.StructField("rat_type", T.StringType()),
        T.StructField("cell_id", T.StringType()),
        T.StructField("bytes_in", T.LongType()),
        T.StructField("bytes_out", T.LongType()),
        T.StructField("bytes_total", T.LongType()),
        T.StructField("packets_in", T.LongType()),
        T.StructField("packets_out", T.LongType()),
        T.StructField("duration_seconds", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("cause_code", T.StringType()),
        T.StructField("charging_id", T.StringType()),
        T.StructField("raw_message", T.StringType()),
        T.StructField("parsed_at", T.TimestampType()),
    ]
)

RECORD_RETENTION_DAYS = 90
