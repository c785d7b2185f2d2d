"""Raw log lines in all three formats, derived row by row from an ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# One text for Spark (session time zone UTC) and DuckDB. Every 50th line is junk; the others take turns between
# JSON, key/value and connection-tracking lines.
LINE_SQL = """
  CASE
    WHEN event_id % 50 = 49 THEN 'kernel: link up port ' || CAST(event_id % 48 AS STRING)
    WHEN event_id % 3 = 0 THEN
      '{"ISODATE":"' || replace(CAST(date_trunc('second', ts) AS STRING), ' ', 'T') || '"'
      || ',"collector_id":"col-' || CAST(event_id % 4 AS STRING) || '"'
      || ',"subscriber_id":"cust' || CAST(user_id AS STRING) || '"'
      || ',"source_ip":"' || CASE WHEN event_id % 12 = 0 THEN '2001:db8::' || CAST(1 + user_id % 99 AS STRING)
           ELSE '10.0.' || CAST(user_id % 250 AS STRING) || '.' || CAST(event_id % 250 AS STRING) END || '"'
      || ',"destination_ip":"203.0.113.' || CAST(event_id % 40 AS STRING) || '"'
      || ',"source_port":"' || CAST(1024 + event_id % 60000 AS STRING) || '"'
      || ',"destination_port":' || CAST(CASE event_id % 4 WHEN 0 THEN 443 WHEN 1 THEN 80 WHEN 2 THEN 53 ELSE 0 END AS STRING)
      || ',"protocol":"' || CASE WHEN event_id % 4 < 3 THEN 'TCP' ELSE 'UDP' END || '"'
      || ',"service_type":"' || event_type || '"'
      || ',"apn":"' || CASE event_id % 5 WHEN 0 THEN '' ELSE 'apn' || CAST(event_id % 5 AS STRING) END || '"'
      || ',"rat_type":"' || CASE WHEN user_id % 2 = 0 THEN '4G' ELSE '5G' END || '"'
      || ',"bytes_in":' || CAST((event_id * 7919) % 1500000 AS STRING)
      || ',"bytes_out":"' || CAST((event_id * 104729) % 400000 AS STRING) || '"'
      || ',"packets_in":' || CAST(event_id % 900 AS STRING)
      || ',"packets_out":' || CAST(event_id % 700 AS STRING)
      || ',"duration_seconds":' || CAST((event_id * 31) % 3600 AS STRING)
      || ',"status":"' || CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END || '"}'
    WHEN event_id % 3 = 1 THEN
      '<134>1 ' || replace(CAST(date_trunc('second', ts) AS STRING), ' ', 'T') || '.000Z edge7 natd 311 '
      || CASE WHEN event_id % 5 < 3 THEN 'SADD' ELSE 'SDEL' END
      || ' [nsess TRIG="OPKT" PROTO="' || CASE event_id % 4 WHEN 0 THEN '6' WHEN 1 THEN '17' WHEN 2 THEN '1' ELSE '47' END
      || '" SSUBIX="0" IATYP="IPv4" USERNAME="cust' || CAST(user_id AS STRING)
      || '" ISADDR="100.99.' || CAST(user_id % 11 AS STRING) || '.' || CAST(1 + user_id % 250 AS STRING)
      || '" IDADDR="198.51.100.' || CAST(event_id % 60 AS STRING)
      || '" ISPORT="' || CAST(1024 + event_id % 60000 AS STRING)
      || '" IDPORT="' || CAST(CASE event_id % 4 WHEN 0 THEN 443 WHEN 1 THEN 80 WHEN 2 THEN 53 ELSE 8080 END AS STRING)
      || '" XATYP="IPv4" XSADDR="192.0.2.' || CAST(event_id % 200 AS STRING)
      || '" XDADDR="198.51.100.' || CAST(event_id % 60 AS STRING)
      || '" XSPORT="' || CAST(10000 + event_id % 50000 AS STRING) || '" XDPORT="443"] time=' || chr(39)
      || CAST(date_trunc('second', ts) AS STRING) || chr(39) || '.'
    ELSE
      replace(CAST(date_trunc('second', ts) AS STRING), ' ', 'T') || '.123+05:00  tag-' || CAST(event_id % 9 AS STRING)
      || ': node-' || CAST(event_id % 30 AS STRING) || '-gw' || CAST(event_id % 20 AS STRING)
      || ' forward: in:<line-' || CAST(user_id AS STRING) || '> out:' || CAST(1000 + event_id % 9000 AS STRING)
      || ', connection-state:new,snat src-mac 02:00:5e:10:00:01, proto '
      || CASE event_id % 4 WHEN 0 THEN 'TCP (ACK), ' WHEN 1 THEN 'TCP (SYN), ' WHEN 2 THEN 'UDP, ' ELSE 'ICMP, ' END
      || '10.10.' || CAST(user_id % 20 AS STRING) || '.' || CAST(event_id % 250 AS STRING) || ':' || CAST(1024 + event_id % 60000 AS STRING)
      || '->203.0.113.' || CAST(event_id % 50 AS STRING) || ':' || CAST(CASE event_id % 2 WHEN 0 THEN 443 ELSE 80 END AS STRING)
      || ', NAT (10.10.0.1:1->192.0.2.1:1)->203.0.113.1:443, len ' || CAST(40 + event_id % 1400 AS STRING)
  END
"""

# One JSON line per event; every fifth counter lies just below 2^63.
LARGE_LINE_SQL = """
  '{"ISODATE":"' || replace(CAST(date_trunc('second', ts) AS STRING), ' ', 'T') || '","subscriber_id":"cust'
  || CAST(user_id % 40 AS STRING) || '","bytes_in":"'
  || CASE WHEN event_id % 5 = 0 THEN '9223372036854775' || lpad(CAST(event_id % 800 AS STRING), 3, '0') ELSE CAST(event_id AS STRING) END
  || '","bytes_out":"' || CAST(event_id % 1000 AS STRING) || '"}'
"""

INGEST_TS = "2024-01-31 00:00:00"


def event_lines(events: DataFrame) -> DataFrame:
    """``event_id``, ``raw_message`` and ``ingest_ts`` for every event."""
    return events.select(
        "event_id", F.expr(LINE_SQL).alias("raw_message"), F.lit(INGEST_TS).cast("timestamp").alias("ingest_ts")
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")
