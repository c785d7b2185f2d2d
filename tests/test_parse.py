"""Golden table of hand-written lines: every format, every fallback, every bad value."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowledger import schema
from flowledger.operators.parse import parse_records, quarantine, with_protocol_name

INGEST = dt.datetime(2024, 2, 1, 12, 0, 5, 678000)
INGEST_SECOND = dt.datetime(2024, 2, 1, 12, 0, 5)
EPOCH = dt.datetime(1970, 1, 1)

PAIRS = (
    "<134>1 2024-01-30T10:00:00.000Z edge7 natd 311 {kind} [nsess TRIG=\"OPKT\" PROTO=\"17\" SSUBIX=\"0\" IATYP=\"IPv4\""
    " USERNAME=\"cust007\" ISADDR=\"100.99.3.9\" IDADDR=\"8.8.8.8\" ISPORT=\"40000\" IDPORT=\"53\" XATYP=\"IPv4\""
    " XSADDR=\"59.1.1.1\" XDADDR=\"8.8.8.8\" XSPORT=\"41000\" XDPORT=\"53\"] time='2024-01-30 10:00:01'."
)
TRACKED = (
    "2024-01-30T11:00:00.123+05:00  TAG-1: LABEL-2 forward: in:<line-42> out:1234, connection-state:new,snat"
    " src-mac 02:00:5e:10:00:01, proto TCP (SYN), 10.10.1.2:5555->1.2.3.4:443, NAT"
    " (10.10.1.2:5555->163.61.137.100:5555)->1.2.3.4:443, len 60"
)
JSON = '{"ISODATE":"2024-01-30T12:00:00","subscriber_id":"s1"%s}'


CASES = {
    "pairs start": (PAIRS.format(kind="SADD"), dict(
        timestamp=dt.datetime(2024, 1, 30, 10, 0, 1), collector_id="edge7", subscriber_id="cust007",
        source_ip="::ffff:100.99.3.9", destination_ip="::ffff:8.8.8.8", source_port=40000, destination_port=53,
        protocol="17", service_type="nat_session", apn="", rat_type="IPv4", bytes_total=0, status="active",
        subscriber_ip="::", cell_id="", imsi="", parsed_at=INGEST_SECOND)),
    "pairs end is active too": (PAIRS.format(kind="SDEL"), dict(status="active")),
    "tracked": (TRACKED, dict(
        timestamp=dt.datetime(2024, 1, 30, 11, 0, 0), collector_id="LABEL-2", subscriber_id="line-42",
        source_ip="::ffff:10.10.1.2", destination_ip="::ffff:1.2.3.4", source_port=5555, destination_port=443,
        protocol="tcp", service_type="nat_session", rat_type="", status="")),
    "tracked with leading blank": (" " + TRACKED, dict(
        collector_id="TAG-1: LABEL-2", timestamp=INGEST_SECOND, subscriber_id="line-42")),
    "source glued to a word": ("in:<u> x10.1.1.1:80->2.2.2.2:90", dict(
        source_ip="::ffff:10.1.1.1", source_port=0, destination_ip="::ffff:2.2.2.2", destination_port=90)),
    "glued source before a clean one": ("in:<u> x10.1.1.1:80->9.9.9.9:70 7.7.7.7:60->2.2.2.2:90", dict(
        source_ip="::ffff:10.1.1.1", source_port=60, destination_ip="::ffff:9.9.9.9", destination_port=70)),
    "five numbers before the arrow": ("in:<u> 9.10.1.1.1:80 ->2.2.2.2:90", dict(
        source_ip="::ffff:10.1.1.1", source_port=80)),
    "json": (JSON % (',"collector_id":"c1","source_ip":"2001:DB8:0:0:0:0:0:1","destination_ip":"9.9.9.9",'
                     '"source_port":"70","destination_port":443,"protocol":"TCP","service_type":"web","apn":"net",'
                     '"rat_type":"5G","bytes_in":10,"bytes_out":"20","packets_in":1,"packets_out":2,'
                     '"duration_seconds":30,"status":"failed"'), dict(
        timestamp=dt.datetime(2024, 1, 30, 12), collector_id="c1", source_ip="2001:db8::1",
        destination_ip="::ffff:9.9.9.9", source_port=70, destination_port=443, protocol="tcp", service_type="web",
        apn="net", rat_type="5G", bytes_in=10, bytes_out=20, bytes_total=30, packets_in=1, packets_out=2,
        duration_seconds=30, status="failed")),
    "json inside a line": ('<13>Jan relay1 app {"subscriber_id":"s1","bytes_in":5} tail', dict(
        subscriber_id="s1", collector_id="app", bytes_in=5, timestamp=INGEST_SECOND, source_ip="::")),
    "json with blanks": ('{ "a": "x", "subscriber_id": "s1" }', dict(collector_id='"x",')),
    "compact json": (JSON % "", dict(collector_id="", source_port=0, status="", service_type="nat_session")),
    "broken json": ('{"subscriber_id":"s1", USERNAME="x" }', dict(subscriber_id="x")),
    "two objects are no json": ('{"subscriber_id":"s1"} {"subscriber_id":"s2"} in:<u9>', dict(subscriber_id="u9")),
    "listed objects are no json": ('[{"subscriber_id":"s1"},{"subscriber_id":"s2"}] in:<u9>', dict(subscriber_id="u9")),
    "single quotes are no json": ("{'subscriber_id':'s1'} in:<u9>", dict(subscriber_id="u9")),
    "closing before opening brace": ('} in:<u9> {', dict(subscriber_id="u9")),
    "mixed": ('{"subscriber_id":"s1"} ISADDR="5.5.5.5"', dict(subscriber_id="s1", source_ip="::ffff:5.5.5.5")),
    "empty json value falls through": ('{"subscriber_id":""} USERNAME="u1"', dict(subscriber_id="u1")),
    "empty pair falls through": ('USERNAME="" USERNAME="u2" in:<u3>', dict(subscriber_id="u2")),
    "bytes null": (JSON % ',"bytes_in":null', dict(bytes_in=0)),
    "bytes text": (JSON % ',"bytes_in":"abc"', dict(bytes_in=0)),
    "bytes negative": (JSON % ',"bytes_in":-1', dict(bytes_in=0)),
    "bytes fraction": (JSON % ',"bytes_in":1.5', dict(bytes_in=0)),
    "bytes beyond 64 bits": (JSON % ',"bytes_in":"99999999999999999999"', dict(bytes_in=0)),
    "bytes at 64 unsigned bits": (JSON % ',"bytes_in":"18446744073709551615"', dict(bytes_in=None, bytes_total=None)),
    "bytes just beyond them": (JSON % ',"bytes_in":"18446744073709551616"', dict(bytes_in=0)),
    "bytes add up beyond 64 bits": (
        JSON % ',"bytes_in":9223372036854775807,"bytes_out":1', dict(bytes_in=9223372036854775807, bytes_total=None)),
    "duration beyond 32 bits": (JSON % ',"duration_seconds":4294967296', dict(duration_seconds=0)),
    "duration at 32 bits": (JSON % ',"duration_seconds":4294967295', dict(duration_seconds=4294967295)),
    "port too large": (JSON % ',"source_port":70000', dict(source_port=0)),
    "empty port": (JSON % ',"source_port":"","x":"ISPORT=\\"7\\""', dict(source_port=0)),
    "port from the next format": ('{"subscriber_id":"s1","source_port":""} ISPORT="7"', dict(source_port=7)),
    "time with offset": ('{"ISODATE":"2024-01-30T12:00:00+05:00","subscriber_id":"s"}', dict(timestamp=dt.datetime(2024, 1, 30, 7))),
    "time with Z": ('{"ISODATE":"2024-01-30T12:00:00Z","subscriber_id":"s"}', dict(timestamp=dt.datetime(2024, 1, 30, 12))),
    "time with fraction": ('{"ISODATE":"2024-01-30 12:00:00.987","subscriber_id":"s"}', dict(timestamp=dt.datetime(2024, 1, 30, 12))),
    "unreadable time": ('{"ISODATE":"soon","subscriber_id":"s"}', dict(timestamp=EPOCH)),
    "status from json": ('{"subscriber_id":"s","status":"failed"} SADD', dict(status="failed")),
    "end without start": ("USERNAME=\"u\" SDEL", dict(status="success")),
    "object over two lines": ('{"subscriber_id":"s1",\n"bytes_in":7}', dict(bytes_in=7)),
}


@pytest.fixture(scope="module")
def parsed(spark):
    lines = spark.createDataFrame([(line, INGEST) for line, _ in CASES.values()], schema.RAW_LINES)
    rows = parse_records(lines).withColumns(
        {"timestamp": F.col("timestamp").cast("timestamp_ntz"), "parsed_at": F.col("parsed_at").cast("timestamp_ntz")}
    ).collect()
    return {row.raw_message: row.asDict() for row in rows}


@pytest.fixture(scope="module", autouse=True)
def utc_driver():
    """Local times on the Python side mean UTC, as on the Spark side."""
    import os
    import time

    old = os.environ.get("TZ")
    os.environ["TZ"] = "UTC"
    time.tzset()
    yield
    os.environ.pop("TZ") if old is None else os.environ.update(TZ=old)
    time.tzset()


@pytest.mark.parametrize("case", CASES)
def test_golden(case, parsed):
    line, expected = CASES[case]
    row = parsed[line]
    assert {name: row[name] for name in expected} == expected


def test_schema(spark):
    empty = parse_records(spark.createDataFrame([], schema.RAW_LINES))
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in schema.RECORDS]


def test_lines_without_subscriber_are_dropped(spark):
    lines = ["kernel: link up", "", "{}", '{"subscriber_id":""}', 'USERNAME=""', "in:<>", None]
    frame = spark.createDataFrame([(line, INGEST) for line in lines], schema.RAW_LINES)
    assert parse_records(frame).count() == 0
    assert quarantine(frame).count() == 0


def test_quarantine(spark):
    lines = ['{"subscriber_id":"a","source_ip":"999.1.1.1"}', '{"subscriber_id":"b","destination_ip":"x:y"}',
             '{"subscriber_id":"c"}']
    frame = spark.createDataFrame([(line, INGEST) for line in lines], schema.RAW_LINES)
    held = {row.raw_message: row.reason for row in quarantine(frame).collect()}
    assert held == {lines[0]: "source_ip: 999.1.1.1", lines[1]: "destination_ip: x:y"}
    assert [row.subscriber_id for row in parse_records(frame).collect()] == ["c"]


def test_status_by_message_kind(spark):
    frame = spark.createDataFrame([(PAIRS.format(kind="SDEL"), INGEST)], schema.RAW_LINES)
    assert parse_records(frame, status_mode="msgid").first().status == "success"
    with pytest.raises(ValueError):
        parse_records(frame, status_mode="other")


def test_protocol_name(spark):
    frame = spark.createDataFrame([(PAIRS.format(kind="SADD"), INGEST), (TRACKED, INGEST)], schema.RAW_LINES)
    rows = with_protocol_name(parse_records(frame)).collect()
    assert {(row.protocol, row.protocol_name) for row in rows} == {("17", "udp"), ("tcp", "tcp")}


def test_json_is_parsed_once(spark):
    """Report filters stay above the JSON parse and do not repeat it."""
    lines = spark.createDataFrame([(TRACKED, INGEST)], schema.RAW_LINES)
    plan = parse_records(lines).filter("timestamp >= '2024-01-01' AND bytes_in > 0")._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("from_json(") == 1
