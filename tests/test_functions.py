from __future__ import annotations

import datetime as dt
import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from flowledger.functions.ip import canonical_ip
from flowledger.functions.numeric import safe_div
from flowledger.functions.text import extract, outer_object, unsigned_or_zero
from flowledger.functions.timestamps import Clock, best_effort_timestamp, bucket, hour_text, since, within


def _expected_ip(text: str) -> str:
    address = ipaddress.ip_address(text)
    if address.version == 4:
        return f"::ffff:{address}"
    groups = [(int(address) >> (112 - 16 * i)) & 0xFFFF for i in range(8)]
    tail = f"{groups[6] >> 8}.{groups[6] & 255}.{groups[7] >> 8}.{groups[7] & 255}"
    if groups[:6] == [0] * 5 + [0xFFFF]:
        return f"::ffff:{tail}"
    if groups[:6] == [0] * 6 and groups[6]:
        return f"::{tail}"
    return address.compressed


def test_canonical_ip_against_brute_force(spark):
    random.seed(7)
    cases = {}
    for i in range(1500):
        groups = [random.choice([0, 0, 0, 1, random.randrange(65536), 0xFFFF]) for _ in range(8)]
        if i % 7 == 0:
            groups[:5] = [0] * 5
        address = ipaddress.IPv6Address(sum(g << (112 - 16 * k) for k, g in enumerate(groups)))
        dotted = f"{groups[6] >> 8}.{groups[6] & 255}.{groups[7] >> 8}.{groups[7] & 255}"
        spellings = (address.exploded, address.compressed, address.exploded.upper(),
                     ":".join(f"{g:x}" for g in groups), ":".join(f"{g:x}" for g in groups[:6]) + f":{dotted}")
        for text in spellings:
            cases[text] = _expected_ip(text)
    for text in ("1.2.3.4", "0.0.0.0", "255.255.255.255", "::", "::1", "1::", "64:ff9b::192.0.2.33"):
        cases[text] = _expected_ip(text)
    cases["010.001.0.255"] = "::ffff:10.1.0.255"
    for text in ("999.1.1.1", "256.1.1.1", "1.2.3", "1.2.3.4.5", "", ":", "::1::", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7",
                 "12345::", ":1::2", "1::2:", "g::1", ":::", "1.2.3.4:80", "::1.2.3", "::300.1.1.1", "hello", "1.2.3.4 "):
        cases[text] = None
    frame = spark.createDataFrame(list(cases.items()), "text string, expected string")
    wrong = frame.withColumn("ip", canonical_ip(F.col("text"))).filter(~F.col("ip").eqNullSafe(F.col("expected")))
    assert wrong.collect() == []


TIMES = {
    "2024-01-30 22:00:00": "2024-01-30 22:00:00",
    "2024-01-30T22:00:00.123Z": "2024-01-30 22:00:00",
    "2024-01-30T22:00:00+05:00": "2024-01-30 17:00:00",
    "2024-01-30T22:00:00.5+0500": "2024-01-30 17:00:00",
    " 2024-01-30 22:00 ": "2024-01-30 22:00:00",
    "2024-01-30": "2024-01-30 00:00:00",
    "2024/01/30 22:00:00": "2024-01-30 22:00:00",
    "30/01/2024 22:00:00": "2024-01-30 22:00:00",
    "30-01-2024": "2024-01-30 00:00:00",
    "20240130220000": "2024-01-30 22:00:00",
    "20240130": "2024-01-30 00:00:00",
    "1706650000": "2024-01-30 21:26:40",
    "1706650000123": "2024-01-30 21:26:40",
    "30 Jan 2024 22:00:00": "2024-01-30 22:00:00",
    "Tue, 30 Jan 2024 22:00:00 GMT": "2024-01-30 22:00:00",
    "22:00:00": None,
    "junk": None,
    "": None,
    "now": None,
    "1960-01-01 00:00:00": None,
    "2200-01-01 00:00:00": None,
    "2024-13-45 00:00:00": None,
}


def test_best_effort_timestamp(spark):
    frame = spark.createDataFrame([(text,) for text in TIMES], "text string")
    got = frame.select("text", best_effort_timestamp(F.col("text")).cast("string").alias("t")).collect()
    assert {r.text: r.t for r in got} == {k: v or "1970-01-01 00:00:00" for k, v in TIMES.items()}


def test_unsigned_or_zero(spark):
    cases = {"0": 0, "65535": 65535, "65536": 0, "-1": 0, "abc": 0, "": 0, "1.0": 0, "1e3": 0, None: 0}
    frame = spark.createDataFrame([(text,) for text in cases], "text string")
    got = frame.select("text", unsigned_or_zero(F.col("text"), 65535).alias("n")).collect()
    assert {r.text: r.n for r in got} == cases


def test_extract_and_outer_object(spark):
    frame = spark.createDataFrame([('a {"x":{"y":1}} b k="v" k="w"',), ("} {",), ("none",)], "text string")
    got = frame.select(
        outer_object(F.col("text")), extract(F.col("text"), 'k="([^"]+)"'), extract(F.col("text"), "^n", 0)
    ).collect()
    assert [tuple(r) for r in got] == [('{"x":{"y":1}}', "v", None), (None, None, None), (None, None, "n")]


def test_safe_div(spark):
    row = spark.range(1).select(safe_div(F.lit(1), F.lit(0)).alias("a"), safe_div(F.lit(1), F.lit(4)).alias("b")).first()
    assert (row.a, row.b) == (None, 0.25)


def test_clock_and_buckets(spark):
    clock = Clock("2024-01-30 22:00:00")
    row = spark.range(1).select(
        clock.today.cast("string"), clock.midnight.cast("string"), clock.ago("5 MINUTE").cast("string"),
        clock.days_ago(7).cast("string"), clock.range_start.cast("string"), clock.range_end.cast("string"),
        bucket(clock.now + F.expr("INTERVAL 17 MINUTE"), "minute", 15).cast("string"), hour_text(clock.midnight),
    ).first()
    assert tuple(row) == (
        "2024-01-30", "2024-01-30 00:00:00", "2024-01-30 21:55:00", "2024-01-23", "2024-01-30 21:00:00",
        "2024-01-30 22:00:00", "2024-01-30 22:15:00", "0",
    )
    assert spark.range(1).select(Clock().now).first()[0] is not None


def test_time_bounds_are_closed_and_imply_the_day(spark):
    times = [dt.datetime(2024, 1, 30, 0, 0, 0), dt.datetime(2024, 1, 30, 12), dt.datetime(2024, 1, 31)]
    frame = spark.createDataFrame([(str(t),) for t in times], "t string").select(F.col("t").cast("timestamp"))
    start, end = F.lit("2024-01-30 00:00:00").cast("timestamp"), F.lit("2024-01-30 12:00:00").cast("timestamp")
    assert within(frame, "t", start, end).count() == 2
    assert since(frame, "t", end).count() == 2
    stored = frame.withColumn("day", F.to_date("t"))
    assert within(stored, "t", start, end).count() == 2
