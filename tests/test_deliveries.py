"""Messages that are delivered more than once, through different batches."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from flowledger.operators import deliveries
from flowledger.operators.parse import parse_records
from flowledger.sources.lines import split_lines
from flowledger.sources.store import Store
from flowledger.streaming.ingest import write_batch
from tests.compare import spark_rows

COLUMNS = "value string, timestamp timestamp, topic string, partition int, offset bigint"


def messages(spark, places):
    """One message for each (partition, offset), every third of two lines, of different days, late ones among them."""
    line = '{"ISODATE":"2024-01-%02dT10:00:00","subscriber_id":"u%s"}'
    rows = []
    for partition, offset in places:
        texts = [line % (1 + (offset or 0) % 28, f"{partition}-{offset}-{k}") for k in range(2 if (offset or 0) % 3 == 0 else 1)]
        rows.append(("\n".join(texts), f"2024-02-{1 + (offset or 0) // 40000:02d} 00:00:00", "sessions", partition, offset))
    frame = spark.createDataFrame(rows, COLUMNS.replace("timestamp timestamp", "timestamp string"))
    return split_lines(frame.withColumn("timestamp", F.col("timestamp").cast("timestamp")), keep=deliveries.POSITION)


def test_blocks_against_brute_force(spark):
    """Ranges and bitmaps, borders of blocks and bytes, offset 0, lines without positions."""
    draw = random.Random(3)
    edges = [0, 1, 7, 8, 9, 32767, 32768, 32769, 65536, 65537, 100000]
    old = {(0, k) for k in range(50, 90)} | {(draw.randrange(2), draw.randrange(66000)) for _ in range(150)} | {(1, k) for k in edges[::2]}
    new = {(draw.randrange(3), draw.randrange(66000)) for _ in range(150)} | {(p, k) for p in range(2) for k in edges + list(range(45, 95))}
    found = deliveries.blocks(messages(spark, sorted(old)))
    assert found.filter("bits IS NULL").count() > 0 and found.filter("bits IS NOT NULL").count() > 0
    asked = messages(spark, sorted(new) + [(None, 5), (0, None)])
    left = deliveries.undelivered(asked, found)
    assert left.columns == asked.columns
    assert spark_rows(left) == spark_rows(messages(spark, sorted(new - old) + [(None, 5), (0, None)]))


def test_a_message_counts_once_in_a_store(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    first, second = [(0, k) for k in range(0, 30, 2)], [(0, k) for k in range(20)] + [(1, 3)]
    write_batch(store, messages(spark, first), 0)
    with monkeypatch.context() as patch:  # an attempt that has written all days
        patch.setattr(Store, "commit", lambda self, batch_id: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write_batch(store, messages(spark, second), 1)
    write_batch(store, messages(spark, [(0, 1), (1, 3)]), 2)  # some of its messages come in another batch
    write_batch(store, messages(spark, second), 1)
    write_batch(store, messages(spark, first + second), 3)  # nothing new
    expected = parse_records(messages(spark, sorted(set(first + second))))
    assert spark_rows(store.records().select(expected.columns)) == spark_rows(expected)
    assert store.tables().daily.agg(F.sum("session_count")).first()[0] == expected.count()
