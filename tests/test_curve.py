"""Records of a folded day are clustered on subscriber and time: filters on either leave most row groups out."""

from __future__ import annotations

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from flowledger import schema
from flowledger.operators import curve
from flowledger.plans.event_lines import INGEST_TS
from flowledger.sources import store as stores
from flowledger.sources.store import Store
from flowledger.streaming.ingest import write_batch
from tests.compare import spark_rows

DAY = dt.date(2024, 1, 30)


def test_bits_take_turns(spark):
    frame = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 5), (63, 63)], "a int, b int")
    assert [r[0] for r in frame.select(curve.interleaved(F.col("a"), F.col("b"))).collect()] == [0, 2, 1, 0b011011, 4095]


def test_ranks(spark):
    """Even for even values; one value with most rows takes a single rank; NULL, empty and equal tables have ranks too."""
    rows = spark.range(6400).select(F.col("id").alias("even"), F.when(F.col("id") < 5000, "hot").otherwise(F.format_string("u%05d", "id")).alias("name"), F.lit(None).cast("string").alias("none"))
    even, name, none = curve.borders(rows, F.col("even"), F.col("name"), F.col("none"))
    ranked = rows.select(curve.rank(F.col("even"), even).alias("even"), curve.rank(F.col("name"), name).alias("name"), F.col("even").alias("id"), curve.rank(F.col("none"), none).alias("none"))
    assert {r["count"] for r in ranked.groupBy("even").count().collect()} == {100}
    hot = ranked.filter("id < 5000").select("name").distinct().collect()
    assert len(hot) == 1 and ranked.filter("id >= 5000").select("name").distinct().count() >= 12
    assert [r.none for r in ranked.select("none").distinct().collect()] == [0]
    assert curve.borders(rows.limit(0), F.col("even")) == [[]]
    assert curve.with_curve(rows.limit(0), F.col("name"), F.col("even")).count() == 0


def row_groups(store):
    """(subscriber range, time range) of each row group of the day's records."""
    found = []
    for file in glob.glob(f"{store.base}/records/day={DAY}/*/*.parquet"):
        parquet = pq.ParquetFile(file)
        names = parquet.schema_arrow.names
        subscriber, time = names.index("subscriber_id"), names.index("timestamp")
        for k in range(parquet.metadata.num_row_groups):
            group = parquet.metadata.row_group(k)
            ranges = [group.column(c).statistics for c in (subscriber, time)]
            found.append([(s.min, s.max) for s in ranges])
    return found


@pytest.fixture
def small_row_groups(spark, monkeypatch):
    monkeypatch.setattr(stores, "ROW_GROUP_BYTES", 20_000)
    return spark


def test_either_filter_skips_row_groups(small_row_groups, tmp_path):
    spark = small_row_groups
    second = F.pmod(F.xxhash64("id"), F.lit(86400))
    user = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("u%04d", F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.lit(2000))))
    time = F.date_format(F.timestamp_seconds(F.lit(1706572800) + second), "yyyy-MM-dd'T'HH:mm:ss")
    text = F.concat(F.lit('{"ISODATE":"'), time, F.lit('","subscriber_id":"'), user, F.lit('","destination_ip":"10.0.0.1","bytes_in":"5"}'))
    lines = spark.range(40_000).select(text.alias("raw_message"), F.lit(INGEST_TS).cast("timestamp").alias("ingest_ts"))
    store = Store(spark, str(tmp_path))
    write_batch(store, lines, 0, min_partitions=4)
    before = spark_rows(store.records().select(schema.RECORDS.names))
    store._fold_records([DAY], keep_replaced=False)
    assert spark_rows(store.records().select(schema.RECORDS.names)) == before
    groups = row_groups(store)
    assert len(groups) >= 60
    noon = dt.datetime(2024, 1, 30, 12, tzinfo=dt.timezone.utc)
    five_minutes = [g for g in groups if g[1][0] < noon + dt.timedelta(minutes=5) and g[1][1] >= noon]
    one_subscriber = [g for g in groups if g[0][0] <= "u1000" <= g[0][1]]
    hot = [g for g in groups if g[0][0] <= "hot" <= g[0][1]]
    assert len(five_minutes) <= len(groups) / 4, (len(five_minutes), len(groups))
    assert len(one_subscriber) <= len(groups) / 4, (len(one_subscriber), len(groups))
    assert len(hot) <= len(groups) / 2
    print("row groups:", len(groups), "5 minutes:", len(five_minutes), "a subscriber:", len(one_subscriber), "the busiest one:", len(hot))
    found = store.records().filter((F.col("subscriber_id") == "u1000") & (F.col("day") == F.lit(DAY)))
    assert found.count() == sum(1 for row in before[1] if "u1000" in row)
