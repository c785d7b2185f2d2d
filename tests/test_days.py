"""The forms of a stored day: open, folded, closed, reopened, rebuilt; all give the rows of one aggregation."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowledger import schema
from flowledger.operators import distinct
from flowledger.operators.parse import parse_records
from flowledger.operators.rollups import DAILY, HOURLY, ROLLUPS, SUBSCRIBERS, build
from flowledger.plans.event_lines import INGEST_TS
from flowledger.sources.store import Store
from flowledger.streaming.ingest import write_batch
from tests.compare import spark_rows

DAY, OTHER = dt.date(2024, 1, 30), dt.date(2024, 1, 29)


def lines_of(spark, rows):
    """Lines of (user, destination, time); every user and destination is a member of some key."""
    texts = [('{"ISODATE":"%s","subscriber_id":"%s","destination_ip":"%s","source_port":"%d","bytes_in":"5","duration_seconds":"2"}' % (time, user, ip, 1000 + int(user[1:]) % 7),) for user, ip, time in rows]
    return spark.createDataFrame(texts, "raw_message string").withColumn("ingest_ts", F.lit(INGEST_TS).cast("timestamp"))


def some(first, last, day=DAY, addresses=9):
    return [(f"u{i}", f"10.0.{i % addresses}.1", f"{day}T{i % 3 + 10}:00:00") for i in range(first, last)]


def same_as_batch(store, lines):
    records = parse_records(lines)
    assert spark_rows(store.records().select(schema.RECORDS.names)) == spark_rows(records.select(schema.RECORDS.names))
    for rollup in ROLLUPS.values():
        columns = [*rollup.group_keys, *rollup.columns]
        assert spark_rows(store.rollup(rollup).select(columns)) == spark_rows(build(records, rollup)), rollup.name


def rows_of(spark, *batches):
    return lines_of(spark, [row for batch in batches for row in batch])


def members_held(store, rollup):
    return store.members(rollup).filter(F.col("member").isNotNull()).count()


def test_folded_days_with_late_batches(spark, tmp_path, monkeypatch):
    """Lists beside bitmaps; late members that are known, new, or in another key."""
    monkeypatch.setattr(distinct, "FEW", 3)
    store, first, second = Store(spark, str(tmp_path)), some(0, 60) + some(0, 20, OTHER), some(30, 50)
    late, later = some(40, 90, addresses=14) + some(0, 5, OTHER), some(55, 70) + some(200, 205)
    write_batch(store, rows_of(spark, first), 0)
    write_batch(store, rows_of(spark, second), 1)
    store.compact([DAY, OTHER])
    assert members_held(store, HOURLY) == 0
    assert distinct.bitmaps(store.members(HOURLY)).count() > 0
    same_as_batch(store, rows_of(spark, first, second))
    write_batch(store, rows_of(spark, late), 2)
    assert members_held(store, HOURLY) > 0
    same_as_batch(store, rows_of(spark, first, second, late))
    store.compact(DAY)  # once more, over lists, bitmaps and rows
    write_batch(store, rows_of(spark, late), 2)  # a replay
    write_batch(store, rows_of(spark, later), 3)
    same_as_batch(store, rows_of(spark, first, second, late, later))
    store.compact([DAY, OTHER])
    assert members_held(store, HOURLY) == 0
    same_as_batch(store, rows_of(spark, first, second, late, later))


def test_numbers_stay_and_are_dealt_in_slices(spark, monkeypatch):
    monkeypatch.setattr(distinct, "BITS", 32)
    none = spark.createDataFrame([], "day date, kind string, member string, number bigint")
    seen = spark.range(500).select(F.lit(DAY).alias("day"), F.when(F.col("id") % 5 == 0, "b").otherwise("a").alias("kind"), F.col("id").cast("string").alias("member"))
    numbered = distinct.extended(none, seen.filter("member < 3"))
    before = {(r.kind, r.member): r.number for r in numbered.collect()}
    after = [(r.kind, r.member, r.number) for r in distinct.extended(numbered, seen).collect()]
    assert len({(k, n) for k, _, n in after}) == len(after) == 500 and min(n for _, _, n in after) >= 1
    assert {(k, m): n for k, m, n in after if (k, m) in before} == before


def test_closed_days_are_reopened_by_late_lines(spark, tmp_path):
    store, first, late = Store(spark, str(tmp_path)), some(0, 60) + some(0, 20, OTHER), some(40, 80)
    write_batch(store, rows_of(spark, first), 0)
    store.compact(DAY)
    store.close([DAY, OTHER])
    assert store.closed_days() == [OTHER, DAY]
    assert store.members(HOURLY).count() == store.measures(DAILY).count() == 0 and not store._parts_of(store.dictionary_path)
    same_as_batch(store, rows_of(spark, first))
    store.compact([DAY, OTHER])  # closed days stay closed
    assert store.closed_days() == [OTHER, DAY]
    write_batch(store, rows_of(spark, late), 1)
    assert store.closed_days() == [OTHER]
    same_as_batch(store, rows_of(spark, first, late))
    write_batch(store, rows_of(spark, late), 1)  # a replay
    store.close(DAY)
    same_as_batch(store, rows_of(spark, first, late))
    assert store.late_records().count() == 0


def test_lines_for_a_closed_day_without_records_are_put_aside(spark, tmp_path):
    store, first = Store(spark, str(tmp_path)), some(0, 30) + some(0, 20, OTHER)
    write_batch(store, rows_of(spark, first), 0)
    store.close([DAY, OTHER])
    store.apply_retention(DAY + dt.timedelta(days=90))  # the records of the day before go
    before = {r.name: spark_rows(store.rollup(r).filter(F.col("day") == F.lit(OTHER))) for r in (DAILY, SUBSCRIBERS)}
    assert store.reopen([OTHER]) == []
    write_batch(store, rows_of(spark, some(10, 25, OTHER), some(100, 103)), 1)
    assert store.closed_days() == [OTHER] and store.late_records().count() == 15
    assert before == {r.name: spark_rows(store.rollup(r).filter(F.col("day") == F.lit(OTHER))) for r in (DAILY, SUBSCRIBERS)}
    assert store.records().count() == 33 and store.rollup(DAILY).filter(F.col("day") == F.lit(DAY)).agg(F.sum("session_count")).first()[0] == 33
    with pytest.raises(ValueError, match="2024-01-29: 20 sessions, 0 records"):
        store.rebuild_rollups([OTHER, DAY])
    assert before == {r.name: spark_rows(store.rollup(r).filter(F.col("day") == F.lit(OTHER))) for r in (DAILY, SUBSCRIBERS)}


def test_a_day_closed_while_a_batch_is_written_is_reopened(spark, tmp_path, monkeypatch):
    store, first, late = Store(spark, str(tmp_path)), some(0, 30), some(20, 50)
    write_batch(store, rows_of(spark, first), 0)
    write = Store.write_quarantine

    def close_meanwhile(self, *rest):
        store.close(DAY)
        write(self, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(Store, "write_quarantine", close_meanwhile)
        write_batch(store, rows_of(spark, late), 1)
    assert store.closed_days() == []
    same_as_batch(store, rows_of(spark, first, late))


def test_rebuilding_refuses_days_whose_records_have_gone(spark, tmp_path):
    """What retention left of the rollups must survive a rebuild."""
    store = Store(spark, str(tmp_path))
    write_batch(store, rows_of(spark, some(0, 30), some(0, 20, OTHER)), 0)
    store.apply_retention(DAY + dt.timedelta(days=120))
    held = store.rollup(DAILY).agg(F.sum("session_count")).first()[0]
    assert store.records().count() == 0 and held == 50
    with pytest.raises(ValueError, match="without all their records"):
        store.rebuild_rollups([DAY, OTHER])
    assert store.rollup(DAILY).agg(F.sum("session_count")).first()[0] == held
    store.rebuild_rollups([DAY], fewer=True)
    assert store.rollup(DAILY).agg(F.sum("session_count")).first()[0] == 20


@pytest.mark.parametrize("moment", ["_write_dictionary", "_publish"])
def test_a_batch_that_commits_during_a_rebuild_counts(spark, tmp_path, monkeypatch, moment):
    store, first, late = Store(spark, str(tmp_path)), some(0, 30), some(20, 45)
    write_batch(store, rows_of(spark, first), 0)
    own, once = getattr(Store, moment), iter([True])

    def with_a_batch(self, *rest):
        if next(once, False):
            write_batch(store, rows_of(spark, late), 1)
        return own(self, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(Store, moment, with_a_batch)
        store.rebuild_rollups(DAY)
    same_as_batch(store, rows_of(spark, first, late))


def test_damaged_rollups_are_rebuilt(spark, tmp_path):
    store, first = Store(spark, str(tmp_path)), some(0, 30)
    write_batch(store, rows_of(spark, first), 0)
    part = f"{store.measures_path(DAILY)}/day={DAY}/batch_id=0"
    spark.read.parquet(part).limit(4).write.parquet(f"{tmp_path}/few")
    spark.read.parquet(f"{tmp_path}/few").write.mode("overwrite").parquet(part)
    assert store.rollup(DAILY).agg(F.sum("session_count")).first()[0] < 30
    store.rebuild_rollups(DAY)
    same_as_batch(store, rows_of(spark, first))


def test_collectors_and_latest_keep_their_short_way_with_retention(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    lines = [('{"ISODATE":"2024-01-%dT10:00:00","subscriber_id":"a","collector_id":"c%d"}' % (k, k),) for k in range(10, 20)]
    write_batch(store, spark.createDataFrame(lines, "raw_message string").withColumn("ingest_ts", F.lit(INGEST_TS).cast("timestamp")), 0)
    edge = F.lit("2024-04-14 09:00:00").cast("timestamp")  # 90 days before: January 15th, 9:00
    tables = store.tables(edge)
    assert sorted(r.collector_id for r in tables.collectors.collect()) == [f"c{k}" for k in range(15, 20)]
    assert sorted(r.timestamp.day for r in tables.latest(3).orderBy(F.desc("timestamp")).limit(3).collect()) == [17, 18, 19]
    later = store.tables(F.lit("2024-04-14 11:00:00").cast("timestamp"))
    assert sorted(r.collector_id for r in later.collectors.collect()) == [f"c{k}" for k in range(16, 20)]
