"""Stored tables and streams: same rows as the batch, replay, late lines, restart, retention, compaction."""

from __future__ import annotations

import datetime as dt
import os
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from flowledger import schema
from flowledger.operators.parse import parse_records
from flowledger.operators.retention import expired_count, retained_rollup
from flowledger.operators.rollups import ROLLUPS, build
from flowledger.plans.event_lines import INGEST_TS, event_lines, read_events
from flowledger.plans.queries import CLOCK
from flowledger.plans.reports import REPORTS
from flowledger.plans.tables import Tables
from flowledger.sources.lines import read_files, read_topic, split_lines
from flowledger.sources.store import STREAM, Store
from flowledger.streaming.ingest import ingest, write_batch
from flowledger.streaming.live import ahead_of_time
from tests.compare import spark_rows

DAYS = ("2024-01-29", "2024-01-30")


@pytest.fixture(scope="module")
def lines(spark, sf_dir):
    """Two days of lines, kept small because every batch writes a dozen tables."""
    kept = event_lines(read_events(spark, sf_dir).filter(F.to_date("ts").isin(*DAYS))).cache()
    yield kept
    kept.unpersist()


def halves(lines):
    early = F.col("event_id") < lines.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0]
    return lines.filter(early).drop("event_id"), lines.filter(~early).drop("event_id")


def same_as_batch(store, lines):
    records = parse_records(lines)
    names = schema.RECORDS.names
    assert spark_rows(store.records().select(names)) == spark_rows(records.select(names))
    for rollup in ROLLUPS.values():
        columns = [*rollup.group_keys, *rollup.columns]
        assert spark_rows(store.rollup(rollup).select(columns)) == spark_rows(build(records, rollup)), rollup.name


@pytest.fixture(scope="module")
def store(spark, lines, tmp_path_factory):
    """Two batches, the second one written twice."""
    store = Store(spark, str(tmp_path_factory.mktemp("store")))
    first, second = halves(lines)
    write_batch(store, second, 1)
    write_batch(store, first, 0)  # late lines
    write_batch(store, second, 1)  # replay
    return store


def test_batches_late_lines_and_replay(store, lines):
    same_as_batch(store, lines)


def test_layout(store):
    assert [str(day) for day in store.days(store.records_path)] == list(DAYS)
    assert set(os.listdir(f"{store.records_path}/day={DAYS[1]}")) == {"batch_id=0", "batch_id=1"}
    assert store.next_batch() == 2
    assert {row.yyyymm for row in store.records().select("yyyymm").distinct().collect()} == {"202401"}


def test_reports_on_store_and_on_lines_agree(store, lines):
    stored, direct = store.tables(), Tables.from_records(parse_records(lines))
    for name in ("Q07_hourly_traffic_24h", "Q15_top_app_apn_7d", "Q31_top20_subscribers_today", "Q46_sessions_in_range"):
        assert spark_rows(REPORTS[name](stored, CLOCK)) == spark_rows(REPORTS[name](direct, CLOCK)), name


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned(store):
    plan = plan_of(REPORTS["Q11_bandwidth_by_service"](store.tables(), CLOCK))
    assert "members" not in plan  # no distinct count is read
    assert "day" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "ReadSchema: struct<service_type:string,protocol:string,apn:string,total_bytes:bigint>" in plan
    plan = plan_of(REPORTS["Q07_hourly_traffic_24h"](store.tables(), CLOCK))
    assert "day" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "GreaterThanOrEqual(hour" in plan
    plan = plan_of(REPORTS["Q05_bandwidth_today"](store.tables(), CLOCK))
    assert "day" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "ReadSchema: struct<timestamp:timestamp,bytes_total:bigint>" in plan


def test_written_order(store):
    """Every file is sorted by the table's own key."""
    for path, keys in [(store.records_path, ["subscriber_id", "timestamp"])] + [
        (store.measures_path(r), [k for k in r.group_keys if k != "day"]) for r in ROLLUPS.values()
    ]:
        day = f"{path}/day={DAYS[1]}"
        files = [f"{day}/{part}/{name}" for part in os.listdir(day) for name in os.listdir(f"{day}/{part}") if name.endswith(".parquet")]
        assert files
        for name in files:
            rows = pq.read_table(name, columns=keys).to_pylist()
            order = [tuple(row[k] for k in keys) for row in rows]
            assert order == sorted(order), name


def test_collectors_and_latest_records_scan_no_full_day(store):
    plan = plan_of(REPORTS["Q10_collectors"](store.tables(), CLOCK))
    assert "/collectors" in plan and "records" not in plan
    plan = plan_of(REPORTS["Q49_latest_records"](store.tables(), CLOCK))
    assert DAYS[1] in plan.split("PartitionFilters:")[1].split("]")[0] and DAYS[0] not in plan.split("PartitionFilters:")[1].split("]")[0]


def parts_of(store, path, day):
    return sorted(os.listdir(f"{path}/day={day}"))


def test_compaction_replay_and_rebuild(store, lines):
    day = dt.date.fromisoformat(DAYS[1])
    store.compact(day)
    assert parts_of(store, store.records_path, day) == ["batch_id=-1"]
    same_as_batch(store, lines)
    write_batch(store, halves(lines)[0], 0)  # a replay behind the compaction
    assert parts_of(store, store.records_path, day) == ["batch_id=-1"] and store.next_batch() == 2
    same_as_batch(store, lines)
    store.rebuild_rollups([day])
    same_as_batch(store, lines)


def test_foldings_that_were_cut_off(store, lines, monkeypatch):
    day = dt.date.fromisoformat(DAYS[0])
    path = store.records_path
    with monkeypatch.context() as patch:  # cut off before it is published
        patch.setattr("flowledger.sources.store._rename", lambda *_: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(OSError):
            store.compact(day)
    assert parts_of(store, path, day)[0].startswith("batch_id=-") and len(parts_of(store, path, day)) == 2
    same_as_batch(store, lines)
    store.compact(day, keep_replaced=True)  # published, but the old parts still lie there
    assert len(parts_of(store, path, day)) == 2
    same_as_batch(store, lines)
    store.compact(day)
    assert len(parts_of(store, path, day)) == 1
    same_as_batch(store, lines)


def one_line(spark, user, time="2024-01-30T10:00:00", extra=""):
    return spark.createDataFrame([('{"ISODATE":"%s","subscriber_id":"%s"%s}' % (time, user, extra),)], "raw_message string").withColumn("ingest_ts", F.lit(INGEST_TS).cast("timestamp"))


def test_a_batch_that_arrives_during_a_folding_is_neither_folded_nor_lost(spark, tmp_path, monkeypatch):
    store, day = Store(spark, str(tmp_path)), dt.date(2024, 1, 30)
    write_batch(store, one_line(spark, "a"), store.next_batch())
    write_batch(store, one_line(spark, "b"), store.next_batch())
    write, late = Store._write, iter([True])

    def write_with_a_late_batch(self, *rest):
        if next(late, False):
            write_batch(store, one_line(spark, "late"), store.next_batch())
        write(self, *rest)

    monkeypatch.setattr(Store, "_write", write_with_a_late_batch)
    store.compact(day)
    assert sorted(r.subscriber_id for r in store.records().collect()) == ["a", "b", "late"]
    assert store.rollup(ROLLUPS["daily_aggregation"]).agg(F.sum("session_count")).first()[0] == 3
    assert parts_of(store, store.records_path, day) == ["batch_id=-1", "batch_id=2"]


def test_a_batch_counts_only_when_it_is_whole(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    with monkeypatch.context() as patch:
        patch.setattr(Store, "write_quarantine", lambda *_: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(OSError):
            write_batch(store, one_line(spark, "a"), 0)
    assert store.records().count() == 0 and store.next_batch() == 1
    write_batch(store, one_line(spark, "a"), 0)
    write_batch(store, one_line(spark, "other"), 0)  # not a replay, but the number is taken
    assert [r.subscriber_id for r in store.records().collect()] == ["a"]


def test_batches_of_quarantined_lines_take_numbers(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for k in range(3):
        write_batch(store, one_line(spark, "a", extra=f',"source_ip":"1.2.3.999{k}"'), store.next_batch())
    assert store.quarantined().count() == 3 and store.records().count() == 0
    store.apply_retention(dt.date(2024, 1, 31) + dt.timedelta(days=91))
    assert store.quarantined().count() == 0


def test_retention_on_read(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for k in range(10, 20):
        write_batch(store, one_line(spark, "a", f"2024-01-{k}T10:00:00"), store.next_batch())
    tables = store.tables(F.lit("2024-04-14 10:00:00").cast("timestamp"))  # 90 days before: January 15th, 10:00
    assert tables.records.count() == 4 and tables.hourly.count() == 4 and tables.applications.count() == 10
    assert store.records().count() == 10


def test_header_is_stripped_on_the_way_in(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    headed = one_line(spark, "a").withColumn("raw_message", F.concat(F.lit("<13>relay "), "raw_message"))
    write_batch(store, headed, 0, strip_header="^<13>relay ", min_partitions=2)
    assert store.records().first().raw_message.startswith("{")


LARGE = 9 * 10**18


def test_large_counters_neither_fail_nor_lie(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for k, counter in enumerate((LARGE, LARGE, 7, 2**63, 2**64)):
        write_batch(store, one_line(spark, "a", extra=f',"bytes_in":{counter},"bytes_out":1'), k)
    held = {r.bytes_in: r.bytes_total for r in store.records().collect()}
    assert held == {LARGE: LARGE + 1, 7: 8, None: None, 0: 1}
    direct = Tables.from_records(store.records().drop("day", "batch_id", "yyyymm"))
    for rollup in ROLLUPS.values():
        columns = [*rollup.group_keys, *rollup.columns]
        assert spark_rows(store.rollup(rollup).select(columns)) == spark_rows(direct.rollup(rollup.name)), rollup.name
    assert store.tables().daily.first().total_bytes is None
    for name, report in REPORTS.items():
        assert spark_rows(report(store.tables(), CLOCK)) == spark_rows(report(direct, CLOCK)), name
    assert REPORTS["Q05_bandwidth_today"](direct, CLOCK).first().total is None


def test_stream_over_files_with_restart(spark, lines, tmp_path):
    first, second = halves(lines)
    source, base, checkpoint = f"{tmp_path}/in", f"{tmp_path}/tables", f"{tmp_path}/checkpoint"
    fixed = F.lit(INGEST_TS).cast("timestamp")
    store = Store(spark, base)

    def run():
        stream = read_files(spark, source, stream=True, max_files=1).withColumn("ingest_ts", fixed)
        ingest(store, stream, checkpoint, available_now=True).awaitTermination()

    second.select("raw_message").coalesce(1).write.text(source)
    run()
    seen = store.records().count()
    first.select("raw_message").coalesce(1).write.mode("append").text(source)
    run()  # goes on behind what the first run has read
    assert 0 < seen < store.records().count()
    same_as_batch(store, lines.drop("event_id"))


def test_retention_drops_whole_days(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    made = ["2024-01-01 05:00:00", "2024-01-02 05:00:00", "2023-01-01 05:00:00", "soon"]
    texts = ['{"ISODATE":"%s","subscriber_id":"s"}' % text for text in made]
    lines = spark.createDataFrame([(text,) for text in texts], "raw_message string").withColumn(
        "ingest_ts", F.lit(INGEST_TS).cast("timestamp")
    )
    write_batch(store, lines, 0)
    assert expired_count(store.records(), F.lit("2024-02-01").cast("timestamp")).first() == (2, 1)
    as_of = dt.date(2024, 1, 2) + dt.timedelta(days=90)
    store.apply_retention(as_of)
    assert [str(d) for d in store.days(store.records_path)] == ["2024-01-02"]
    sizes = {r.name: store.rollup(r).agg(F.sum("session_count")).first()[0] for r in ROLLUPS.values()}
    assert sizes == {
        "daily_aggregation": 2, "hourly_traffic": 1, "top_destinations": 1, "top_applications": 2,
        "subscriber_bandwidth": 2,
    }
    daily = ROLLUPS["daily_aggregation"]
    later = F.lit("2024-12-31 12:00:00").cast("timestamp")
    assert retained_rollup(store.rollup(daily), daily, later).count() == 1
    assert store.apply_retention(as_of) == {path: [] for path in store.apply_retention(as_of)}


def test_quarantine_table(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.quarantined().count() == 0
    assert store.records().count() == 0
    lines = spark.createDataFrame(
        [('{"subscriber_id":"a","source_ip":"1.2.3.999"}',), ("in:<b>",)], "raw_message string"
    ).withColumn("ingest_ts", F.lit(INGEST_TS).cast("timestamp"))
    write_batch(store, lines, 4)
    held = store.quarantined().collect()
    assert [(r.reason, r.batch_id) for r in held] == [("source_ip: 1.2.3.999", 4)]
    assert store.records().count() == 1


def test_split_lines(spark):
    messages = spark.createDataFrame([(b"a\nb\n", dt.datetime(2024, 1, 1)), (b"c", dt.datetime(2024, 1, 2))],
                                     "value binary, timestamp timestamp")
    assert sorted(r.raw_message for r in split_lines(messages).collect()) == ["a", "b", "c"]


def test_every_checkpoint_has_numbers_of_its_own(spark, tmp_path):
    store, fixed = Store(spark, f"{tmp_path}/tables"), F.lit(INGEST_TS).cast("timestamp")
    assert store.next_batch() == 0
    firsts = []
    for run in (0, 1, 1):
        source = f"{tmp_path}/in{run}"
        spark.createDataFrame([(f"2024-01-30T10:00:00 in:<u{run}>",)], "v string").write.mode("append").text(source)
        stream = read_files(spark, source, stream=True).withColumn("ingest_ts", fixed)
        ingest(store, stream, f"{tmp_path}/c{run}", available_now=True).awaitTermination()
        firsts.append(store.first_batch(f"{tmp_path}/c{run}"))
    assert firsts == [STREAM, 2 * STREAM, 2 * STREAM]
    assert sorted(r.subscriber_id for r in store.records().collect()) == ["u0", "u1", "u1"]
    # an emptied checkpoint reads its source from the start again, under new numbers
    os.rename(f"{tmp_path}/c0", f"{tmp_path}/gone")
    assert store.first_batch(f"{tmp_path}/c0") == 3 * STREAM


def test_clocks_ahead_of_time_are_counted_apart(spark):
    lines = one_line(spark, "a").unionByName(one_line(spark, "b", "2099-01-01T00:00:00"))
    ahead = ahead_of_time(parse_records(lines)).collect()
    assert [(r.collector_id, r.sessions) for r in ahead] == [("", 1)]


def test_topic_reader_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, "broker:9092", topic="sessions")


def test_a_batch_is_dealt_over_all_cores(spark, lines, tmp_path, monkeypatch):
    from flowledger.streaming import ingest as module

    parse, dealt = module.parse_lines, []
    monkeypatch.setattr(module, "parse_lines", lambda rows, *rest: dealt.append(rows.rdd.getNumPartitions()) or parse(rows, *rest))
    write_batch(Store(spark, str(tmp_path)), lines.limit(20), 0, min_partitions=1)
    assert dealt == [spark.sparkContext.defaultParallelism]


def test_a_folding_runs_as_many_tasks_as_its_rows_need(spark, lines, tmp_path):
    store, context, before = Store(spark, str(tmp_path)), spark.sparkContext, spark.conf.get("spark.sql.shuffle.partitions")
    for number, half in enumerate(halves(lines)):
        write_batch(store, half, number)
    days, tracker = [dt.date.fromisoformat(day) for day in DAYS], context.statusTracker()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "48")
        context.setJobGroup("folding", "folding")
        store._fold_rollups(days)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        context.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup("folding") for s in tracker.getJobInfo(job).stageIds]
    # two stages only deal members to their slices, for the numbers of the dictionary
    assert len([s for s in stages if s and s.numCompletedTasks >= 48]) <= 2, [(s.name, s.numTasks) for s in stages if s]
    same_as_batch(store, lines)


def test_a_folding_makes_sets_of_crowded_keys_only(spark, lines, tmp_path, monkeypatch):
    from flowledger.operators import distinct

    store, make, made = Store(spark, str(tmp_path)), distinct.sets, []
    for number, half in enumerate(halves(lines)):
        write_batch(store, half, number)
    monkeypatch.setattr(distinct, "sets", lambda *rest: made.append(make(*rest).count()) or make(*rest))
    store._fold_rollups([dt.date.fromisoformat(day) for day in DAYS])
    assert made == [0] * 5  # no key has more members than a list takes
    same_as_batch(store, lines)


def test_a_batch_makes_each_series_from_the_finer_one(spark, lines, tmp_path, monkeypatch):
    read, write = {}, Store._write_series

    def write_series(self, part, unit, batch_id):
        read[unit] = {file.split("/")[-4] for file in part.inputFiles()}
        write(self, part, unit, batch_id)

    monkeypatch.setattr(Store, "_write_series", write_series)
    store = Store(spark, str(tmp_path))
    for number, half in enumerate(halves(lines)):
        write_batch(store, half, number)
    assert read["minute"] == read["hour"] == {"series"}
    for unit in ("second", "minute", "hour"):
        assert store.series(unit).agg({"session_count": "sum"}).first()[0] == store.records().count()


def meeting(monkeypatch, *names):
    """Lets the named steps of a store begin only once all of them have begun."""
    together = threading.Barrier(len(names), timeout=120)
    for name in names:
        own = getattr(Store, name)
        monkeypatch.setattr(Store, name, lambda self, *rest, own=own: together.wait() >= 0 and own(self, *rest))


def test_the_outputs_of_a_batch_do_not_wait_for_each_other(spark, lines, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    meeting(monkeypatch, "write_first_seen", "write_records", "_write_all_series")
    write_batch(store, lines, 0)
    same_as_batch(store, lines)


def test_the_foldings_of_records_and_rollups_do_not_wait_for_each_other(spark, lines, tmp_path, monkeypatch):
    store, publish, together = Store(spark, str(tmp_path)), Store._publish, threading.Barrier(2, timeout=120)
    for number, half in enumerate(halves(lines)):
        write_batch(store, half, number)

    def publish_together(self, tables, *rest):
        if self.first_seen_path not in tables:
            together.wait()
        publish(self, tables, *rest)

    monkeypatch.setattr(Store, "_publish", publish_together)
    store.compact([dt.date.fromisoformat(day) for day in DAYS])
    same_as_batch(store, lines)
