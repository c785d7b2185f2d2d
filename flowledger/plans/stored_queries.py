"""Queries that go through stored tables and streams instead of one plan from lines to result."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowledger import schema
from flowledger.oracle import AS_OF, RETENTION_EDGE
from flowledger.operators import sketches
from flowledger.operators.parse import parse_records, quarantine
from flowledger.operators.retention import retained_records
from flowledger.operators.rollups import SUBSCRIBERS, Rollup, build, measures_part, members_part, merge_parts, merge_rollups
from flowledger.plans.event_lines import INGEST_TS, LARGE_LINE_SQL, event_lines, read_events
from flowledger.plans.field_queries import garbled_lines
from flowledger.plans.tables import Tables
from flowledger.session import configure, new_folder
from flowledger.sources.store import Store
from flowledger.streaming.ingest import ingest, write_batch
from flowledger.streaming.live import live_per_minute, live_per_second, write_rates

SKETCH_ERROR = 0.05  # three times the standard error of a sketch with 2 ** 12 registers
PARTS = 4  # micro-batches the events come in
OPEN_DAYS = 2  # newest days that are not folded before the last micro-batch
COMPACTED_DAY = dt.date.fromisoformat(AS_OF[:10])
_STORES: dict[tuple, Store] = {}


def _state_of(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files of a table: what was derived from other files is not used again."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))


def _dealt(events: DataFrame) -> DataFrame:
    """The events over all cores, so that lines are not made by one task where the table is one row group."""
    return events.select("event_id", "ts", "user_id", "event_type").repartition(events.sparkSession.sparkContext.defaultParallelism)


def _lines_in_parts(lines: DataFrame, part: Column, folder: str) -> DataFrame:
    """A stream over the lines; nothing is in its source until :func:`_deliver` puts a part of them there.

    All parts are written by one job over all cores, each in as many files as there are tasks.
    """
    spark = lines.sparkSession
    lines.select("raw_message", "ingest_ts", part.cast("int").alias("part")).write.partitionBy("part").parquet(f"{folder}/held")
    return spark.readStream.schema(schema.RAW_LINES).parquet(f"{folder}/lines/*")


def _deliver(spark: SparkSession, folder: str, number: int) -> None:
    """Moves a part of the lines into the source of the stream, where its next run finds it."""
    held, to = (spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}") for name in (f"held/part={number}", f"lines/{number}"))
    files = held.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(to.getParent())
    if files.exists(held):
        files.rename(held, to)


def streamed_store(spark: SparkSession, sf_dir: str) -> Store:
    """All events ingested in several micro-batches, each of which has late lines for every day. All days but the last
    ones are folded before the last batch arrives, so it is late for them too; one day is folded once more. In the end all
    batches are delivered again. Built once for the same input files."""
    events = _dealt(read_events(configure(spark), sf_dir))
    key = (spark.sparkContext.applicationId, sf_dir, _state_of(spark, f"{sf_dir}/events.parquet"))
    if key not in _STORES:
        folder, lines, part = new_folder(spark, "store"), event_lines(events), F.col("event_id") % PARTS
        store = Store(spark, f"{folder}/tables")
        stream = _lines_in_parts(lines, part, folder)
        for number in range(PARTS):
            if number == PARTS - 1:
                store.compact(store.days(store.records_path)[:-OPEN_DAYS])
            _deliver(spark, folder, number)
            ingest(store, stream, f"{folder}/checkpoint", available_now=True, min_partitions=PARTS).awaitTermination()
        store.compact(COMPACTED_DAY)
        first = store.first_batch(f"{folder}/checkpoint")
        for number in range(PARTS):
            write_batch(store, lines.filter(part == number), first + number)
        _STORES[key] = store
    return _STORES[key]


def ingested_at_once(spark: SparkSession, sf_dir: str) -> Store:
    """All events in one batch of a new store."""
    store = Store(spark, f"{new_folder(spark, 'store')}/tables")
    write_batch(store, event_lines(read_events(configure(spark), sf_dir)), 0, min_partitions=spark.sparkContext.defaultParallelism)
    return store


def streamed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed_store(spark, sf_dir).records().select(*schema.RECORDS.names)


def records_of_two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events through one stream, the others through a second one with a checkpoint of its own."""
    folder, lines = new_folder(spark, "store"), event_lines(read_events(configure(spark), sf_dir))
    store = Store(spark, f"{folder}/tables")
    for half in range(2):
        source = f"{folder}/lines{half}"
        lines.filter(F.col("event_id") % 2 == half).select("raw_message", "ingest_ts").write.parquet(source)
        stream = spark.readStream.schema(schema.RAW_LINES).parquet(source)
        ingest(store, stream, f"{folder}/checkpoint{half}", available_now=True, min_partitions=PARTS).awaitTermination()
    return store.records().select(*schema.RECORDS.names)


def records_delivered_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of a topic through two checkpoints; half of them, none next to another, come through both."""
    folder, lines = new_folder(spark, "store"), event_lines(read_events(configure(spark), sf_dir))
    position = {"topic": F.lit("sessions"), "partition": (F.col("event_id") % 3).cast("int"), "offset": F.floor(F.col("event_id") / 3)}
    messages = lines.withColumns(position).select("raw_message", "ingest_ts", *position, "event_id")
    store = Store(spark, f"{folder}/tables")
    for left_out in range(2):
        source = f"{folder}/lines{left_out}"
        messages.filter(F.col("offset") % 4 != 2 * left_out).drop("event_id").write.parquet(source)
        stream = spark.readStream.schema(messages.drop("event_id").schema).parquet(source)
        ingest(store, stream, f"{folder}/checkpoint{left_out}", available_now=True, min_partitions=PARTS).awaitTermination()
    return store.records().select(*schema.RECORDS.names)


def stored_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined lines of three batches: one of unreadable lines only, one delivered twice."""
    lines = garbled_lines(read_events(configure(spark), sf_dir))
    store = Store(spark, f"{new_folder(spark, 'store')}/tables")
    unreadable = lines.join(quarantine(lines).select("raw_message"), "raw_message", "left_semi")
    batches = [unreadable.filter("event_id % 3 = 0"), lines.filter("event_id % 3 = 1"), lines.filter("event_id % 3 = 2")]
    for batch in batches:
        write_batch(store, batch, store.next_batch())
    write_batch(store, batches[1], 1)
    return store.quarantined().select("raw_message", "reason")


def records_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed_store(spark, sf_dir).records().groupBy("yyyymm").agg(F.count(F.lit(1)).alias("sessions"))


def streamed_rollup(spark: SparkSession, sf_dir: str, rollup: Rollup) -> DataFrame:
    return streamed_store(spark, sf_dir).rollup(rollup).select(*rollup.group_keys, *rollup.columns)


def _half_stored(spark: SparkSession, sf_dir: str, distinct_counts: str = "exact") -> tuple[Store, DataFrame]:
    """A store with three quarters of the events, and the lines of the others, which have some for every day."""
    lines, part = event_lines(read_events(configure(spark), sf_dir)), F.col("event_id") % PARTS
    store = Store(spark, f"{new_folder(spark, 'store')}/tables", distinct_counts)
    write_batch(store, lines.filter(part > 0), 0, min_partitions=PARTS)
    return store, lines.filter(part == 0)


def closed_days(spark: SparkSession, sf_dir: str, rollup: Rollup) -> DataFrame:
    """A rollup whose days were closed, the first ones after folding, before lines for all of them came late; then some
    were closed again."""
    store, late = _half_stored(spark, sf_dir)
    days = store.days(store.records_path)
    store.compact(days[: len(days) // 2])
    store.close(days)
    write_batch(store, late, 1, min_partitions=PARTS)
    store.close(days[::3])
    return store.rollup(rollup).select(*rollup.group_keys, *rollup.columns)


def rebuilt_rollup(spark: SparkSession, sf_dir: str, rollup: Rollup) -> DataFrame:
    """A rollup rebuilt from the records, of some days after folding, with a batch that came behind it."""
    store, late = _half_stored(spark, sf_dir)
    days = store.days(store.records_path)
    store.compact(days[::2])
    store.rebuild_rollups(days)
    write_batch(store, late, 1, min_partitions=PARTS)
    return store.rollup(rollup).select(*rollup.group_keys, *rollup.columns)


def sketched_store(spark: SparkSession, sf_dir: str) -> Store:
    """A store with sketches: days open, folded and closed before lines for all of them came late, some of them folded or
    closed again. Built once for the same input files."""
    key = (spark.sparkContext.applicationId, "sketch", sf_dir, _state_of(spark, f"{sf_dir}/events.parquet"))
    if key not in _STORES:
        store, late = _half_stored(spark, sf_dir, "sketch")
        days = store.days(store.records_path)
        store.compact(days[::2])
        store.close(days[::3])
        write_batch(store, late, 1, min_partitions=PARTS)
        store.compact(days[::4])
        store.close(days[::6])
        _STORES[key] = store
    return _STORES[key]


def sketched_rollup(spark: SparkSession, sf_dir: str, records: DataFrame, rollup: Rollup) -> DataFrame:
    """A rollup of a store with sketches: exact measures, and whether each distinct count is close to the exact one."""
    return _beside_exact(sketched_store(spark, sf_dir).rollup(rollup), records, rollup)


def sketched_report(spark: SparkSession, sf_dir: str, records: DataFrame, plan: Callable[[Tables], DataFrame], keys: list[str]) -> DataFrame:
    """A report on subscribers from a store with sketches: whether its counts are within three standard errors, taken of
    all subscribers, of the report on the records."""
    estimated, exact = plan(sketched_store(spark, sf_dir).tables()), plan(Tables.from_records(records))
    counts = [name for name in exact.columns if name not in keys]
    bound = records.agg((3 * sketches.STANDARD_ERROR * F.count_distinct("subscriber_id") + 1).alias("bound"))
    beside = exact.select(*keys, *[F.col(name).alias(f"exact_{name}") for name in counts])
    joined = (estimated.join(beside, keys, "full") if keys else estimated.join(beside)).join(bound)
    return joined.select(*keys, *[F.coalesce(F.abs(F.col(name) - F.col(f"exact_{name}")) <= F.col("bound"), F.lit(False)).alias(f"{name}_close") for name in counts])


def retained_stored_rollup(spark: SparkSession, sf_dir: str, rollup: Rollup) -> DataFrame:
    """A stored rollup at a time when its retention ends inside the data."""
    now = F.expr(f"TIMESTAMP '{RETENTION_EDGE}' + INTERVAL {rollup.retention_days} DAYS")
    tables = streamed_store(spark, sf_dir).tables(now)
    return tables.rollup(rollup.name).select(*rollup.group_keys, *rollup.columns)


def live_rates(spark: SparkSession, sf_dir: str, per_second: bool, fast_clocks: bool = False) -> DataFrame:
    """Windows closed by the time the stream has read all events, in several micro-batches in order of time."""
    folder, events = new_folder(spark, "rates"), read_events(configure(spark), sf_dir)
    lines = event_lines(events).join(events.select("event_id", "ts"), "event_id")
    if fast_clocks:  # the same lines again from devices that live in another century
        ahead = lines.filter("event_id % 97 = 0").withColumn("raw_message", F.regexp_replace("raw_message", "202[0-9]-", "2099-"))
        lines = lines.unionByName(ahead)
    part = F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(PARTS - 1))
    records = parse_records(_lines_in_parts(lines, part, folder))
    rates = live_per_second(records) if per_second else live_per_minute(records)
    for number in range(PARTS):
        _deliver(spark, folder, number)
        write_rates(rates, f"{folder}/rates", f"{folder}/checkpoint", available_now=True).awaitTermination()
    return spark.read.schema(rates.schema).parquet(f"{folder}/rates")


def large_counters(events: DataFrame) -> DataFrame:
    """Bytes per subscriber, merged from two halves, where every fifth counter is close to 2^63."""
    lines = events.select(F.expr(LARGE_LINE_SQL).alias("raw_message"), F.lit(INGEST_TS).cast("timestamp").alias("ingest_ts"))
    merged = merged_halves(parse_records(lines), SUBSCRIBERS)
    return merged.select("day", "subscriber_id", "session_count", "total_bytes_in", "total_bytes_out", "total_bytes")


def merged_halves(records: DataFrame, rollup: Rollup) -> DataFrame:
    """A rollup put together from the morning's and the afternoon's records."""
    morning = records.filter(F.hour("timestamp") < 12)
    afternoon = records.filter(F.hour("timestamp") >= 12)
    return merge_rollups(
        measures_part(morning, rollup),
        measures_part(afternoon, rollup),
        rollup,
        members_part(morning, rollup),
        members_part(afternoon, rollup),
    )


def merged_sketches(records: DataFrame, rollup: Rollup) -> DataFrame:
    """The same from merged sketches: keys, exact measures, and whether each estimated distinct count lies within
    ``SKETCH_ERROR`` of the exact one."""
    morning = records.filter(F.hour("timestamp") < 12)
    afternoon = records.filter(F.hour("timestamp") >= 12)
    parts = [measures_part(part, rollup, sketches=True) for part in (morning, afternoon)]
    return _beside_exact(merge_parts(parts[0].unionByName(parts[1]), rollup), records, rollup)


def _beside_exact(merged: DataFrame, records: DataFrame, rollup: Rollup) -> DataFrame:
    exact = build(records, rollup).select(*rollup.group_keys, *[F.col(name).alias(f"exact_{name}") for name in rollup.uniques])
    joined = merged.join(exact, list(rollup.group_keys))
    close = [(F.abs(F.col(name) - F.col(f"exact_{name}")) <= SKETCH_ERROR * F.col(f"exact_{name}") + 1).alias(f"{name}_close") for name in rollup.uniques]
    return joined.select(*rollup.group_keys, *[name for name in rollup.columns if name not in rollup.uniques], *close)


def retained_per_day(records: DataFrame, now: str) -> DataFrame:
    """Records per day that are still inside their retention at ``now``."""
    kept = retained_records(records, F.lit(now).cast("timestamp"))
    return kept.groupBy(F.to_date("timestamp").alias("day")).agg(F.count(F.lit(1)).alias("sessions"))


def adhoc_sql(tables: Tables) -> DataFrame:
    """A free SQL query over the six tables as views."""
    tables.register_views("ledger_")
    return tables.records.sparkSession.sql(
        "SELECT r.service_type, r.sessions, a.total_bytes FROM"
        " (SELECT service_type, count(*) AS sessions FROM ledger_records GROUP BY service_type) r JOIN"
        " (SELECT service_type, sum(total_bytes) AS total_bytes FROM ledger_top_applications GROUP BY service_type) a"
        " ON r.service_type = a.service_type"
    )

