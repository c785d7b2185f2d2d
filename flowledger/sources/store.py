"""Partitioned Parquet tables of records, rollup parts and quarantined lines.

Layout below one base folder:

    records/day=…/batch_id=…                      session records, of folded days clustered on subscriber and time
    rollups/<name>/measures/day=…/batch_id=…      additive measures; of folded days with lists of numbered members
    rollups/<name>/members/day=…/batch_id=…       distinct members: text rows of batches, bitmaps of folded days
    rollups/subscribers/sketches/day=…/batch_id=… subscribers of each day, in a store with sketches
    rollups/per_<unit>/series/day=…/batch_id=…    traffic per second, minute and hour
    rollups/<name>/closed/day=…/batch_id=…        finished rows of closed days, distinct counts as numbers
    dictionary/day=…/batch_id=…                   numbers of the members of folded days, shared by all rollups
    collectors/day=…/batch_id=…                   collector ids of each batch
    first_seen/day=…/batch_id=…                   first days of subscribers, as changes that add up; never expires
    deliveries/day=…/batch_id=…                   positions of delivered messages, by day of arrival
    quarantine/day=…/batch_id=…                   by day of arrival
    late/day=…/batch_id=…                         records that came for a closed day whose own records have gone

    _log/sketches                                 says that distinct counts come from sketches
    _log/started/<batch_id>                       batches and foldings that have begun
    _log/committed/<batch_id>                     batches that are stored as a whole (of a stream, the last one)
    _log/folds/<group>/<day>/<batch_id>/<table>.<old>   a day's new parts and the parts they stand for
    _log/last_fold/<batch_id>                     the last number a folding got
    _log/checkpoints/<hash>/<first>               where the numbers of a stream begin
    _folding/<name>                               what a folding puts aside while it runs: crowded places, their sets

A batch only ever replaces its own ``batch_id`` partitions, and once committed it is never written again, so neither a
retry nor a replay changes anything, compacted or not. Readers leave out batches that are not committed and parts that
a folding stands for: a folding becomes visible with the one rename that puts its entry into the log. Records are one
group of tables, all rollups with the dictionary another: a day's rollups change their form together. First days are a
group of their own.

A day's rollups are open (rows of batches), folded (numbered members) or closed (finished counts, no members). A batch
that reaches a closed day reopens it from its records; if these have gone, its lines for that day are put aside.

A store with sketches has neither members nor a dictionary nor first days: its measures carry a sketch for each distinct
count, folding unites them, closing keeps the counts alone.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from flowledger import schema
from flowledger.operators import curve, deliveries, distinct, newcomers, series, sketches
from flowledger.operators.retention import retained_records, retained_rollup
from flowledger.operators.rollups import DAILY, ROLLUPS, SESSIONS, SUBSCRIBERS, Rollup, measures_part, members_part, merge_parts
from flowledger.plans.tables import Tables

_PARTITIONS = [T.StructField("day", T.DateType()), T.StructField("batch_id", T.LongType())]
_BIGINT, _STRING = T.LongType(), T.StringType()
Parts = dict[dt.date, set[int]]  # numbers of the parts a table has, by day
ROW_GROUP_BYTES = 32 << 20  # of folded records; small enough that filters on time skip some inside a file
SIDE_BY_SIDE = 16  # jobs or folder operations at a time
STREAM = 1 << 32  # numbers of one stream's batches; batches written by hand are below, foldings are negative


def _key_fields(rollup: Rollup) -> list[T.StructField]:
    bucket = T.StructField("hour", T.TimestampType()) if rollup.bucket == "hour" else T.StructField("day", T.DateType())
    return [bucket, *[T.StructField(key, _STRING) for key in rollup.keys]]


def _with_partitions(fields: list[T.StructField]) -> T.StructType:
    return T.StructType([f for f in fields if f.name != "day"] + _PARTITIONS)


def _additive_fields(rollup: Rollup) -> list[T.StructField]:
    return [T.StructField(name, _BIGINT) for name in (SESSIONS, *rollup.sums, *rollup.maxima)]


def _measures_schema(rollup: Rollup, sketched: bool = False) -> T.StructType:
    if sketched:
        members = [T.StructField(sketches.sketch_name(name), T.BinaryType()) for name in rollup.uniques]
    else:
        members = [T.StructField(distinct.list_name(name), T.ArrayType(_BIGINT)) for name in rollup.uniques]
    return _with_partitions(_key_fields(rollup) + _additive_fields(rollup) + members)


def _members_schema(rollup: Rollup) -> T.StructType:
    extra = [T.StructField("measure", _STRING), T.StructField("member", _STRING), T.StructField("stretch", _BIGINT), T.StructField("bits", T.BinaryType())]
    return _with_partitions(_key_fields(rollup) + extra)


def _closed_schema(rollup: Rollup) -> T.StructType:
    return _with_partitions(_key_fields(rollup) + _additive_fields(rollup) + [T.StructField(name, _BIGINT) for name in rollup.uniques])


_SERIES_SCHEMA = T.StructType([T.StructField("t", T.TimestampType()), *[T.StructField(name, _BIGINT) for name in (SESSIONS, *series.SUMS)], *_PARTITIONS])
_DICTIONARY_SCHEMA = T.StructType([T.StructField("kind", _STRING), T.StructField("member", _STRING), T.StructField("number", _BIGINT), *_PARTITIONS])
_FIRST_SEEN_SCHEMA = T.StructType([T.StructField("subscriber_id", _STRING), T.StructField("change", _BIGINT), *_PARTITIONS])
_DAY_SKETCHES_SCHEMA = T.StructType([T.StructField("subscribers", T.BinaryType()), *_PARTITIONS])
_DELIVERIES_SCHEMA = _with_partitions(deliveries.BLOCKS.fields)
_RECORDS_SCHEMA = _with_partitions([*schema.RECORDS.fields, T.StructField("yyyymm", _STRING)])


def _day_of(rollup: Rollup):
    return F.to_date("hour") if rollup.bucket == "hour" else F.col("day")


class State(NamedTuple):
    """What the log says at one moment."""

    unfinished: frozenset[int]
    committed: frozenset[int]
    folds: dict[str, dict[dt.date, tuple[int, dict[str, set[int]]]]]


class Store:
    """Reads and writes the tables below ``base``.

    ``distinct_counts``: "exact", from members, or "sketch", within the error of a theta sketch. A store keeps to the one
    it began with.
    """

    def __init__(self, spark: SparkSession, base: str, distinct_counts: str = "exact"):
        if distinct_counts not in ("exact", "sketch"):
            raise ValueError(f"distinct_counts is 'exact' or 'sketch', not {distinct_counts!r}")
        self.spark = spark
        self.base = base.rstrip("/")
        self.sketched = distinct_counts == "sketch"
        if _exists(spark, self.path("_log", "started")) and _exists(spark, self.path("_log", "sketches")) != self.sketched:
            raise ValueError(f"{self.base} was begun with other distinct counts than {distinct_counts!r}")

    def path(self, *parts: str) -> str:
        return "/".join([self.base, *parts])

    @property
    def records_path(self) -> str:
        return self.path("records")

    def measures_path(self, rollup: Rollup) -> str:
        return self.path("rollups", rollup.name, "measures")

    def members_path(self, rollup: Rollup) -> str:
        return self.path("rollups", rollup.name, "members")

    def closed_path(self, rollup: Rollup) -> str:
        return self.path("rollups", rollup.name, "closed")

    @property
    def dictionary_path(self) -> str:
        return self.path("dictionary")

    @property
    def first_seen_path(self) -> str:
        return self.path("first_seen")

    @property
    def day_sketches_path(self) -> str:
        return self.path("rollups", "subscribers", "sketches")

    def series_path(self, unit: str) -> str:
        return self.path("rollups", f"per_{unit}", "series")

    def _rollup_tables(self) -> dict[str, T.StructType]:
        """Paths and columns of all tables a day's rollups consist of."""
        shared = {self.day_sketches_path: _DAY_SKETCHES_SCHEMA} if self.sketched else {self.dictionary_path: _DICTIONARY_SCHEMA}
        tables = shared | dict.fromkeys(map(self.series_path, series.UNITS), _SERIES_SCHEMA)
        for rollup in ROLLUPS.values():
            tables |= self._tables_of(rollup)
        return tables

    def _tables_of(self, rollup: Rollup) -> dict[str, T.StructType]:
        members = {} if self.sketched else {self.members_path(rollup): _members_schema(rollup)}
        return {self.measures_path(rollup): _measures_schema(rollup, self.sketched)} | members | {self.closed_path(rollup): _closed_schema(rollup)}

    # Reading

    def _read(self, path: str, columns: T.StructType) -> DataFrame:
        return self._read_together({path: columns})[0][path]

    def _read_together(self, tables: dict[str, T.StructType]) -> tuple[dict[str, DataFrame], dict[str, Parts]]:
        """The visible rows of some tables and the parts they come from. Files are listed between two equal looks at the
        log, so what is hidden and what the files of all these tables hold belong to one state."""
        state = self._look(tables)
        while True:
            frames, parts = {}, {}
            for path, columns in tables.items():
                frames[path] = self.spark.read.schema(columns).parquet(path) if _exists(self.spark, path) else None
                parts[path] = _parts_in(frames[path])
            before, state = state, self._look(tables)
            if state == before:
                break
        for path, columns in tables.items():
            frames[path] = self.spark.createDataFrame([], columns) if frames[path] is None else self._shown(path, frames[path], state)
        return frames, {path: self._visible(path, parts[path], state) for path in tables}

    def _shown(self, path: str, rows: DataFrame, state: State) -> DataFrame:
        folds = state.folds[self._group(path)]
        hidden = state.unfinished - {new for new, _ in folds.values()}
        if hidden:
            rows = rows.filter(~F.col("batch_id").isin(sorted(hidden)))
        for day, (_, old) in folds.items():
            if ids := old.get(self._table(path)):
                rows = rows.filter(~((F.col("day") == F.lit(day)) & F.col("batch_id").isin(sorted(ids))))
        return rows

    def _look(self, paths: Iterable[str]) -> State:
        """What the log says about some tables, and how far batches have come."""
        groups = sorted({self._group(path) for path in paths})
        return State(self._unfinished(), frozenset(self._logged("committed")), {group: self._folds(group) for group in groups})

    def _visible(self, path: str, parts: Parts, state: State) -> Parts:
        folds, table = state.folds[self._group(path)], self._table(path)
        found = {}
        for day, ids in parts.items():
            new, old = folds.get(day, (None, {}))
            kept = {i for i in ids if i == new or i not in state.unfinished} - old.get(table, set())
            if kept:
                found[day] = kept
        return found

    # The log

    def _logged(self, kind: str) -> set[int]:
        return {int(name) for name in _child_folders(self.spark, self.path("_log", kind))}

    def _unfinished(self) -> frozenset[int]:
        started = self._logged("started")
        committed = self._logged("committed") if started else set()
        return frozenset(batch for batch in started if not self._committed(batch, committed))

    def _committed(self, batch_id: int, committed: set[int] | None = None) -> bool:
        committed = self._logged("committed") if committed is None else committed
        stream = batch_id // STREAM
        # a stream commits in order, so its last batch speaks for those before it
        return batch_id in committed or (stream > 0 and any(b >= batch_id for b in committed if b // STREAM == stream))

    def _table(self, path: str) -> str:
        return path.removeprefix(f"{self.base}/").replace("/", ".")

    def _group(self, path: str) -> str:
        """Tables whose parts of a day are replaced together."""
        table = self._table(path)
        return "rollups" if table == "dictionary" or table.startswith("rollups.") else table

    def _folds_path(self, group: str) -> str:
        return self.path("_log", "folds", group)

    def _folds(self, group: str) -> dict[dt.date, tuple[int, dict[str, set[int]]]]:
        """Per day the new number and the parts of each table it stands for, of foldings whose old parts may still lie
        there."""
        found = {}
        for day in _child_folders(self.spark, self._folds_path(group)):
            for new in _child_folders(self.spark, f"{self._folds_path(group)}/{day}"):
                old: dict[str, set[int]] = {}
                for name in _child_folders(self.spark, f"{self._folds_path(group)}/{day}/{new}"):
                    table, _, number = name.rpartition(".")
                    old.setdefault(table, set()).add(int(number))
                found[dt.date.fromisoformat(day)] = (int(new), old)
        return found

    def begin(self, batch_id: int) -> bool:
        """Notes that a batch is being written; False if it is stored already. What a broken attempt has left goes: the
        next one may write fewer days, since other batches have been stored meanwhile."""
        if self._committed(batch_id):
            return False
        if self.sketched:
            _make_folder(self.spark, self.path("_log", "sketches"))
        started = self.path("_log", "started", str(batch_id))
        if _exists(self.spark, started):
            paths = [self.records_path, self.first_seen_path, *map(self.path, ("collectors", "deliveries", "quarantine", "late"))]
            for path in [*paths, *self._rollup_tables()]:
                self._discard(path, batch_id)
        _make_folder(self.spark, started)
        return True

    def _discard(self, path: str, batch_id: int) -> None:
        for day, ids in self._parts_of(path).items():
            if batch_id in ids:
                _delete(self.spark, f"{path}/day={day.isoformat()}/batch_id={batch_id}")

    def commit(self, batch_id: int) -> None:
        """Makes a batch visible as a whole; from now on it is never written again."""
        _make_folder(self.spark, self.path("_log", "committed", str(batch_id)))
        _delete(self.spark, self.path("_log", "started", str(batch_id)))
        if batch_id > STREAM and batch_id % STREAM:
            _delete(self.spark, self.path("_log", "committed", str(batch_id - 1)))

    def first_batch(self, checkpoint: str) -> int:
        """The number a stream's batch 0 has here. Every checkpoint has a range of its own; one that has not been used
        yet, or was emptied, gets a new one."""
        noted = self.path("_log", "checkpoints", hashlib.sha256(checkpoint.encode()).hexdigest())
        known = [int(name) for name in _child_folders(self.spark, noted)]
        if known and _exists(self.spark, f"{checkpoint}/offsets"):
            return max(known)
        taken = [0]
        for name in _child_folders(self.spark, self.path("_log", "checkpoints")):
            taken += [int(first) for first in _child_folders(self.spark, self.path("_log", "checkpoints", name))]
        first = max(taken) + STREAM
        _make_folder(self.spark, f"{noted}/{first}")
        return first

    def records(self) -> DataFrame:
        """All stored records, with ``day`` for partition pruning."""
        return self._read(self.records_path, _RECORDS_SCHEMA)

    def measures(self, rollup: Rollup) -> DataFrame:
        return self._read(self.measures_path(rollup), _measures_schema(rollup, self.sketched))

    def members(self, rollup: Rollup) -> DataFrame:
        return self._read(self.members_path(rollup), _members_schema(rollup))

    def rollup(self, rollup: Rollup) -> DataFrame:
        """The merged rollup. Filters on the keys reach the part files; unused distinct counts are not read."""
        frames, parts = self._read_together(self._tables_of(rollup) | ({} if self.sketched else {self.dictionary_path: _DICTIONARY_SCHEMA}))
        return self._merged(rollup, frames, parts)

    def _merged(self, rollup: Rollup, frames: dict[str, DataFrame], parts: dict[str, Parts]) -> DataFrame:
        """The rollup's rows from its parts, in whatever form a day has them."""
        # day is no key of an hourly rollup; it is kept through the merge so that filters on it prune partitions
        keyed = _keyed_by_day(rollup)
        measures = frames[self.measures_path(rollup)]
        closed = frames[self.closed_path(rollup)] if parts[self.closed_path(rollup)] else None
        if self.sketched:
            return sketches.counted(measures, keyed, closed)
        members, members_parts = frames[self.members_path(rollup)], parts[self.members_path(rollup)]
        folded = sorted(parts[self.dictionary_path])
        late = [day for day in folded if any(i >= 0 for i in members_parts.get(day, ()))]
        counts = distinct.distinct_counts(measures, members, frames[self.dictionary_path], keyed, folded, late, closed)
        additive = [*keyed.group_keys, SESSIONS, *rollup.sums, *rollup.maxima]
        rows = measures.select(*additive) if closed is None else measures.select(*additive).unionByName(closed.select(*additive))
        return merge_parts(rows, keyed, counts=counts)

    def series(self, unit: str) -> DataFrame:
        """Traffic per second, minute or hour: (t, day, session_count, bytes_in, bytes_out, bytes_total)."""
        return series.added_up(self._read(self.series_path(unit), _SERIES_SCHEMA), unit)

    def traffic(self, start: Column, end: Column, coarsest: str = "hour") -> DataFrame:
        """The fewest rows of the series that cover a range, from one state of the log."""
        paths = {self.series_path(unit): _SERIES_SCHEMA for unit in series.UNITS}
        frames, _ = self._read_together(paths)
        return series.covering(lambda unit: frames[self.series_path(unit)].drop("batch_id"), start, end, coarsest)

    def tables(self, as_of: Column | None = None) -> Tables:
        """All six tables; with ``as_of`` without the rows whose retention has passed at that time."""
        if as_of is None:
            return Tables(self.records(), self.rollup, self.collectors(), self.latest, self.traffic, self.newcomers, self.day_sketches())
        kept = lambda rollup: retained_rollup(self.rollup(rollup), rollup, as_of)
        latest = lambda count: retained_records(self.latest(count), as_of)
        oldest = F.date_trunc("second", as_of - F.make_dt_interval(F.lit(series.RETENTION_DAYS))) + F.expr("INTERVAL 1 SECOND")
        traffic = lambda start, end, coarsest: self.traffic(F.greatest(start, oldest), end, coarsest)
        return Tables(retained_records(self.records(), as_of), kept, self.collectors(as_of), latest, traffic)

    def newcomers(self, since: Column) -> DataFrame | None:
        """(day, new_subscribers) from a day on: subscribers whose first line of all ever stored is of that day, read from
        these days only. None in a store that has no first days yet: its next batch adds them for all days."""
        frames, parts = self._read_together({self.first_seen_path: _FIRST_SEEN_SCHEMA})
        if not parts[self.first_seen_path]:
            return None
        return newcomers.per_day(frames[self.first_seen_path].filter(F.col("day") >= since))

    def day_sketches(self) -> DataFrame | None:
        """(day, subscribers): sketches of each day's subscribers, of one batch or several; None in an exact store."""
        return self._read(self.day_sketches_path, _DAY_SKETCHES_SCHEMA).select("day", "subscribers") if self.sketched else None

    def collectors(self, as_of: Column | None = None) -> DataFrame:
        """The collectors that were ever stored, from a small table each batch adds its own to. With ``as_of`` those of
        records kept at that time: only the day in which the retention ends is looked up in the records."""
        columns = T.StructType([T.StructField("collector_id", _STRING), *_PARTITIONS])
        rows = self._read(self.path("collectors"), columns)
        if as_of is None:
            return rows.select("collector_id").distinct()
        last_day = F.to_date(as_of - F.make_dt_interval(F.lit(schema.RECORD_RETENTION_DAYS)))
        rest = retained_records(self.records().filter(F.col("day") == last_day), as_of)
        return rows.filter(F.col("day") > last_day).select("collector_id").unionByName(rest.select("collector_id")).distinct()

    def latest(self, count: int) -> DataFrame:
        """Records of the newest days, as many days as ``count`` records need; older days cannot hold a newer one."""
        records, days, seen = self.records(), [], 0
        for day in reversed(self.days(self.records_path)):
            days.append(day)
            seen += records.filter(F.col("day") == F.lit(day)).limit(count).count()
            if seen >= count:
                break
        return records.filter(F.col("day").isin(days))

    def quarantined(self) -> DataFrame:
        columns = T.StructType([*schema.RAW_LINES.fields, T.StructField("reason", _STRING), *_PARTITIONS])
        return self._read(self.path("quarantine"), columns)

    # Writing

    def _write(self, table: DataFrame, path: str, partitions: Iterable[str], mode: str = "overwrite", options: dict[str, str] | None = None) -> None:
        (
            table.write.mode(mode)
            .options(**(options or {}))
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions)
            .parquet(path)
        )

    def new_deliveries(self, lines: DataFrame, batch_id: int) -> DataFrame:
        """Lines without those of messages that stored batches had, through whatever checkpoint; notes the positions of the
        batch. Lines without positions all stay. How late a line is plays no part.

        Positions are kept as long as records. Only blocks the batch has are looked up; if none is known, as usual, the
        lines are not joined. Two streams that read the same messages at the same time both count.
        """
        if not deliveries.has_positions(lines):
            return lines
        path = self.path("deliveries")
        rows = deliveries.blocks(lines).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        self._write(rows.hint("rebalance", "day"), path, ["day", "batch_id"])
        own = self.spark.read.schema(_DELIVERIES_SCHEMA).parquet(path).filter(F.col("batch_id") == batch_id)
        days = [row.day for row in own.select("day").distinct().collect()]
        stored = self._read(path, _DELIVERIES_SCHEMA).filter(F.col("day").isin(days) & (F.col("batch_id") != batch_id))
        known = stored.join(own.select(*deliveries.KEYS), list(deliveries.KEYS), "left_semi")
        return lines if known.isEmpty() else deliveries.undelivered(lines, known)

    def write_records(self, records: DataFrame, batch_id: int) -> None:
        """Appends one batch. Rebalancing splits a busy day over many tasks and joins the crumbs of quiet ones."""
        rows = records.select(
            *schema.RECORDS.names,
            F.date_format("timestamp", "yyyyMM").alias("yyyymm"),
            F.to_date("timestamp").alias("day"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
        )
        balanced = rows.hint("rebalance", "day").sortWithinPartitions("day", "batch_id", "subscriber_id", "timestamp")
        self._write(balanced, self.records_path, ["day", "batch_id"])
        self._write(rows.select("collector_id", "day", "batch_id").distinct().coalesce(1), self.path("collectors"), ["day", "batch_id"])

    def _write_part(self, part: DataFrame, rollup: Rollup, path: str, batch_id: int) -> None:
        placed = part.withColumn("day", _day_of(rollup)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        keys = [key for key in rollup.group_keys if key != "day"]
        balanced = placed.hint("rebalance", "day").sortWithinPartitions("day", "batch_id", *keys)
        self._write(balanced, path, ["day", "batch_id"])

    def write_outputs(self, records: DataFrame, batch_id: int) -> None:
        """Writes what a batch's records add to all tables: records, first days, rollups and series.

        The outputs are independent jobs over the same rows and run side by side, so none waits for the last tasks of
        another; those of several steps begin first.
        """
        jobs = [lambda: self.write_first_seen(records, batch_id), lambda: self.write_records(records, batch_id)]
        self._side_by_side(jobs + self._rollup_jobs(records, batch_id))

    def write_rollup_parts(self, records: DataFrame, batch_id: int) -> None:
        """Adds the batch's share to all five rollups and the series; the work grows with the batch, not with the stored
        day."""
        self._side_by_side(self._rollup_jobs(records, batch_id))

    def _rollup_jobs(self, records: DataFrame, batch_id: int) -> list[Callable[[], None]]:
        jobs = [lambda: self._write_all_series(records, batch_id)]
        for rollup in ROLLUPS.values():
            parts = self._parts_from(records, rollup)
            jobs += [lambda part=part, rollup=rollup, path=path: self._write_part(part, rollup, path, batch_id) for path, part in parts.items()]
        if self.sketched:
            per_day = sketches.days_of(records).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            jobs.append(lambda: self._write(per_day, self.day_sketches_path, ["day", "batch_id"]))
        return jobs

    def _parts_from(self, records: DataFrame, rollup: Rollup) -> dict[str, DataFrame]:
        """What records add to the tables of a rollup, by path."""
        if self.sketched:
            return {self.measures_path(rollup): sketches.sketched_part(records, rollup)}
        return {self.measures_path(rollup): measures_part(records, rollup), self.members_path(rollup): members_part(records, rollup)}

    def _write_all_series(self, records: DataFrame, batch_id: int) -> None:
        """Each series from the finer one as just written, so records are read and added up by second once."""
        finer = series.as_series(records)
        for unit in series.UNITS:
            self._write_series(series.added_up(finer, unit), unit, batch_id)
            if not _exists(self.spark, self.series_path(unit)):  # a batch without records
                return
            finer = self.spark.read.schema(_SERIES_SCHEMA).parquet(self.series_path(unit)).filter(F.col("batch_id") == batch_id)

    def _write_series(self, part: DataFrame, unit: str, batch_id: int) -> None:
        rows = part.withColumn("batch_id", F.lit(batch_id).cast("bigint")).hint("rebalance", "day")
        self._write(rows.sortWithinPartitions("day", "batch_id", "t"), self.series_path(unit), ["day", "batch_id"])

    def _side_by_side(self, jobs: list[Callable[[], None]]) -> None:
        if not jobs:
            return
        with ThreadPoolExecutor(max_workers=min(len(jobs), SIDE_BY_SIDE)) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(lambda job: job()), jobs))

    def write_first_seen(self, records: DataFrame, batch_id: int) -> None:
        """Adds what the batch changes about first days; the first batch of a store without them brings all days up. A
        store with sketches needs none.

        What is written depends on the state, so if another batch commits meanwhile, the changes are made again. Should two commit in the very same moment, a subscriber new in both counts
        twice until the next line about them, or until :meth:`rebuild_first_seen`.
        """
        if self.sketched:
            return
        path = self.first_seen_path
        batch = records.select("subscriber_id", F.to_date("timestamp").alias("day"))
        while True:
            before = self._look([path])
            frames, parts = self._read_together({path: _FIRST_SEEN_SCHEMA})
            seen = batch if parts[path] else batch.unionByName(self.rollup(SUBSCRIBERS).select("subscriber_id", "day"))
            rows = newcomers.changes(seen, frames[path]).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            self._write(rows.hint("rebalance", "day"), path, ["day", "batch_id"])
            after = self._look([path])
            if (before.committed, before.folds) == (after.committed, after.folds):
                return
            self._discard(path, batch_id)

    def write_quarantine(self, lines: DataFrame, batch_id: int) -> None:
        day = F.to_date("ingest_ts").alias("day")
        rows = lines.select("raw_message", "ingest_ts", "reason", day, F.lit(batch_id).cast("bigint").alias("batch_id"))
        self._write(rows, self.path("quarantine"), ["day", "batch_id"])

    # Closed days

    def closed_days(self) -> list[dt.date]:
        """Days whose rollups are stored as finished counts."""
        path = self.closed_path(DAILY)
        return sorted(self._visible(path, self._parts_of(path), self._look([path])))

    def make_room(self, records: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Reopens the closed days a batch reaches; returns its records, and apart those of days that stay closed."""
        closed = self.closed_days()
        if not closed:
            return records, None
        day = F.to_date("timestamp")
        touched = [row.day for row in records.filter(day.isin(closed)).select(day.alias("day")).distinct().collect()]
        kept = sorted(set(touched) - set(self.reopen(touched)))
        if not kept:
            return records, None
        return records.filter(~day.isin(kept) | day.isNull()), records.filter(day.isin(kept))

    def write_late(self, records: DataFrame, batch_id: int) -> None:
        """Puts records of days that stay closed aside. They are in no other table."""
        rows = records.select(*schema.RECORDS.names, F.date_format("timestamp", "yyyyMM").alias("yyyymm"), F.to_date("timestamp").alias("day"), F.lit(batch_id).cast("bigint").alias("batch_id"))
        self._write(rows, self.path("late"), ["day", "batch_id"])

    def late_records(self) -> DataFrame:
        """Records put aside: they came for a closed day whose own records had gone."""
        return self._read(self.path("late"), _RECORDS_SCHEMA)

    def close(self, days: dt.date | Iterable[dt.date], keep_replaced: bool = False) -> None:
        """Stores finished counts of whole days in place of their measures and members.

        Batches may arrive meanwhile; a day that got one behind its closing is reopened.
        """
        days = _listed(days)
        self.settle()
        self._fold_rollups(days, closed=True, keep_replaced=keep_replaced)
        self.settle()

    def settle(self) -> None:
        """Reopens those closed days that have open parts as well: of a batch that began before the day was closed. Until
        then, or if their records have gone, the members of such a batch all count as new ones."""
        path, closed = self.measures_path(DAILY), self.closed_days()
        if closed:
            self.reopen(self._visible(path, self._parts_of(path, closed), self._look([path])))

    def reopen(self, days: dt.date | Iterable[dt.date]) -> list[dt.date]:
        """Builds closed days anew from their records, with members; days that no longer have all their records stay
        closed. Returns the days that are open."""
        days = sorted(set(_listed(days)) & set(self.closed_days()))
        whole = [day for day in days if day not in self._without_records(days)] if days else []
        if whole:
            self._fold_rollups(whole, from_records=True)
        return whole

    def _without_records(self, days: list[dt.date]) -> dict[dt.date, tuple[int, int]]:
        """Days whose rollups count more sessions than there are records: (sessions, records). Both from one state."""
        tables = {self.records_path: _RECORDS_SCHEMA, self.measures_path(DAILY): _measures_schema(DAILY, self.sketched), self.closed_path(DAILY): _closed_schema(DAILY)}
        frames, _ = self._read_together(tables)
        records, measures, closed = (frames[path].filter(F.col("day").isin(days)) for path in tables)
        held = records.groupBy("day").agg(F.lit(0).cast("bigint").alias("sessions"), F.count(F.lit(1)).alias("records"))
        for table in (measures, closed):
            held = held.unionByName(table.groupBy("day").agg(F.sum(SESSIONS).alias("sessions"), F.lit(0).cast("bigint").alias("records")))
        sums = held.groupBy("day").agg(F.sum("sessions").alias("sessions"), F.sum("records").alias("records"))
        return {row.day: (row.sessions, row.records) for row in sums.filter("sessions > records").collect()}

    # Upkeep

    def days(self, path: str) -> list[dt.date]:
        """Days that have a partition, read from folder names."""
        found = []
        for name in _child_folders(self.spark, path):
            if name.startswith("day=") and name != "day=__HIVE_DEFAULT_PARTITION__":
                found.append(dt.date.fromisoformat(name.removeprefix("day=")))
        return sorted(found)

    def next_batch(self) -> int:
        """A number for a batch written by hand: beyond all that were ever begun or committed, whatever they reached."""
        return max([-1, *[b for b in self._logged("started") | self._logged("committed") if b < STREAM]]) + 1

    def apply_retention(self, as_of: dt.date) -> dict[str, list[dt.date]]:
        """Drops whole days older than each table's retention; the day exactly at the limit stays.

        Quarantined lines, collectors, positions and records put aside are kept as long as records, the dictionary as long
        as any rollup.
        """
        limits = dict.fromkeys((self.records_path, self.path("collectors"), self.path("quarantine"), self.path("late"), self.path("deliveries")), schema.RECORD_RETENTION_DAYS)
        for rollup in ROLLUPS.values():
            limits |= dict.fromkeys(self._tables_of(rollup), rollup.retention_days)
        limits |= dict.fromkeys(map(self.series_path, series.UNITS), series.RETENTION_DAYS)
        limits[self.day_sketches_path] = SUBSCRIBERS.retention_days
        limits[self.dictionary_path] = max(rollup.retention_days for rollup in ROLLUPS.values())
        dropped = {}
        for path, keep in limits.items():
            oldest = as_of - dt.timedelta(days=keep)
            dropped[path] = [day for day in self.days(path) if day < oldest]
            for day in dropped[path]:
                _delete(self.spark, f"{path}/day={day.isoformat()}")
        return dropped

    def compact(self, days: dt.date | Iterable[dt.date], keep_replaced: bool = False) -> None:
        """Folds all committed batches of each day into one: records clustered on subscriber and time alike, so that
        filters on either skip row groups, rollups with numbered members. Closed days stay closed.

        Several days are folded by the same jobs. Batches may arrive meanwhile: a folding takes the batches it has listed
        and no others. A run that was cut off leaves nothing readers see, or a finished folding whose old parts the next
        run removes. ``keep_replaced`` leaves them to the next run too, for readers that planned their scan before.
        """
        days = _listed(days)
        # both are listed and numbered before the first one writes; then none waits for the other
        foldings = [self._records_folding(days, keep_replaced), self._rollups_folding(days, keep_replaced=keep_replaced)]
        self._side_by_side([folding for folding in foldings if folding])
        self._fold_first_seen(days, keep_replaced)  # alone: a batch that arrives meanwhile reads them

    def rebuild_rollups(self, days: dt.date | Iterable[dt.date], fewer: bool = False) -> None:
        """Recomputes the rollups of whole days from their records, for backfills and repairs.

        Records and the parts they replace are of one state of the log: a batch that commits meanwhile is in neither and
        counts beside them. The old parts count until the new ones are written. A day whose rollups count more sessions
        than it has records (records are not kept as long as rollups) is refused, and with it the call, unless ``fewer``
        says that the records are right; first days are then those of lines that have gone as well, until
        :meth:`rebuild_first_seen`.
        """
        days = _listed(days)
        gone = {} if fewer else self._without_records(days)
        if gone:
            told = ", ".join(f"{day}: {sessions} sessions, {records} records" for day, (sessions, records) in sorted(gone.items()))
            raise ValueError(f"rollups of days without all their records cannot be rebuilt ({told})")
        self._fold_rollups(days, from_records=True)

    # Of a folding of records or rollups, listed and numbered at once, what is returned writes and publishes it; None if there
    # is nothing to do.

    def _fold_records(self, days: list[dt.date], keep_replaced: bool) -> None:
        if folding := self._records_folding(days, keep_replaced):
            folding()

    def _records_folding(self, days: list[dt.date], keep_replaced: bool) -> Callable[[], None] | None:
        tables = {self.records_path: _RECORDS_SCHEMA}
        frames, parts = self._prepared(tables, days)
        work = {day: ids for day, ids in parts[self.records_path].items() if len(ids) > 1 or min(ids) >= 0}
        if not work:
            return None
        numbers = self._begin_folds(work)

        def fold() -> None:
            time_of_day = F.pmod(F.unix_seconds("timestamp"), F.lit(24 * 3600))
            rows = curve.with_curve(_chosen(frames[self.records_path], work), F.col("subscriber_id"), time_of_day)
            order = ["curve", "subscriber_id", "timestamp"]
            self._write_folded(rows.repartitionByRange("day", *order), self.records_path, numbers, order, leave_out=["curve"], row_group_bytes=ROW_GROUP_BYTES)
            self._publish(tables, parts, numbers, keep_replaced)

        return fold

    def _fold_first_seen(self, days: list[dt.date], keep_replaced: bool) -> None:
        tables = {self.first_seen_path: _FIRST_SEEN_SCHEMA}
        frames, parts = self._prepared(tables, days)
        work = {day: ids for day, ids in parts[self.first_seen_path].items() if len(ids) > 1 or min(ids) >= 0}
        if not work:
            return
        numbers = self._begin_folds(work)
        rows = newcomers.added_up(_chosen(frames[self.first_seen_path], work)).hint("rebalance", "day")
        self._write_folded(rows, self.first_seen_path, numbers, ["subscriber_id"])
        self._publish(tables, parts, numbers, keep_replaced)

    def rebuild_first_seen(self) -> None:
        """Makes the first days anew, as the subscriber rollup kept now has them. Days change one after the other; no batch
        may be written meanwhile. Nothing to do in a store with sketches."""
        if self.sketched:
            return
        path, firsts = self.first_seen_path, self.rollup(SUBSCRIBERS).groupBy("subscriber_id").agg(F.min("day").alias("day"))
        days = sorted({*self.days(path), *[row.day for row in firsts.select("day").distinct().collect()]})
        tables = {path: _FIRST_SEEN_SCHEMA}
        _, parts = self._prepared(tables, days)
        if not days:
            return
        numbers = self._begin_folds(days)
        self._write_folded(firsts.withColumn("change", F.lit(1).cast("bigint")).hint("rebalance", "day"), path, numbers, ["subscriber_id"])
        self._publish(tables, parts, numbers, keep_replaced=False)

    def _fold_rollups(self, days: list[dt.date], from_records: bool = False, closed: bool = False, keep_replaced: bool = False) -> None:
        if folding := self._rollups_folding(days, from_records, closed, keep_replaced):
            folding()

    def _rollups_folding(self, days: list[dt.date], from_records: bool = False, closed: bool = False, keep_replaced: bool = False) -> Callable[[], None] | None:
        """New parts of whole days for all rollups: folded from the visible parts or from the records, or closed."""
        tables = self._rollup_tables()
        frames, parts = self._prepared(tables | ({self.records_path: _RECORDS_SCHEMA} if from_records else {}), days)
        held = {day for path in tables for day in parts[path]}
        is_closed = set(parts[self.closed_path(DAILY)])
        if closed:
            work = {day for day in held if any(day in parts[path] for path in tables if not path.endswith(("/closed", "/series", "/sketches")))}
        elif from_records:
            work = held | set(parts[self.records_path])
        else:  # a day with one folded part in each table has nothing to fold
            open_days = {day for path in tables for day, ids in parts[path].items() if len(ids) > 1 or min(ids) >= 0}
            work = open_days - is_closed
        if not work:
            return None
        numbers = self._begin_folds(work)

        def fold() -> None:
            chosen = {path: _chosen(frame, {day: ids for day, ids in parts[path].items() if day in work}) for path, frame in frames.items()}
            if from_records:
                records = chosen[self.records_path].drop("day", "batch_id", "yyyymm")
                for rollup in ROLLUPS.values():
                    for path, part in self._parts_from(records, rollup).items():
                        chosen[path] = _padded(part.withColumn("day", _day_of(rollup)), tables[path])
            if closed:
                jobs = [lambda r=rollup: self._write_closed(r, chosen, parts, numbers) for rollup in ROLLUPS.values()]
            elif self.sketched:
                jobs = [lambda r=rollup: self._write_united(r, chosen, numbers) for rollup in ROLLUPS.values()]
            else:
                if from_records:
                    chosen[self.dictionary_path] = chosen[self.dictionary_path].limit(0)
                jobs = [lambda: self._write_numbered(chosen, numbers)]
            made = series.all_series(records) if from_records else {unit: series.added_up(chosen[self.series_path(unit)], unit) for unit in series.UNITS}
            jobs += [lambda unit=unit, rows=rows: self._write_folded(rows.hint("rebalance", "day"), self.series_path(unit), numbers, ["t"]) for unit, rows in made.items()]
            if self.sketched:
                per_day = sketches.days_of(records) if from_records else sketches.united_days(chosen[self.day_sketches_path])
                jobs.append(lambda: self._write_folded(per_day, self.day_sketches_path, numbers, []))
            self._side_by_side(jobs)
            self._publish(tables, parts, numbers, keep_replaced)

        return fold

    def _write_united(self, rollup: Rollup, chosen: dict[str, DataFrame], numbers: dict[dt.date, int]) -> None:
        rows = sketches.merge_sketched(chosen[self.measures_path(rollup)], _keyed_by_day(rollup))
        self._write_folded(rows.hint("rebalance", "day"), self.measures_path(rollup), numbers, [key for key in rollup.group_keys if key != "day"])

    def _write_numbered(self, chosen: dict[str, DataFrame], numbers: dict[dt.date, int]) -> None:
        dictionary = self._write_dictionary(chosen, numbers)
        self._side_by_side([lambda r=rollup: self._write_folded_rollup(r, chosen, dictionary, numbers) for rollup in ROLLUPS.values()])

    def _write_dictionary(self, chosen: dict[str, DataFrame], numbers: dict[dt.date, int]) -> DataFrame:
        """Numbers all members of the days; the dictionary as written."""
        seen = [distinct.seen_members(chosen[self.members_path(r)], r) for r in ROLLUPS.values()]
        rows = distinct.extended(chosen[self.dictionary_path], reduce(DataFrame.unionByName, seen))
        self._write_folded(rows.hint("rebalance", "day"), self.dictionary_path, numbers, ["kind", "member"])
        return _chosen(self.spark.read.schema(_DICTIONARY_SCHEMA).parquet(self.dictionary_path), {day: {new} for day, new in numbers.items()})

    def _write_folded_rollup(self, rollup: Rollup, chosen: dict[str, DataFrame], dictionary: DataFrame, numbers: dict[dt.date, int]) -> None:
        keyed = _keyed_by_day(rollup)
        measures, members = chosen[self.measures_path(rollup)], chosen[self.members_path(rollup)]
        order = [key for key in rollup.group_keys if key != "day"]
        staged = self.path("_folding", rollup.name)
        try:
            places = self._staged(distinct.crowded(measures, members, keyed), f"{staged}/places")
            sets = self._staged(distinct.sets(measures, members, dictionary, places, keyed), f"{staged}/sets")
            bitmaps = distinct.folded_members(sets, members, keyed)
            lists = distinct.folded_measures(measures, sets, members, dictionary, places, keyed)
            self._side_by_side([
                lambda: self._write_folded(bitmaps.hint("rebalance", "day"), self.members_path(rollup), numbers, order),
                lambda: self._write_folded(lists.hint("rebalance", "day"), self.measures_path(rollup), numbers, order),
            ])
        finally:
            _delete(self.spark, staged)

    def _staged(self, rows: DataFrame, path: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _write_closed(self, rollup: Rollup, chosen: dict[str, DataFrame], parts: dict[str, Parts], numbers: dict[dt.date, int]) -> None:
        own = {path: {day: ids for day, ids in parts[path].items() if day in numbers} for path in parts}
        rows = self._merged(rollup, chosen, own).select(*[f.name for f in _closed_schema(rollup).fields if f.name != "batch_id"])
        self._write_folded(rows.hint("rebalance", "day"), self.closed_path(rollup), numbers, [key for key in rollup.group_keys if key != "day"])

    # Foldings

    def _parts_of(self, path: str, days: Iterable[dt.date] | None = None) -> Parts:
        """The parts of a table that lie there, visible or not."""
        found = {}
        for day in self.days(path) if days is None else days:
            names = _child_folders(self.spark, f"{path}/day={day.isoformat()}")
            if names:
                found[day] = {int(name.removeprefix("batch_id=")) for name in names}
        return found

    def _prepared(self, tables: dict[str, T.StructType], days: list[dt.date]) -> tuple[dict[str, DataFrame], dict[str, Parts]]:
        """Finishes or removes foldings that were cut off, and reads the tables: their rows and the visible parts of the
        given days, all of one state of the log."""
        for group in {self._group(path) for path in tables}:
            self._clean(group, days)
        unfinished = self._unfinished()
        cut_off = {i for i in unfinished if i < 0}

        def remove(path: str) -> None:
            for day, ids in self._parts_of(path, days).items():
                for part in ids & cut_off:
                    _delete(self.spark, f"{path}/day={day.isoformat()}/batch_id={part}")

        if cut_off:
            self._side_by_side([lambda path=path: remove(path) for path in tables])
        frames, parts = self._read_together(tables)
        return frames, {path: {day: ids for day, ids in found.items() if day in days} for path, found in parts.items()}

    def _begin_folds(self, days: Iterable[dt.date]) -> dict[dt.date, int]:
        """A number for each day that no folding ever had; foldings run one at a time."""
        known = self._logged("last_fold")
        numbers = {day: min([0, *known]) - 1 - k for k, day in enumerate(sorted(days))}
        _make_folder(self.spark, self.path("_log", "last_fold", str(min(numbers.values()))))
        for number in known:
            _delete(self.spark, self.path("_log", "last_fold", str(number)))
        for number in numbers.values():
            _make_folder(self.spark, self.path("_log", "started", str(number)))
        return numbers

    def _write_folded(
        self, table: DataFrame, path: str, numbers: dict[dt.date, int], order: list[str], leave_out: Iterable[str] = (),
        row_group_bytes: int | None = None,
    ) -> None:
        """Writes the new parts in some order; columns to leave out only order the rows."""
        number = F.element_at(F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair]), F.col("day"))
        rows = table.withColumn("batch_id", number.cast("bigint"))
        options = {"parquet.block.size": str(row_group_bytes)} if row_group_bytes else {}
        self._write(rows.sortWithinPartitions("day", "batch_id", *order).drop(*leave_out), path, ["day", "batch_id"], "overwrite", options)

    def _publish(self, tables: Iterable[str], parts: dict[str, Parts], numbers: dict[dt.date, int], keep_replaced: bool) -> None:
        """Puts the new parts of each day in the place of the old ones of all tables, with one rename a day."""
        group = self._group(next(iter(tables)))

        def publish(day: dt.date) -> None:
            pending, new = self.path("_log", "pending", group, day.isoformat()), numbers[day]
            _delete(self.spark, pending)
            _make_folder(self.spark, f"{pending}/{new}")
            for path in tables:
                for part in parts[path].get(day, ()):
                    _make_folder(self.spark, f"{pending}/{new}/{self._table(path)}.{part}")
            _rename(self.spark, pending, f"{self._folds_path(group)}/{day.isoformat()}")

        self._side_by_side([lambda day=day: publish(day) for day in numbers])
        if not keep_replaced:
            self._clean(group, numbers)

    def _clean(self, group: str, days: Iterable[dt.date]) -> None:
        """Finishes published foldings: removes the parts they stand for, then their entries in the log."""

        def finish(day: dt.date) -> None:
            entry = f"{self._folds_path(group)}/{day.isoformat()}"
            for new in _child_folders(self.spark, entry):
                for name in _child_folders(self.spark, f"{entry}/{new}"):
                    table, _, old = name.rpartition(".")
                    _delete(self.spark, self.path(table.replace(".", "/"), f"day={day.isoformat()}", f"batch_id={old}"))
                _delete(self.spark, self.path("_log", "started", new))
            _delete(self.spark, entry)

        self._side_by_side([lambda day=day: finish(day) for day in days])


def _listed(days: dt.date | Iterable[dt.date]) -> list[dt.date]:
    return [days] if isinstance(days, dt.date) else sorted(set(days))


def _parts_in(table: DataFrame | None) -> Parts:
    """The parts whose files a table that was just listed reads."""
    found: Parts = {}
    for file in table.inputFiles() if table is not None else ():
        steps = file.split("/")
        found.setdefault(steps[-3].removeprefix("day="), set()).add(int(steps[-2].removeprefix("batch_id=")))
    return {dt.date.fromisoformat(day): ids for day, ids in found.items() if day != "__HIVE_DEFAULT_PARTITION__"}


def _chosen(table: DataFrame, parts: Parts) -> DataFrame:
    """The rows of some parts; days that have the same parts share a condition."""
    days_of: dict[tuple[int, ...], list[dt.date]] = {}
    for day, ids in parts.items():
        days_of.setdefault(tuple(sorted(ids)), []).append(day)
    wanted = [F.col("day").isin(days) & F.col("batch_id").isin(list(ids)) for ids, days in days_of.items()]
    return table.filter(reduce(Column.__or__, wanted)) if wanted else table.limit(0)


def _padded(table: DataFrame, columns: T.StructType) -> DataFrame:
    """The table with NULL in the columns it doesn't have."""
    return table.select(*[F.col(f.name) if f.name in table.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in columns.fields])


def _keyed_by_day(rollup: Rollup) -> Rollup:
    """The rollup with ``day`` among its keys (an hour lies in one day, so the rows stay the same)."""
    if rollup.bucket == "day":
        return rollup
    return Rollup(
        rollup.name, rollup.bucket, (*rollup.keys, "day"), rollup.sums, rollup.uniques, rollup.columns,
        rollup.retention_days, rollup.maxima,
    )


# Folder operations go through Hadoop's file system, so they work on any storage the tables can be on.


def _hadoop(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _exists(spark: SparkSession, path: str) -> bool:
    files, at = _hadoop(spark, path)
    return files.exists(at)


def _child_folders(spark: SparkSession, path: str) -> list[str]:
    files, at = _hadoop(spark, path)
    if not files.exists(at):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(at) if s.isDirectory())


def _delete(spark: SparkSession, path: str) -> None:
    files, at = _hadoop(spark, path)
    files.delete(at, True)


def _make_folder(spark: SparkSession, path: str) -> None:
    files, at = _hadoop(spark, path)
    files.mkdirs(at)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    files, at = _hadoop(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    files.mkdirs(to.getParent())
    if not files.rename(at, to):
        raise OSError(f"could not move {source} to {target}")
