"""First days of subscribers: kept up with batches in any order, read from the days asked for."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from flowledger.functions.timestamps import Clock
from flowledger.operators import newcomers
from flowledger.operators.parse import parse_records
from flowledger.plans.tables import Tables
from flowledger.plans.views import new_and_returning
from flowledger.sources.store import _FIRST_SEEN_SCHEMA, Store
from flowledger.streaming.ingest import write_batch
from tests.compare import spark_rows
from tests.test_days import lines_of

FIRST = dt.date(2024, 1, 20)
CLOCK = Clock("2024-01-30 12:00:00")


def visits(seed, count=60, users=25, days=11):
    draw = random.Random(seed)
    return [(f"u{int(users * draw.random() ** 2)}", "10.0.0.1", f"{FIRST + dt.timedelta(days=draw.randrange(days))}T10:00:00") for _ in range(count)]


def same_view(spark, store, rows):
    direct = new_and_returning(Tables.from_records(parse_records(lines_of(spark, rows))), CLOCK)
    stored = new_and_returning(store.tables(), CLOCK)
    assert stored.dtypes == direct.dtypes and spark_rows(stored) == spark_rows(direct)


def firsts_of(batches):
    first = {}
    for user, day in (pair for batch in batches for pair in batch if None not in pair):
        first[user] = min(day, first.get(user, day))
    return first


def test_changes_against_brute_force(spark):
    """Late earlier days, repeats, batches without news, nulls; two batches that did not know of each other."""
    draw = random.Random(7)
    pair = lambda: (f"u{draw.randrange(12)}", FIRST + dt.timedelta(days=draw.randrange(9)))
    batches = [[pair() for _ in range(15)] for _ in range(4)] + [[], [(None, FIRST), ("u1", None), ("", FIRST)]]
    state, columns = [], "subscriber_id string, day date, change bigint"
    for number, batch in enumerate(batches):
        known = [] if number == 1 else state  # the second one sees nothing of the first
        found = newcomers.changes(spark.createDataFrame(batch, "subscriber_id string, day date"), spark.createDataFrame(known, columns))
        state += [tuple(row) for row in found.collect()]
    met_again = {user for batch in batches[2:] for user, day in batch if day}
    sums = {}
    for user, day, change in state:
        sums[user, day] = sums.get((user, day), 0) + change
    kept = {key: n for key, n in sums.items() if n and key[0] in met_again}
    assert kept == {(user, day): 1 for user, day in firsts_of(batches).items() if user in met_again} and len(kept) > 10
    assert spark_rows(newcomers.added_up(spark.createDataFrame(state, columns)))[1] == sorted([(n, d, u) for (u, d), n in sums.items() if n], key=repr)


def test_view_of_a_store_with_late_batches_replays_and_foldings(spark, tmp_path):
    store, batches = Store(spark, str(tmp_path)), [visits(k) for k in range(3)]
    write_batch(store, lines_of(spark, batches[0]), 0)
    write_batch(store, lines_of(spark, batches[1]), 1)
    write_batch(store, lines_of(spark, batches[1]), 1)  # a replay
    same_view(spark, store, batches[0] + batches[1])
    days = [FIRST + dt.timedelta(days=k) for k in range(8)]
    store._fold_first_seen(days, keep_replaced=False)
    same_view(spark, store, batches[0] + batches[1])
    write_batch(store, lines_of(spark, batches[2]), 2)
    same_view(spark, store, sum(batches, []))
    plan = new_and_returning(store.tables(), CLOCK)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) > 1 and all("(day#" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in scans)
    state = store._read(store.first_seen_path, _FIRST_SEEN_SCHEMA)
    assert state.groupBy("subscriber_id").agg(F.sum("change").alias("n")).filter("n <> 1").count() == 0


def test_a_broken_attempt_leaves_no_changes(spark, tmp_path, monkeypatch):
    """The state has moved on between two attempts at one batch, so they write different days."""
    store, first, other = Store(spark, str(tmp_path)), visits(4), visits(5)
    with monkeypatch.context() as patch:
        patch.setattr(Store, "commit", lambda self, batch_id: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write_batch(store, lines_of(spark, first), 0)
    write_batch(store, lines_of(spark, other), 1)
    same_view(spark, store, other)
    write_batch(store, lines_of(spark, first), 0)
    same_view(spark, store, first + other)


def test_a_batch_that_commits_meanwhile_counts_once(spark, tmp_path, monkeypatch):
    store, first, other = Store(spark, str(tmp_path)), visits(6), visits(7)
    own, once = Store._write, iter([True])

    def with_a_batch(self, table, path, *rest):
        if path == self.first_seen_path and next(once, False):
            write_batch(store, lines_of(spark, other), 1)
        return own(self, table, path, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(Store, "_write", with_a_batch)
        write_batch(store, lines_of(spark, first), 0)
    same_view(spark, store, first + other)


def test_stores_without_first_days(spark, tmp_path, monkeypatch):
    """Before the first batch that keeps them the rollup is scanned; rebuilding gives the same state as batches."""
    store, first, other = Store(spark, str(tmp_path)), visits(8), visits(9)
    with monkeypatch.context() as patch:
        patch.setattr(Store, "write_first_seen", lambda self, *rest: None)
        write_batch(store, lines_of(spark, first), 0)
    assert store.tables().newcomers(CLOCK.days_ago(7)) is None
    same_view(spark, store, first)
    write_batch(store, lines_of(spark, other), 1)
    assert store.tables().newcomers(CLOCK.days_ago(7)) is not None
    same_view(spark, store, first + other)
    before = spark_rows(store.newcomers(F.lit(FIRST)))
    store.rebuild_first_seen()
    assert spark_rows(store.newcomers(F.lit(FIRST))) == before
    same_view(spark, store, first + other)
