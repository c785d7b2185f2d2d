"""The six tables reports read, computed on the fly or read from a store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from flowledger.functions.timestamps import within
from flowledger.operators.rollups import ROLLUPS, Rollup, build
from flowledger.operators.series import as_series


class Tables:
    """Records and the five rollups as DataFrames.

    All of them are lazy: a report pushes its time filter and its columns through the rollup's grouping, so only the
    rows and measures it needs are computed or read.
    """

    def __init__(
        self, records: DataFrame, rollup_of: Callable[[Rollup], DataFrame], collectors: DataFrame | None = None,
        latest: Callable[[int], DataFrame] | None = None, traffic: Callable[[Column, Column, str], DataFrame] | None = None,
        newcomers: Callable[[Column], DataFrame | None] | None = None, day_sketches: DataFrame | None = None,
    ):
        self.records = records
        self._rollup_of = rollup_of
        self._collectors, self._latest, self._traffic, self._newcomers = collectors, latest, traffic, newcomers
        self.day_sketches = day_sketches  # (day, subscribers) where the store has sketches

    @classmethod
    def from_records(cls, records: DataFrame) -> Tables:
        return cls(records, lambda rollup: build(records, rollup))

    @property
    def collectors(self) -> DataFrame:
        """Distinct ``collector_id``, from the store's own small table where there is one."""
        return self.records.select("collector_id").distinct() if self._collectors is None else self._collectors

    def latest(self, count: int) -> DataFrame:
        """Records among which are the ``count`` newest ones."""
        return self.records if self._latest is None else self._latest(count)

    def traffic(self, start: Column, end: Column, coarsest: str) -> DataFrame:
        """Sessions and bytes of ``start <= time <= end`` in buckets (``t``) no longer than ``coarsest``: from the store's
        own series where there are some, else one row for each record."""
        if self._traffic is None:
            return as_series(within(self.records, "timestamp", start, end))
        return self._traffic(start, end, coarsest)

    def newcomers(self, since: Column) -> DataFrame | None:
        """(day, new_subscribers) from a day on, where the store keeps the first days of subscribers."""
        return None if self._newcomers is None else self._newcomers(since)

    def rollup(self, name: str) -> DataFrame:
        return self._rollup_of(ROLLUPS[name])

    @property
    def daily(self) -> DataFrame:
        return self.rollup("daily_aggregation")

    @property
    def hourly(self) -> DataFrame:
        return self.rollup("hourly_traffic")

    @property
    def destinations(self) -> DataFrame:
        return self.rollup("top_destinations")

    @property
    def applications(self) -> DataFrame:
        return self.rollup("top_applications")

    @property
    def subscribers(self) -> DataFrame:
        return self.rollup("subscriber_bandwidth")

    def register_views(self, prefix: str = "") -> None:
        """Temporary views of all six tables for ad-hoc ``spark.sql`` queries."""
        self.records.createOrReplaceTempView(f"{prefix}records")
        for name in ROLLUPS:
            self.rollup(name).createOrReplaceTempView(f"{prefix}{name}")
