"""Timestamps written in many ways, time buckets and time predicates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

EPOCH = "1970-01-01 00:00:00"
LAST_SECOND = 4294967295  # largest 32-bit second count

# (accepted shape, rewrite to ISO order); checked only when the text is not ISO already
_REWRITES = (
    (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})(.*)$", "$1-$2-$3$4"),
    (r"^(\d{1,2})[/.\-](\d{1,2})[/.\-](\d{4})(.*)$", "$3-$2-$1$4"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{4})(\d{2})(\d{2})[T ]?(\d{2})(\d{2})(\d{2})(.*)$", "$1-$2-$3 $4:$5:$6$7"),
)
_NAMED_MONTH = (
    "d MMM yyyy HH:mm:ss",
    "d MMM yyyy",
    "MMM d yyyy HH:mm:ss",
    "d MMM yyyy HH:mm:ss z",
)


def best_effort_timestamp(text: Column) -> Column:
    """Timestamp in whole seconds from free-form text; unreadable text gives the epoch.

    Read: ISO dates and times (``T`` or blank, fraction, ``Z`` or offset), year-first and day-first dates with
    ``/ . -``, compact digits, Unix seconds (9-10 digits) or milliseconds (13), and English month names.
    An offset in the text is honoured, else UTC is assumed.
    """
    trimmed = F.trim(text)
    iso = F.when(F.substring(trimmed, 5, 1) == "-", trimmed)
    for shape, order in _REWRITES:
        iso = iso.when(trimmed.rlike(shape), F.regexp_replace(trimmed, shape, order))
    dayless = F.regexp_replace(trimmed, r"^[A-Za-z]+,\s*", "")
    parsed = F.coalesce(
        iso.try_cast("timestamp"),
        F.when(trimmed.rlike(r"^\d{9,10}$"), F.timestamp_seconds(trimmed.try_cast("bigint"))),
        F.when(trimmed.rlike(r"^\d{13}$"), F.timestamp_millis(trimmed.try_cast("bigint"))),
        F.when(
            trimmed.rlike("[A-Za-z]{3}"),
            F.coalesce(*[F.try_to_timestamp(dayless, F.lit(pattern)) for pattern in _NAMED_MONTH]),
        ),
    )
    second = F.unix_seconds(parsed)
    return F.timestamp_seconds(F.coalesce(F.when(second.between(0, LAST_SECOND), second), F.lit(0)))


def literal_timestamp(text: str) -> Column:
    return F.lit(text).cast("timestamp")


@dataclass(frozen=True)
class Clock:
    """The moment a report is asked at, and the range picked for range reports.

    Without values the reports use the current time and the last hour, as an operator's screen would.
    """

    as_of: str | None = None
    start: str | None = None
    end: str | None = None

    @property
    def now(self) -> Column:
        return literal_timestamp(self.as_of) if self.as_of else F.current_timestamp()

    @property
    def today(self) -> Column:
        return F.to_date(self.now)

    @property
    def midnight(self) -> Column:
        return F.date_trunc("day", self.now)

    def ago(self, interval: str) -> Column:
        """``now`` minus an interval such as ``'5 MINUTE'``."""
        return self.now - F.expr(f"INTERVAL {interval}")

    def days_ago(self, days: int) -> Column:
        return F.date_sub(self.today, days)

    @property
    def range_start(self) -> Column:
        return literal_timestamp(self.start) if self.start else self.ago("1 HOUR")

    @property
    def range_end(self) -> Column:
        return literal_timestamp(self.end) if self.end else self.now


def since(table: DataFrame, column: str, moment: Column) -> DataFrame:
    """Rows with ``column >= moment``.

    Stored tables are laid out by ``day``; the implied day bound, which Spark does not derive from the timestamp
    bound, lets the scan skip whole partitions.
    """
    rows = table.filter(F.col(column) >= moment)
    return rows.filter(F.col("day") >= F.to_date(moment)) if "day" in table.columns else rows


def within(table: DataFrame, column: str, start: Column, end: Column) -> DataFrame:
    """Rows with ``start <= column <= end``."""
    rows = since(table, column, start).filter(F.col(column) <= end)
    return rows.filter(F.col("day") <= F.to_date(end)) if "day" in table.columns else rows


def bucket(column: str | Column, unit: str, size: int = 1) -> Column:
    """Start of the tumbling bucket of ``size`` units that holds the timestamp."""
    if size == 1:
        return F.date_trunc(unit, column)
    return F.window(column, f"{size} {unit}").getField("start")


def hour_text(column: str | Column) -> Column:
    """Hour of day as text without padding; sorts as text, so '10' comes before '2'."""
    return F.hour(column).cast("string")
