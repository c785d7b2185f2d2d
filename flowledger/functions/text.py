"""Text extraction: pattern groups, outermost JSON object, priority chains, unsigned numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern`` (NULL without one).

    ``regexp_extract`` signals "no match" by ``''``, which has to be compared and so makes the chain run each
    pattern twice; taking element 0 of all matches runs it once.
    """
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(0))


def outer_object(text: Column) -> Column:
    """Text from the first ``{`` to the last ``}``; NULL when there is none."""
    first = F.instr(text, "{")
    last = F.length(text) - F.length(F.substring_index(text, "}", -1))
    return F.when((first > 0) & (last > first), F.substring(text, first, last - first + 1))


def not_empty(text: Column) -> Column:
    """NULL for ``''``; meant for plain columns, which cost nothing to read twice."""
    return F.when(text != "", text)


def unsigned_or_zero(text: Column, largest: int) -> Column:
    """BIGINT value of a decimal text in ``0..largest``, else 0."""
    number = F.when(F.length(text) > 0, text).try_cast("bigint")
    return F.coalesce(F.when(number.between(0, largest), number), F.lit(0).cast("bigint"))


def counter(text: Column) -> Column:
    """BIGINT value of an unsigned 64-bit counter: NULL where it is valid but beyond 2^63 - 1, 0 where it is no counter.

    Only a text of at least 19 characters can be beyond, so all others are cast once and not looked at again.
    """
    zero = F.lit(0).cast("bigint")
    unsigned = text.rlike(r"^\d{19,20}$") & (text.try_cast("decimal(20,0)") <= F.lit(str(2**64 - 1)).cast("decimal(20,0)"))
    beyond = (F.length(text) >= 19) & text.try_cast("bigint").isNull() & unsigned
    return F.when(beyond, F.lit(None).cast("bigint")).otherwise(F.greatest(F.coalesce(text.try_cast("bigint"), zero), zero))
