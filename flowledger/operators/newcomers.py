"""First days of subscribers, kept up batch by batch as changes that add up.

A change is a row (subscriber_id, day, change): 1 on the day a subscriber was first seen; once a late line shows an
earlier day, -1 on the day that had been taken for the first. So the new subscribers of a day are the sum of its own
changes, whatever other days hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def changes(seen: DataFrame, known: DataFrame) -> DataFrame:
    """The changes that must join those ``known``, after a batch in which ``seen`` (subscriber_id, day) came.

    In the end every subscriber of the batch has a sum of 1 on one day, the first, and 0 on all others, also if two
    batches had added the subscriber side by side. Rows without a subscriber or day are left out. A batch sends one row a
    subscriber, so busy ones weigh no more than others; of ``known`` only the batch's subscribers are looked at.
    """
    firsts = seen.filter("subscriber_id IS NOT NULL").groupBy("subscriber_id").agg(F.min("day").alias("day")).filter("day IS NOT NULL")
    held = known.select("subscriber_id", "day", "change").join(firsts, "subscriber_id", "left_semi")
    rows = held.withColumn("seen", F.lit(False)).unionByName(firsts.withColumns({"change": F.lit(0).cast("bigint"), "seen": F.lit(True)}))
    # dealt by subscriber once, for the sums a day and the look at a subscriber's other days
    sums = rows.repartition("subscriber_id").groupBy("subscriber_id", "day").agg(F.sum("change").alias("held"), F.max("seen").alias("seen"))
    candidate = F.when(F.col("seen") | (F.col("held") > 0), F.col("day"))
    first = F.min(candidate).over(Window.partitionBy("subscriber_id"))
    change = F.when(F.col("day") == F.col("first"), F.lit(1)).otherwise(F.lit(0)) - F.col("held")
    return sums.withColumn("first", first).select("subscriber_id", "day", change.cast("bigint").alias("change")).filter("change <> 0")


def added_up(rows: DataFrame) -> DataFrame:
    """The same state in as few rows as there are: (subscriber_id, day, change)."""
    return rows.groupBy("subscriber_id", "day").agg(F.sum("change").alias("change")).filter("change <> 0")


def per_day(rows: DataFrame) -> DataFrame:
    """(day, new_subscribers)"""
    return rows.groupBy("day").agg(F.sum("change").alias("new_subscribers")).filter("new_subscribers <> 0")
