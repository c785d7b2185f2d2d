"""Live rates straight from the stream, without stored tables.

Unlike the stored rollups, which take late lines for ever, these windows close: lines later than the watermark are
left out of the rate (they still reach the stored tables).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from flowledger.functions.numeric import try_total


SKEW = "5 minutes"
LATENESS = "10 minutes"


def _is_ahead(skew: str) -> Column:
    return F.col("timestamp") > F.col("parsed_at") + F.expr(f"INTERVAL {skew}")


def _windowed(records: DataFrame, width: str, lateness: str, skew: str, *measures: Column) -> DataFrame:
    # a clock ahead of its time would push the watermark there and close all windows for good
    timely = records.filter(~_is_ahead(skew))
    return (
        timely.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", width))
        .agg(*measures)
        .select(F.col("window.start").alias("t"), "*")
        .drop("window")
    )


def live_per_second(records: DataFrame, lateness: str = LATENESS, skew: str = SKEW) -> DataFrame:
    """Sessions and bytes per second. Records dated more than ``skew`` after their arrival are left out."""
    return _windowed(records, "1 second", lateness, skew, F.count(F.lit(1)).alias("sessions"), try_total("bytes_total").alias("bytes"))


def live_per_minute(records: DataFrame, lateness: str = LATENESS, skew: str = SKEW) -> DataFrame:
    """Bytes in and out per minute. Records dated more than ``skew`` after their arrival are left out."""
    return _windowed(records, "1 minute", lateness, skew, try_total("bytes_in").alias("downstream"), try_total("bytes_out").alias("upstream"))


def ahead_of_time(records: DataFrame, skew: str = SKEW) -> DataFrame:
    """Per collector the records the live rates leave out because their clock runs ahead."""
    return records.filter(_is_ahead(skew)).groupBy("collector_id").agg(F.count(F.lit(1)).alias("sessions"), F.max("timestamp").alias("latest"))


def write_rates(rates: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Appends every closed window to Parquet files."""
    trigger = {"availableNow": True} if available_now else {"processingTime": "5 seconds"}
    return (
        rates.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
