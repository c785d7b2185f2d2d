"""Which messages of a topic have been delivered, by their positions, so that none counts twice.

Offsets are kept by blocks of 32768 a partition: as a range where a block's offsets have no gap, else as a bitmap. So the
answer is exact whatever was left out of a delivery, in at most one bit for each offset. Lines of one message have one
position and belong together. Lines without a position are never taken for delivered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

POSITION = ("topic", "partition", "offset")
KEYS = ("day", "topic", "partition", "block")
BLOCKS = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("block", T.LongType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("bits", T.BinaryType()),
    ]
)


def has_positions(lines: DataFrame) -> bool:
    return set(POSITION) <= set(lines.columns)


def _placed(lines: DataFrame) -> DataFrame:
    return lines.withColumns({"day": F.to_date("ingest_ts"), "block": F.expr("bitmap_bucket_number(offset)")})


def blocks(lines: DataFrame) -> DataFrame:
    """(day, topic, partition, block, first, last, bits): what ``lines`` (ingest_ts and a position) deliver. The time of a
    message comes with it, so a second delivery has the same day."""
    placed = _placed(lines.select("ingest_ts", *POSITION).dropna())
    grouped = placed.groupBy(*KEYS).agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.expr("bitmap_construct_agg(bitmap_bit_position(offset))").alias("bits")
    )
    whole = F.bitmap_count("bits") == F.col("last") - F.col("first") + 1
    return grouped.withColumn("bits", F.when(~whole, F.col("bits")))


def undelivered(lines: DataFrame, known: DataFrame) -> DataFrame:
    """The lines whose position is in no block of ``known``; at most 32768 messages share a key of the join."""
    columns = [F.col(f"new.{name}") for name in lines.columns]
    new, old = _placed(lines).alias("new"), known.alias("old")
    byte = F.expr("CAST(conv(hex(substring(old.bits, CAST(bitmap_bit_position(new.offset) DIV 8 + 1 AS INT), 1)), 16, 10) AS INT)")
    is_set = F.getbit(byte, F.expr("CAST(bitmap_bit_position(new.offset) % 8 AS INT)")) == 1
    same = [F.col(f"new.{key}") == F.col(f"old.{key}") for key in KEYS]
    inside = F.expr("new.offset BETWEEN old.first AND old.last") & (F.col("old.bits").isNull() | is_set)
    return new.join(old, [*same, inside], "left_anti").select(*columns)
