"""Helpers shared by the training-data operators: tables, staged intermediate results, words, flat text arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from flowledger.session import new_folder

# A word is a longest run of anything but ASCII white space (Java and Python read this pattern alike).
WORD = r"[^\x20\x09-\x0D]+"
CHUNK_CHARS = 4_000_000


BATCH_BYTES = 8 << 20


def bounded_batches(frame: DataFrame) -> DataFrame:
    """The same frame in a session that hands Python workers at most about BATCH_BYTES at a time (or one longer row).

    Bounds the memory of tasks on long texts; results do not depend on it. A smaller setting of the session stays.
    """
    conf, key = frame.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    held = conf.get(key)
    if not held.rstrip("b").isdigit() or int(held.rstrip("b")) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return frame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded_batches(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def staged(frame: DataFrame, kind: str) -> DataFrame:
    """The same rows, written once to the shared folder and read back.

    Cuts the lineage: a lost executor repeats at most the step after the last staged table, and what follows sees the
    same rows however often it is evaluated. The folder goes when the driver program ends.
    """
    spark = frame.sparkSession
    folder = new_folder(spark, f"llm-{kind}")
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh_name(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def chunks(texts: Iterable[str | None], limit: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Consecutive lists of whole texts (null: empty) with about ``limit`` characters each; a longer text stands alone."""
    part, size = [], 0
    for text in texts:
        text = "" if text is None else text
        if part and size + len(text) > limit:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def runs_of(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start + 1, … of every run, one run after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)


def numbered(frame: DataFrame, order: list[Column], name: str = "number") -> DataFrame:
    """The rows with their place (from 0) in the given order.

    Rows are dealt to partitions by range and numbered there; each partition then adds the rows before it. The joined
    side has one row per partition, so its size is bounded by the number of shuffle partitions.
    """
    low = (1 << 33) - 1
    placed = staged(frame.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(name, 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("rows_before"))
    return placed.join(F.broadcast(before), part == F.col("part")).withColumn(name, F.col(name).bitwiseAND(low) + F.col("rows_before")).drop("part", "rows_before")
