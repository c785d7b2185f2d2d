"""Readers of raw log lines: message topics and text files, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowledger.operators.deliveries import POSITION

# Bounds of a micro-batch, so that a backlog comes in many batches; None takes all there is at once.
MAX_OFFSETS = 20_000_000
MAX_FILES = 1000


def split_lines(
    messages: DataFrame, message: str | Column = "value", ingest_ts: str | Column = "timestamp", keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per line of a message payload; the empty piece behind a closing line break is no line.

    ``ingest_ts`` is taken from the message, so reading it again gives the same rows. Columns to ``keep`` stay on each
    line of the message.
    """
    text = F.col(message) if isinstance(message, str) else message
    arrived = F.col(ingest_ts) if isinstance(ingest_ts, str) else ingest_ts
    lines = messages.select(
        F.explode(F.split(text.cast("string"), "\n")).alias("raw_message"), arrived.cast("timestamp").alias("ingest_ts"), *keep
    )
    return lines.filter(F.col("raw_message") != "")


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str | None = None,
    max_offsets: int | None = MAX_OFFSETS,
    min_partitions: int | None = None,
    stream: bool = True,
) -> DataFrame:
    """Raw lines of a Kafka topic with their positions (needs Spark's Kafka connector on the class path).

    ``max_offsets`` bounds a micro-batch; ``min_partitions`` splits busy topic partitions over more tasks.
    """
    reader = (spark.readStream if stream else spark.read).format("kafka")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": max_offsets if stream else None,
        "minPartitions": min_partitions,
    }
    return split_lines(reader.options(**{k: str(v) for k, v in options.items() if v is not None}).load(), keep=POSITION)


def read_files(spark: SparkSession, path: str, stream: bool = False, max_files: int | None = MAX_FILES) -> DataFrame:
    """Raw lines of text files, loaded at the time the file was last written."""
    reader = spark.readStream if stream else spark.read
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.format("text").load(path)
    lines = files.select(
        F.col("value").alias("raw_message"), F.col("_metadata.file_modification_time").alias("ingest_ts")
    )
    return lines.filter(F.col("raw_message") != "")
