"""Continuous ingestion: raw lines to records, rollup parts and quarantine, one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from flowledger.operators.parse import parse_lines, quarantine_in, records_in
from flowledger.sources.store import Store


def write_batch(
    store: Store, lines: DataFrame, batch_id: int, status_mode: str = "substring", strip_header: str | None = None,
    min_partitions: int | None = None,
) -> None:
    """Parses one batch once, writes it to all tables and commits it; a batch that is stored already is left alone.

    The parsed batch is made first and kept on the executors while its outputs are written, side by side. Lost blocks are
    recomputed from the source, whose lines and load times do not change. ``min_partitions`` deals the lines over so many tasks, or as
    many as there are cores, for sources that come in a few large pieces. Of lines with a position in a topic (topic, partition, offset) those stay
    out that were delivered before.
    """
    if not store.begin(batch_id):
        return
    lines = store.new_deliveries(lines, batch_id)
    dealt = lines.repartition(max(min_partitions, store.spark.sparkContext.defaultParallelism)) if min_partitions else lines
    parsed = parse_lines(dealt, status_mode, strip_header).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        records, late = store.make_room(records_in(parsed))
        parsed.count()  # outputs that began before it is kept would each parse the lines
        store.write_outputs(records, batch_id)
        if late is not None:
            store.write_late(late, batch_id)
        store.write_quarantine(quarantine_in(parsed), batch_id)
        store.commit(batch_id)
        store.settle()  # for days that were closed while the batch was written
    finally:
        parsed.unpersist()


def ingest(
    store: Store,
    lines: DataFrame,
    checkpoint: str,
    status_mode: str = "substring",
    available_now: bool = False,
    every: str = "30 seconds",
    strip_header: str | None = None,
    min_partitions: int | None = None,
) -> StreamingQuery:
    """Starts the ingestion stream. The checkpoint holds the position in the source.

    Spark numbers batches per checkpoint; the store adds the first number it gave the checkpoint, which for a new
    one lies beyond everything stored (:meth:`Store.first_batch`), so no stream replaces another one's batches.
    Late lines are never dropped: whenever a line arrives, it is added to the day and hour it belongs to.
    """
    first = store.first_batch(checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(store, batch, first + batch_id, status_mode, strip_header, min_partitions)

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
