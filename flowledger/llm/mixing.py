"""Mix sources to target weights by hash thresholds, without sorting documents.

Sizes are summed by source and leading bits of a document hash. In each source the running sum over these cells crosses
the budget in one cell; only that cell is summed again by its next bits, until it holds a single hash. The budgets are
nested: a target above the source's size takes every document once and, below the threshold, a second time, so a
larger budget always keeps what a smaller one took. The result depends on the rows alone, not on their partitioning.

A null text has size 0, a null source is a source of its own (the last one). Rows with the same doc_id and text have
the same hash and are taken together. A source without words has target 0. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowledger.llm.common import numbered, staged, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all sizes
REPEATS = 2  # a target's limit, in sizes of its source
HASH_BITS = 63
CELL_BITS = 12


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """source, source_size, target from (source, source_size).

    Weights repeat over the sources in code point order. A source whose share would exceed ``repeats`` times its size is
    held there, and the excess goes to the others by weight until none is above: all others get ``level`` per weight.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights)).cast("int") + 1)
    ranked = staged(numbered(sizes, [F.col("source").asc_nulls_last()]).select("source", "source_size", weight.alias("weight")), "sources")
    most = F.col("source_size") * float(repeats)
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, held = 0.0, None
    while budget:
        full = most < F.col("weight") * level
        count, taken, open_weight = ranked.agg(
            F.count_if(full), F.sum(F.when(full, most).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if count == held or not open_weight:
            break
        held, level = count, (budget - taken) / open_weight
    return ranked.select("source", "source_size", F.least(most, F.col("weight") * level).alias("target"))


def _cell(shift: int) -> Column:
    return F.shiftrightunsigned("h", shift)


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, below: the hash limit under which the sizes of ``rows`` (source, size, h) come nearest to the budget.

    ``budgets`` has (source, budget). A source not listed in the result is below its budget as a whole.
    """
    by_source = Window.partitionBy("source").orderBy("cell")
    shift = HASH_BITS
    edge = budgets.filter("budget > 0").select("source", F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("before"), "budget")
    while shift > 0:
        above, shift = shift, max(shift - CELL_BITS, 0)
        edge = edge.select("source", "at", "before", "budget")
        part = rows.alias("r").join(edge.alias("e"), F.col("r.source").eqNullSafe(F.col("e.source")) & (_cell(above) == F.col("at")))
        cells = part.groupBy("r.source", _cell(shift).alias("cell"), "before", "budget").agg(
            F.sum("size").alias("size"), F.min("h").alias("low"), F.max("h").alias("high")
        )
        until = F.col("before") + F.sum("size").over(by_source)
        edge = staged(
            cells.select("source", F.col("cell").alias("at"), (until - F.col("size")).alias("before"), "budget", "size", "low", "high")
            .filter((F.col("before") <= F.col("budget")) & (F.col("before") + F.col("size") > F.col("budget"))),
            "edges",
        )
        if edge.filter("low != high").isEmpty():
            break
    # the last cell holds one hash: its documents are taken if that comes nearer to the budget
    taken = (F.col("budget") - F.col("before")) * 2 >= F.col("size")
    return edge.select("source", (F.col("low") + taken.cast("long")).alias("below"))


def document_hash() -> Column:
    return F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 64 - HASH_BITS)


def sizes_of(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and hash of every row."""
    return staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), document_hash().alias("h")), "sizes")


def mix_rule(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """One row per source of ``rows`` (source, size, h): source, source_size, target, whole, below.

    A document is taken ``whole`` times, and once more if its hash is under ``below``.
    """
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    planned = staged(targets.select("*", whole.alias("whole")).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    limits = thresholds(rows, planned.select("source", "budget"))
    p, l = planned.alias("p"), limits.alias("l")
    found = p.join(l, F.col("p.source").eqNullSafe(F.col("l.source")), "left")
    return staged(found.select("p.source", "source_size", "target", "whole", F.coalesce("l.below", F.lit(0)).alias("below")), "rule")


def _copies(h: Column) -> Column:
    return F.col("t.whole") + (h < F.col("t.below")).cast("int")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """doc_id, source, size, source_size, target, copies of every row of ``docs`` (doc_id, source, text).

    ``copies`` says how often the mix takes the document (0 to ``repeats``); a source's sizes times copies come within
    half a document of its target.
    """
    rows = sizes_of(docs)
    rule = mix_rule(rows, weights, share, repeats).alias("t")
    return (
        rows.alias("r")
        .join(rule, F.col("r.source").eqNullSafe(F.col("t.source")))
        .select("doc_id", "r.source", "size", "source_size", "target", _copies(F.col("h")).alias("copies"))
    )


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it. Texts meet one rule per source, in a join
    that Spark broadcasts while the rules are small."""
    rule = mix_rule(sizes_of(docs), weights, share, repeats).alias("t")
    hashed = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), "source", document_hash().alias("h")).alias("d")
    joined = hashed.join(rule, F.col("d.source").eqNullSafe(F.col("t.source")))
    return joined.select("row", F.explode(F.array_repeat(F.lit(1), _copies(F.col("d.h"))))).select("row.*")


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, and the words the mix takes of each document, repeats counted."""
    taken = F.col("size") * F.col("copies")
    return mix(docs).select("doc_id", "size", "source_size", "target", taken.alias("taken"))
