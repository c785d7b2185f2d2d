"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

A fingerprint has a bit set where more than half of the shingles' hashes have it. Fingerprints within ``distance`` bits
are linked; linked documents, directly or through others, form one component.

Documents with equal fingerprints become one class first, so copies never meet each other in a join. A class's 64 bits
are cut into blocks: two fingerprints within d bits agree on at least b - d of b blocks, so joining on every choice of
b - d blocks finds every pair. b follows from the number of classes, such that chance meetings stay below one a class;
the result is the same for every b. A key with many fingerprints is cut into tiles, and each pair of tiles is one group
of bounded size; inside a group linked fingerprints are gathered by breadth-first search and only a star of links comes
out, never all pairs. Components then shrink by alternating stars, one written table a round.

Null and empty texts, and texts without words, have fingerprint 0. Fewer words than a shingle count as one shingle.
Repeated rows give repeated results. A component whose documents have no doc_id has a null component_id. Texts are
read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from flowledger.llm.common import fresh_name, staged

SHINGLE_WORDS = 3
DISTANCE = 3
SEED = 42
TILE = 4096  # fingerprints of one key that may meet in one task
MOST_BLOCKS = 12


def simhash(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    words = text.encode().lower().split() if text else []  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    ends = max(len(words) - shingle + 1, 1)
    counts = np.zeros(64, np.int64)
    for first in range(0, ends, 65536):
        last = min(first + 65536, ends)
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED) for i in range(first, last)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > ends, bitorder="little").tobytes(), "little")


def fingerprints(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    """Fingerprint as a signed long."""

    @pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.array([simhash(text, shingle) for text in batch], np.uint64).view(np.int64))

    return fingerprint(text)


def block_masks(blocks: int, distance: int = DISTANCE) -> list[int]:
    """One mask for every choice of blocks - distance of the blocks 64 bits are cut into."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def blocks_for(classes: int, distance: int = DISTANCE) -> int:
    """The fewest blocks with which random fingerprints meet at most once a class on average."""
    for blocks in range(distance + 1, MOST_BLOCKS):
        bits = 64 * (blocks - distance) // blocks
        if classes * comb(blocks, distance) <= 2 << bits:
            return blocks
    return MOST_BLOCKS


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(classes: DataFrame, distance: int = DISTANCE, blocks: int | None = None, tile: int = TILE) -> DataFrame:
    """(a, b) pairs of ``classes.fp`` (distinct longs) whose connected parts are those of all pairs within distance."""
    masks = block_masks(blocks or blocks_for(classes.count(), distance), distance)
    keys = F.array(*[F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for k, m in enumerate(masks)])
    members = classes.select("fp", F.inline(keys))
    shared = members.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    met = (
        members.join(shared, ["choice", "bits"])
        .select("choice", "bits", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"))
        .select("choice", "bits", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")
        .repartition("choice", "bits", "low", "high")
        .sortWithinPartitions("choice", "bits", "low", "high", "fp")
    )

    def stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = np.zeros((5, 0), np.int64)
        for batch in batches:
            rows = np.concatenate([rest, batch.to_numpy(np.int64).T], axis=1)
            starts = _starts(rows)
            whole, rest = rows[:, : starts[-1]], rows[:, starts[-1] :]
            yield _linked(whole, distance)
        yield _linked(rest, distance)

    return met.mapInPandas(stars, "a long, b long").distinct()


def _starts(rows: np.ndarray) -> np.ndarray:
    """First column of every group of equal keys; the last row of ``rows`` holds the fingerprints."""
    return np.flatnonzero(np.r_[True, (rows[:-1, 1:] != rows[:-1, :-1]).any(axis=0)]) if rows.shape[1] else np.zeros(1, np.int64)


def _linked(rows: np.ndarray, distance: int) -> pd.DataFrame:
    fps, found = rows[-1].view(np.uint64) if rows.shape[1] else np.zeros(0, np.uint64), []
    if len(fps):
        starts = _starts(rows)
        sizes = np.diff(np.r_[starts, len(fps)])
        pairs = starts[sizes == 2]
        near = pairs[np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= distance]
        found += [np.stack([fps[near], fps[near + 1]])]
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            found += _group_stars(fps[start : start + size], distance)
    edges = np.concatenate(found, axis=1).view(np.int64) if found else np.zeros((2, 0), np.int64)
    return pd.DataFrame({"a": edges[0], "b": edges[1]})


def _group_stars(fps: np.ndarray, distance: int) -> list[np.ndarray]:
    """Links from the first member of each connected part of the group to its others."""
    found = []
    while len(fps) > 1:
        first, frontier, fps = fps[0], fps[:1], fps[1:]
        while len(frontier) and len(fps):
            near = np.zeros(len(fps), bool)
            for k in range(0, len(frontier), 128):
                near |= (np.bitwise_count(frontier[k : k + 128, None] ^ fps[None, :]) <= distance).any(axis=0)
            frontier, fps = fps[near], fps[~near]
            if len(frontier):
                found.append(np.stack([np.full(len(frontier), first), frontier]))
    return found


def connected(edges: DataFrame) -> DataFrame:
    """(u, v): every vertex that has links, but the smallest of its component, with that smallest one.

    Alternating large and small stars; a round's links are written to the shared folder, so a lost executor costs one
    round at most. Stops when a round changes nothing.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "links")
    before = None
    while (state := _state(now)) != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))))
        before, now = state, staged(small.filter("u != v").distinct(), "links")
    return now


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))), F.bit_xor(mark)).first())


def _rooted(marked: DataFrame, first: Column, distance: int, tile: int) -> DataFrame:
    """fp, root and the least ``first`` of every class of equal fingerprints of ``marked``."""
    classes = staged(marked.groupBy("fp").agg(F.min(first).alias("first")), "classes")
    stars = connected(links(classes.select("fp"), distance, tile=tile))
    return classes.join(stars, classes.fp == stars.u, "left").select("fp", "first", F.coalesce("v", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """doc_id, fp (long) and component_id of every row of ``docs`` (doc_id, text); other columns are left out."""
    marked = staged(docs.select("doc_id", fingerprints(F.col("text"), shingle).alias("fp")), "fingerprints")
    rooted = _rooted(marked, F.col("doc_id"), distance, tile)
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def without_near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """One row of ``docs``, all columns, of every component: the one with the smallest doc_id, rows without one last.

    Rows are numbered in a written table and chosen by number, so a doc_id that is null or repeated decides only which
    row of its own component stays. Among rows of one doc_id the smallest hash of all columns comes first.
    """
    key = fresh_name(docs, "row_key")
    rows = staged(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    rest = F.xxhash64(*[F.col(f"`{name}`").cast("string") for name in docs.columns])
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("doc_id"), rest.alias("rest"), F.col(key).alias("row_key"))
    marked = staged(rows.select(place.alias("place"), fingerprints(F.col("text"), shingle).alias("fp")), "fingerprints")
    firsts = _rooted(marked, F.col("place"), distance, tile).groupBy("root").agg(F.min("first").alias("first"))
    return rows.join(firsts.select(F.col("first.row_key").alias(key)), key, "left_semi").drop(key)


def component_report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hex digits, component_id."""
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return near_duplicates(docs).select("doc_id", digits.alias("fingerprint"), "component_id")
