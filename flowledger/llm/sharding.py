"""Shards of near-equal bytes: minimax contiguous partition of ordered atomic groups.

Groups (equal texts) are ordered by a hash of the text and never split over shards. The smallest capacity at which a
greedy pass fills no more than the wanted number of shards is found by binary search, and the sequence is cut there.

The driver never holds the groups. It works on cells, ranges of the hash with their total size; a greedy pass that may
cut anywhere inside a cell gives a lower bound of the capacity, one that cuts at cell borders only an upper bound. While
they differ, just the cells in which a cut can fall are summed again at finer resolution. When they meet, the capacity
is exactly the one a pass over all single groups would find. The greedy pass itself would leave what is missing to the
last shard; the cuts are made inside the same capacity, each as near to an even share as it allows. Every shard is one
stretch of the group order. A group above the fair share stays in its place there: as a rule it is a shard alone, and
the stretches before and behind it get as many shards each as their sizes come to.

A null text has no bytes, CRC 0, and is a group of its own. Repeated rows are rows of one group. Fewer groups than
shards leave shards empty. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowledger.llm.common import staged

SHARDS = 40
ROW_BYTES = 16  # counted for every row besides its text
KEY_BITS = 63
FIRST_BITS = 14  # cells of the first pass: 2 ** 14
MORE_BITS = 6  # a refined cell becomes 2 ** 6
CELLS_A_ROUND = 2048
PARTS_OF_A_SHARE = 64  # cells of several groups are refined until they are smaller than this part of a fair share
ROWS_A_BIN = 10_000


@dataclass
class Cells:
    """Ranges of the group order, in order: first key, number of key bits left open, bytes, whether one group only."""

    start: np.ndarray
    shift: np.ndarray
    size: np.ndarray
    single: np.ndarray

    def __post_init__(self):
        self.ends = np.cumsum(self.size)
        self.begins = self.ends - self.size

    @classmethod
    def of(cls, frame: pd.DataFrame) -> Cells:
        frame = frame.sort_values("start")
        return cls(*(frame[name].to_numpy(kind) for name, kind in zip(("start", "shift", "size", "single"), (np.int64, np.int64, np.int64, bool))))

    def cuts(self, capacity: int, shards: int, loose: bool) -> tuple[bool, list[int]]:
        """Whether ``shards`` shards of this capacity can hold all, and the positions (bytes) where they end.

        loose: a cut may fall anywhere inside a cell of several groups; else at borders of cells only.
        """
        total, at, found = int(self.ends[-1]) if len(self.ends) else 0, 0, []
        while at < total and len(found) < shards:
            goal = at + capacity
            k = int(np.searchsorted(self.ends, goal, "right"))  # the first cell that does not fit as a whole
            reached = goal if loose and k < len(self.ends) and not self.single[k] else int(self.begins[k]) if k < len(self.ends) else total
            if reached <= at:
                return False, found
            at = reached
            found.append(at)
        return at >= total, found

    def heavy(self, shards: int) -> np.ndarray:
        """Single groups above the fair share of what is left, taken from the largest on."""
        found, left = np.zeros(len(self.size), bool), int(self.size.sum())
        for taken, k in enumerate(np.argsort(-self.size, kind="stable")[: shards - 1].tolist()):
            if not self.single[k] or int(self.size[k]) * (shards - taken) <= left:
                break
            found[k] = True
            left -= int(self.size[k])
        return found

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Positions where the shards but the last end: cell borders with no shard above the capacity.

        A heavy group's shard ends with it. The cells up to the next heavy one are dealt evenly over as many shards as
        their share of the light ones comes to; each cut is as near to that as the capacity of the shards behind allows.
        """
        borders, total, heavy = np.r_[0, self.ends], int(self.ends[-1]), self.heavy(shards)
        light = np.r_[0, np.cumsum(np.where(heavy, 0, self.size))]
        earliest = [total]
        for _ in range(shards - 1):
            earliest.append(int(borders[np.searchsorted(borders, max(earliest[-1] - capacity, 0))]))
        found, at = [], 0
        for left in range(shards - 1, 0, -1):
            here = int(np.searchsorted(borders, at))
            if at == total:
                break
            if heavy[here]:
                ideal = borders[here + 1]
            else:
                share = (light[-1] - light[here]) / max(left + 1 - int(heavy[here:].sum()), 1)
                ahead = np.flatnonzero(heavy[here:])
                stretch = int(borders[here + ahead[0]] if len(ahead) else total) - at
                ideal = at + stretch / max(round(stretch / share), 1)
            first = max(int(np.searchsorted(borders, max(earliest[left], at))), here + 1)
            last = int(np.searchsorted(borders, at + capacity, "right")) - 1
            k = int(np.searchsorted(borders, ideal))
            if k > 0 and (k == len(borders) or ideal - borders[k - 1] <= borders[k] - ideal):
                k -= 1
            at = int(borders[min(max(k, first), last)])
            found.append(at)
        return found

    def least(self, shards: int, loose: bool) -> int:
        """Smallest capacity that suffices, by binary search."""
        total = int(self.ends[-1])
        low, high = max(-(-total // shards), int(self.size[self.single].max(initial=1))) - 1, total
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (low, middle) if self.cuts(middle, shards, loose)[0] else (middle, high)
        return high


def _summed(groups: DataFrame, shift: int) -> pd.DataFrame:
    start = F.shiftleft(F.shiftright("key", shift), shift)
    return (
        groups.groupBy(start.alias("start"))
        .agg(F.sum("bytes").alias("size"), (F.count(F.lit(1)) == 1).alias("single"))
        .select("start", F.lit(shift).alias("shift"), "size", "single")
        .toPandas()
    )


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Smallest feasible capacity and the first key of every shard but the first, for ``groups`` (key, bytes).

    At most 2 ** FIRST_BITS sums, and CELLS_A_ROUND * 2 ** MORE_BITS a round, come to the driver.
    """
    frame = _summed(groups, KEY_BITS - FIRST_BITS)
    if frame.empty or shards < 2:
        return int(frame["size"].sum()), []
    while True:
        cells = Cells.of(frame)
        low, high = cells.least(shards, loose=True), cells.least(shards, loose=False)
        coarse = ~cells.single & (cells.size * shards * PARTS_OF_A_SHARE > cells.ends[-1])
        if low == high and not coarse.any():
            ends = [end for end in cells.even_cuts(high, shards) if end < cells.ends[-1]]
            return high, [int(cells.start[np.searchsorted(cells.begins, end)]) for end in ends]
        firsts, lasts = cells.cuts(low, shards, loose=False)[1], cells.cuts(high, shards, loose=True)[1]
        open_ = np.zeros(len(cells.start), bool)
        for first, last in zip(firsts + [firsts[-1] if firsts else 0] * (len(lasts) - len(firsts)), lasts):
            open_ |= (cells.begins <= last) & (cells.ends >= first)
        chosen = np.flatnonzero((coarse if low == high else open_) & ~cells.single)[:CELLS_A_ROUND]
        if not len(chosen):  # cells that cannot be told apart by a cut: take the widest ones next
            chosen = np.flatnonzero(~cells.single)[:CELLS_A_ROUND]
        picked = frame.sort_values("start").iloc[chosen]
        finer = [
            _summed(groups.filter(F.shiftleft(F.shiftright("key", shift), shift).isin(part["start"].tolist())), max(shift - MORE_BITS, 0))
            for shift, part in ((int(shift), part) for shift, part in picked.groupby("shift"))
        ]
        frame = pd.concat([frame.sort_values("start").drop(frame.sort_values("start").index[chosen]), *finer], ignore_index=True)


def shard_rule(groups: DataFrame, shards: int) -> Column:
    """The shard of column ``key``."""
    _, cuts = minimax_cuts(groups, shards)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("key") >= cut).cast("int")
    return shard.cast("int")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs`` (doc_id, text); other columns are left out.

    Slots count from 0 without gaps. Rows of a shard are numbered in bins of bounded size, each behind the rows of the
    bins before it, so one large shard does not meet in one task.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES
    rows = staged(
        docs.select("doc_id", size.alias("size"), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"), F.shiftrightunsigned(F.xxhash64("text"), 64 - KEY_BITS).alias("key")),
        "sizes",
    )
    groups = staged(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    placed = rows.withColumn("shard", shard_rule(groups, shards))
    most = placed.groupBy("shard").count().agg(F.max("count")).first()[0] or 1
    binned = placed.withColumn("bin", F.pmod(F.xxhash64("doc_id", "key"), F.lit(-(-most // ROWS_A_BIN))))
    before = Window.partitionBy("shard").orderBy("bin")
    offsets = binned.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n")).select("shard", "bin", (F.sum("n").over(before) - F.col("n")).alias("rows_before"))
    within = Window.partitionBy("shard", "bin").orderBy("doc_id", "key", "size")
    slot = F.row_number().over(within) - 1 + F.col("rows_before")
    return binned.join(offsets, ["shard", "bin"]).select("doc_id", "size", "text_crc32", "shard", slot.cast("long").alias("slot"))


def shard_report(docs: DataFrame) -> DataFrame:
    """The shards of all documents under the law of near-equal bytes."""
    return shard_documents(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
