"""Document fingerprints by order MinHash, sensitive to edit distance.

Every k-mer (k code points) is numbered by how often it occurred before in the text. Each of the lanes orders the
numbered k-mers by its own hash, takes the smallest ones, puts them back into text order and hashes the tuple. Two texts
agree in a lane if they share these k-mers in the same order, so the share of equal lanes falls with the edits between
them, and with moved passages too, where a plain MinHash would not notice.

A text shorter than k is one k-mer. An empty text (null: empty) has no k-mer; its lanes are zero. Equal texts have
equal fingerprints. Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from flowledger.llm.common import code_points

K = 8  # code points of a k-mer
TUPLE = 2  # k-mers of a lane
LANES = 64
BLOCK = 1 << 18  # hashes computed at a time, so that they stay in the processor's cache
LANE_DIGITS = 4  # hex digits kept of a lane's hash

_rng = np.random.default_rng(20260)
MULTIPLY = _rng.integers(1, 1 << 31, LANES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_G = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered_kmers(text: str, k: int = K) -> np.ndarray:
    """A 32-bit hash for each k-mer and its occurrence number, in text order."""
    codes = code_points(text).astype(np.uint64) + np.uint64(1)
    n = max(len(codes) - k + 1, 1 if len(codes) else 0)
    if not n:
        return np.zeros(0, np.uint32)
    hashes = np.zeros(n, np.uint64)
    for i in range(min(k, len(codes))):
        hashes = hashes * _G + codes[i : i + n]
    short = _mixed(hashes) >> np.uint64(32)
    order = np.sort(short << np.uint64(32) | np.arange(n, dtype=np.uint64))  # by k-mer, then by place
    kmer, place = order >> np.uint64(32), (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
    steps = np.arange(n)
    first = np.maximum.accumulate(np.where(np.r_[True, kmer[1:] != kmer[:-1]], steps, 0))
    numbered = np.empty(n, np.uint32)
    numbered[place] = (_mixed(kmer + (steps - first).astype(np.uint64) * _G) >> np.uint64(32)).astype(np.uint32)
    return numbered


def lanes(text: str, k: int = K, size: int = TUPLE) -> np.ndarray:
    """16-bit hash of every lane's tuple."""
    kmers = numbered_kmers(text, k)
    n = len(kmers)
    if not n:
        return np.zeros(LANES, np.uint16)
    chosen = np.zeros((LANES, size), np.int64)
    wanted = min(size, n)
    # a lane's smallest hashes lie below this limit nearly always; where too few do, the lane looks at all of them
    limit = np.uint32((size + 8) / n * 2**32) if n > 64 else np.uint32(2**32 - 1)
    block = max(BLOCK // n, 1)
    for first in range(0, LANES, block):
        factors = MULTIPLY[first : first + block]
        ranks = (factors[:, None] * kmers).ravel()
        low = np.flatnonzero(ranks <= limit)
        lane = low // n
        counts = np.bincount(lane, minlength=len(factors))
        order = np.argsort(lane << 32 | ranks[low], kind="stable")  # equal hashes are told apart by their place
        starts = np.cumsum(counts) - counts
        for k in range(wanted if len(low) else 0):  # without any hash below the limit all lanes are short
            chosen[first : first + block, k] = (low - lane * n)[order[np.minimum(starts + k, len(low) - 1)]]
        for short in np.flatnonzero(counts < wanted):
            chosen[first + short, :wanted] = np.argsort(factors[short] * kmers, kind="stable")[:wanted]
    chosen[:, wanted:] = chosen[:, wanted - 1 : wanted]
    chosen.sort(axis=1)
    hashes = np.zeros(LANES, np.uint64)
    for column in chosen.T:
        hashes = _mixed(hashes * _G + kmers[column] + np.uint64(1))
    return (hashes >> np.uint64(48)).astype(np.uint16)


def digits(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal lanes, 0 to 1."""
    return float(np.count_nonzero(a == b)) / len(a)


def fingerprints(text: Column) -> Column:
    """Fingerprint of each text as hex digits, LANE_DIGITS a lane."""

    @pandas_udf("string")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([digits(lanes(text or "")) for text in batch], dtype=object)

    return fingerprint(text)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row of ``docs`` (doc_id, text); other columns are left out."""
    return docs.select("doc_id", fingerprints(F.col("text")).alias("fingerprint"))


def in_ranges(docs: DataFrame) -> DataFrame:
    """(part, guest, doc_id, text): rows in descending doc_id order, in ranges closed by the row that follows.

    Ranges are cut at approximate quantiles of doc_id, one per shuffle partition, so no task sees all rows; the first
    rows of each range are also sent, as guests, to the range before it, those of the first range to the last. Null
    doc_ids come last; rows with one doc_id are ordered by text. Only ids, at most one per shuffle partition, reach the
    driver.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [(k + 1) / parts for k in range(parts - 1)] or [0.5]
    bounds = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] or []))
    at_most = F.size(F.filter(F.lit(bounds), lambda bound: bound >= F.col("doc_id"))) if bounds else F.lit(0)
    part = F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(at_most)
    firsts = {row.part: row.first_id for row in docs.groupBy(part.alias("part")).agg(F.max("doc_id").alias("first_id")).collect()}
    if not firsts:
        return docs.select(F.lit(0).alias("part"), F.lit(False).alias("guest"), "doc_id", "text")
    used = sorted(firsts)
    before = dict(zip(used, used[-1:] + used[:-1]))
    ids = [firsts[p] for p in used if firsts[p] is not None]
    is_first = F.col("doc_id").isin(ids) | (F.col("doc_id").isNull() if None in firsts.values() else F.lit(False))
    previous = F.element_at(F.lit([before.get(p, 0) for p in range(len(bounds) + 1)]), F.col("part") + 1)
    own = F.struct("part", F.lit(False).alias("guest"))
    places = F.when(F.coalesce(is_first, F.lit(False)), F.array(own, F.struct(previous.alias("part"), F.lit(True).alias("guest")))).otherwise(F.array(own))
    return (
        docs.select("doc_id", "text", part.cast("int").alias("part"))
        .select("doc_id", "text", F.inline(places))
        .repartitionById(parts, F.col("part"))
        .sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), "text")
        .select("part", "guest", "doc_id", "text")
    )


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like it they and the next document are.

    The next document is the one with the next smaller doc_id (after the smallest: the largest). Columns: doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, one row per row of ``docs``.
    """
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the row before, until its next one is seen
        for batch in batches:
            rows = []
            for part, guest, doc_id, text in zip(*[column.to_pylist() for column in batch.columns]):
                text = text or ""
                if guest and (waiting is None or waiting[0] != part):
                    continue  # the range is closed already
                own = lanes(text)
                if waiting is not None:
                    rows.append(_comparison(*waiting[1:], text, own))
                waiting = None if guest else (part, doc_id, text, own)
            yield pa.RecordBatch.from_pylist(rows, RESULT)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return in_ranges(source).mapInArrow(compared, schema)


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _comparison(doc_id: int | None, text: str, own: np.ndarray, following: str, following_lanes: np.ndarray) -> dict:
    changed = edited(text, following)
    changed_lanes = own if changed == text else lanes(changed)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": digits(own),
        "edited_fingerprint": digits(changed_lanes),
        "near_edited": likeness(own, changed_lanes),
        "near_next": likeness(own, following_lanes),
    }
