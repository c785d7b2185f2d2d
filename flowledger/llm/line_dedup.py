"""Line dedup: lines that many documents share stay in one document only.

A line's key is the line without ASCII white space at both ends and with A-Z lower-cased. Keys of at least ``least_chars``
code points (40) found in at least ``least_documents`` documents (5) lose all their lines, except in the largest doc_id
that holds them. Other lines stay as they are, in order.

A document is a doc_id with a text: repeated rows are one document and get equal results, rows of one doc_id with
different texts are several. A null doc_id is smaller than every other. If several documents have the largest doc_id, all
of them keep the line. A null text counts as empty: one empty line.

How it runs: lines travel as 16-byte hashes of their keys. Each different hash is counted over the documents; shards of
about ``KEYS_PER_SHARD`` hashes each become a minimal perfect hash, whose slots index compact arrays of fingerprints and
counts, and for repeated lines of the last doc_id. Documents do not join lines: their hashes probe the arrays of the
shard they belong to, in blocks of bounded size. A block needs one row of arrays whatever it holds, so the hashes of
a very common line spread over as many blocks as they need.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from flowledger.llm.common import bounded_batches, fresh_name, staged

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
KEYS_PER_SHARD = 1 << 15
PROBES_PER_BLOCK = 1 << 17
BITS_PER_KEY = 2  # bits a level of the hash has for each key that is still without a slot
_CONTINUATION = bytes(range(0x80, 0xC0))  # bytes that begin no code point
_G = np.uint64(0x9E3779B97F4A7C15)


# Lines and keys


def line_keys(text: bytes, least_chars: int = LEAST_CHARS) -> Iterator[tuple[bytes, bytes]]:
    """Each line and its key; the key is empty if it is too short to count."""
    for line in text.split(b"\n"):
        key = line.strip().lower() if len(line) >= least_chars else b""  # of bytes: ASCII white space and letters only
        if len(key) < least_chars or not key.isascii() and len(key.translate(None, _CONTINUATION)) < least_chars:
            key = b""
        yield line, key


def key_hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def document_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, text_key, high, low): the different key hashes of every row of ``docs``; repeated rows repeat."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [], []
            for text in batch.column("text").to_pylist():
                found = {key_hash(key) for _, key in line_keys(text or b"", least_chars) if key}
                sizes.append(len(found))
                digests += found
            hashes = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            rows = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            own = [batch.column(name).take(rows) for name in ("doc_id", "text_key")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(hashes[:, 0].copy()), pa.array(hashes[:, 1].copy())], names=["doc_id", "text_key", "high", "low"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(lines, "doc_id long, text_key long, high long, low long")


# The minimal perfect hash of a shard


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((level + 1) * int(_G) % 2**64)
    return (_mixed(high.view(np.uint64) + _mixed(low.view(np.uint64) + salt)) % np.uint64(size)).astype(np.int64)


def _fingerprints(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (_mixed(low.view(np.uint64) ^ _mixed(high.view(np.uint64) * _G)) >> np.uint64(48)).astype(np.uint16)


class PerfectHash(NamedTuple):
    """Bit vectors of several levels, one behind the other. A key has the slot of the first level in which its bit is
    set: the number of bits set before it. On each level the keys that meet no other key get their bit."""

    sizes: list[int]
    bits: np.ndarray

    @staticmethod
    def of(high: np.ndarray, low: np.ndarray) -> PerfectHash:
        """For different keys."""
        sizes, levels, left = [], [], np.arange(len(high))
        while len(left):
            size = max(BITS_PER_KEY * len(left), 8)
            place = _places(high[left], low[left], len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[place]]
        return PerfectHash(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each key; keys that were not there when the hash was made get any slot, or -1."""
        rank = np.cumsum(self.bits) - 1
        found, left, start = np.full(len(high), -1, np.int64), np.arange(len(high)), 0
        for level, size in enumerate(self.sizes):
            at = start + _places(high[left], low[left], level, size)
            hit = self.bits[at]
            found[left[hit]] = rank[at[hit]]
            left, start = left[~hit], start + size
        return found


SHARD = "shard long, probes long, sizes array<int>, bits binary, fingerprints binary, counts binary, repeated binary, last array<long>"


def shard_row(shard: int, high: np.ndarray, low: np.ndarray, n: np.ndarray, last: list[int | None]) -> dict:
    """The arrays of one shard: per slot a 16-bit fingerprint and how many documents hold the line; for lines of at least
    two documents, in the order of their slots, the largest doc_id."""
    hashed = PerfectHash.of(high, low)
    slots = hashed.slots(high, low)
    fingerprints, counts = np.zeros(len(high), "<u2"), np.zeros(len(high), "<u4")
    fingerprints[slots], counts[slots] = _fingerprints(high, low), np.minimum(n, 2**32 - 1)
    repeated = np.flatnonzero(n > 1)
    repeated = repeated[np.argsort(slots[repeated])]
    return {
        "shard": shard, "probes": int(n.sum()), "sizes": hashed.sizes, "bits": np.packbits(hashed.bits).tobytes(),
        "fingerprints": fingerprints.tobytes(), "counts": counts.tobytes(),
        "repeated": slots[repeated].astype("<u4").tobytes(), "last": [last[i] for i in repeated.tolist()],
    }


class Shard:
    """The arrays of a shard, to look lines up in."""

    def __init__(self, row: dict):
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["sizes"])).astype(bool)
        self.hashed = PerfectHash(list(row["sizes"]), bits)
        self.fingerprints = np.frombuffer(row["fingerprints"], "<u2")
        self.counts = np.frombuffer(row["counts"], "<u4")
        self.repeated = np.frombuffer(row["repeated"], "<u4")
        last = row["last"]
        self.last = np.array([0 if x is None else x for x in last], np.int64)
        self.has_last = np.array([x is not None for x in last], bool)

    def look_up(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many documents hold each line, the largest doc_id of them and whether there is one (for lines of several
        documents). A line of none is taken for another one with a chance of 2^-16."""
        if not len(self.fingerprints):
            none = np.zeros(len(high), np.int64)
            return none, none, none.astype(bool)
        slots = self.hashed.slots(high, low)
        n = np.where((slots >= 0) & (self.fingerprints[slots] == _fingerprints(high, low)), self.counts[slots], 0)
        if not len(self.repeated):
            return n, np.zeros(len(high), np.int64), np.zeros(len(high), bool)
        place = np.minimum(np.searchsorted(self.repeated, slots), len(self.repeated) - 1)
        several = (n > 1) & (self.repeated[place] == slots)
        return n, np.where(several, self.last[place], 0), several & self.has_last[place]


def line_counts(lines: DataFrame) -> DataFrame:
    """(high, low, n, last) for each different line: documents that hold it, and the largest doc_id of them. ``lines``:
    different (doc_id, text_key, high, low), which spread over all tasks before a line's are put together."""
    return lines.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))


def _shard_of(shards: int) -> Column:
    return F.pmod("high", F.lit(shards).cast("long"))


def shard_number(counts: DataFrame, keys_per_shard: int) -> int:
    return max(-(-counts.count() // keys_per_shard), 1)


def shards_of(counts: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """One row of arrays for each shard of the lines counted (staged: ``counts`` is read twice)."""
    shards = shard_number(counts, keys_per_shard)

    def built(table: pa.Table) -> pa.Table:
        high, low, n = (table[name].to_numpy() for name in ("high", "low", "n"))
        row = shard_row(table["shard"][0].as_py(), high, low, n, table["last"].to_pylist())
        return pa.Table.from_pylist([row], ARRAYS)

    return counts.withColumn("shard", _shard_of(shards)).groupBy("shard").applyInArrow(built, SHARD)


ARRAYS = pa.schema(
    [("shard", pa.int64()), ("probes", pa.int64()), ("sizes", pa.list_(pa.int32())), ("bits", pa.binary()), ("fingerprints", pa.binary()), ("counts", pa.binary()), ("repeated", pa.binary()), ("last", pa.list_(pa.int64()))]
)


def common_lines(lines: DataFrame, shards: DataFrame, number: int, least_documents: int = LEAST_DOCUMENTS, block: int = PROBES_PER_BLOCK) -> DataFrame:
    """Those of ``lines`` that their documents lose. ``number``: how many shards the keys were dealt to.

    A shard whose lines need more than one block is named in a small table (at most one row for each ``block`` lines);
    its lines are dealt to its blocks by document.
    """
    shards = shards.withColumn("blocks", F.greatest(F.ceil(F.col("probes") / block), F.lit(1)))
    several = shards.filter("blocks > 1").select("shard", "blocks")
    dealt = lines.withColumn("shard", _shard_of(number)).join(F.broadcast(several), "shard", "left")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_key"), F.coalesce("blocks", F.lit(1)).cast("long"))).drop("blocks")
    arrays = shards.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))

    def probed(own: pa.Table, arrays: pa.Table) -> pa.Table:
        if not own.num_rows or not arrays.num_rows:
            return own.slice(0, 0).select(["doc_id", "text_key", "high", "low"])
        high, low = own["high"].to_numpy(), own["low"].to_numpy()
        n, last, has_last = Shard(arrays.to_pylist()[0]).look_up(high, low)
        ids = own["doc_id"].combine_chunks()
        is_last = np.where(has_last, ids.is_valid().to_numpy(False) & (ids.fill_null(0).to_numpy(False) == last), ids.is_null().to_numpy(False))
        return own.filter(pa.array((n >= least_documents) & ~is_last)).select(["doc_id", "text_key", "high", "low"])

    return dealt.groupBy("shard", "block").cogroup(arrays.groupBy("shard", "block")).applyInArrow(probed, "doc_id long, text_key long, high long, low long")


def index_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, keys_per_shard: int = KEYS_PER_SHARD) -> tuple[DataFrame, DataFrame, int]:
    """The different lines of all documents, the shards' arrays, both written once, and the number of shards."""
    lines = staged(document_lines(docs, least_chars).distinct(), "lines")
    counts = staged(line_counts(lines), "line-counts")
    return lines, staged(shards_of(counts, keys_per_shard), "line-arrays"), shard_number(counts, keys_per_shard)


def _lost(docs: DataFrame, least_chars: int, least_documents: int, keys_per_shard: int, block: int) -> DataFrame:
    """(doc_id, text_key, lost): per document that loses lines the hashes of their keys, 16 bytes each."""
    lines, shards, number = index_lines(docs, least_chars, keys_per_shard)
    found = common_lines(lines, shards, number, least_documents, block)
    hashes = F.transform(F.collect_list(F.struct("high", "low")), lambda h: F.concat(F.unhex(F.lpad(F.hex(h["high"]), 16, "0")), F.unhex(F.lpad(F.hex(h["low"]), 16, "0"))))
    return staged(found.groupBy("doc_id", "text_key").agg(hashes.alias("lost")), "lost-lines")


def _edited(text: bytes | None, lost: list[bytes] | None, least_chars: int) -> tuple[int, int, bytes]:
    gone = set(lost) if lost is not None else ()
    kept, lines = [], 0
    for line, key in line_keys(text or b"", least_chars):
        lines += 1
        if not (gone and key and _big_endian(key_hash(key)) in gone):
            kept.append(line)
    return lines, lines - len(kept), b"\n".join(kept)


def _big_endian(digest: bytes) -> bytes:
    """The two numbers of a hash as Spark's ``hex`` writes them."""
    return digest[7::-1] + digest[:7:-1]


def without_common_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS, keys_per_shard: int = KEYS_PER_SHARD, block: int = PROBES_PER_BLOCK
) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text), with the text each document keeps and, as new columns, ``n_lines``
    (before) and ``n_dropped`` (longer names where these are taken). A null text stays null."""
    rows, names = _cleaned(docs, least_chars, least_documents, keys_per_shard, block, texts=True)
    text = F.when(F.col("text").isNotNull(), F.col(f"{names['cleaned']}.kept").cast("string"))
    counts = [F.col(f"{names['cleaned']}.{name}").alias(fresh_name(docs, name)) for name in ("n_lines", "n_dropped")]
    return rows.select(*[text.alias("text") if name == "text" else F.col(name) for name in docs.columns], *counts)


def _cleaned(docs: DataFrame, least_chars: int, least_documents: int, keys_per_shard: int, block: int, texts: bool) -> tuple[DataFrame, dict[str, str]]:
    """Rows of ``docs`` with a struct of n_lines, n_dropped and the kept text or its digest; the names of new columns."""
    lost = _lost(docs, least_chars, least_documents, keys_per_shard, block)
    names = {name: fresh_name(docs, name) for name in ("text_key", "lost", "cleaned", "lost_id", "lost_key")}

    @pandas_udf(f"n_lines long, n_dropped long, kept {'binary' if texts else 'string'}")
    def cleaned(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_edited(text, hashes, least_chars) for text, hashes in zip(*batch)]
            kept = [row[2] if texts else hashlib.sha256(row[2]).hexdigest() for row in rows]
            yield pd.DataFrame({"n_lines": [r[0] for r in rows], "n_dropped": [r[1] for r in rows], "kept": pd.Series(kept, dtype=object)})

    keyed = bounded_batches(docs).withColumn(names["text_key"], F.xxhash64("text"))
    lost = lost.select(F.col("doc_id").alias(names["lost_id"]), F.col("text_key").alias(names["lost_key"]), F.col("lost").alias(names["lost"]))
    same = (F.col(names["text_key"]) == F.col(names["lost_key"])) & F.col("doc_id").cast("long").eqNullSafe(F.col(names["lost_id"]))
    joined = keyed.join(lost, same, "left")
    return joined.withColumn(names["cleaned"], cleaned(F.col("text").cast("binary"), F.col(names["lost"]))), names


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, number of lines, of dropped lines, and a digest of the text kept, one row per row of ``docs``."""
    rows, names = _cleaned(docs.select("doc_id", "text"), LEAST_CHARS, LEAST_DOCUMENTS, KEYS_PER_SHARD, PROBES_PER_BLOCK, texts=False)
    result = F.col(names["cleaned"])
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), result["n_lines"].alias("n_lines"), result["n_dropped"].alias("n_dropped"), result["kept"].alias("kept_sha256"))


def report_sql() -> str:
    """The report as DuckDB SQL over ``documents``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS row_id, CAST(doc_id AS BIGINT) AS doc_id, text FROM documents),
    split AS (SELECT row_id, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS parts FROM docs),
    lines AS (SELECT row_id, doc_id, text, unnest(parts) AS line, unnest(range(len(parts))) AS place FROM split),
    keyed AS (SELECT *, translate(trim(line, {blanks}), '{upper}', '{upper.lower()}') AS key FROM lines),
    holders AS (SELECT DISTINCT doc_id, text, key FROM keyed WHERE length(key) >= {LEAST_CHARS}),
    common AS (SELECT key, max(doc_id) AS last_id FROM holders GROUP BY key HAVING count(*) >= {LEAST_DOCUMENTS}),
    marked AS (
        SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.last_id AS lost FROM keyed k LEFT JOIN common c ON k.key = c.key
    )
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '')) AS kept_sha256
    FROM marked GROUP BY row_id
    """
