"""Line dedup against plain code and SQL, and the perfect hash on its own."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from flowledger.llm import line_dedup
from flowledger.llm.queries import QUERIES, SQL
from tests.compare import connect, duck_rows, spark_rows
from tests.llm.conftest import ROWS

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least_chars=40, least_documents=5):
    """(doc_id, n_lines, n_dropped, kept text) of each row."""
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add((doc_id, text))
    rank = lambda doc_id: -(2**70) if doc_id is None else doc_id
    last = {k: max((d for d, _ in held), key=rank) for k, held in holders.items() if len(held) >= least_documents}
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if key(line) not in last or last[key(line)] == doc_id]
        yield doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)


def digested(rows, **settings):
    return sorted(((i, n, dropped, hashlib.sha256(kept.encode()).hexdigest()) for i, n, dropped, kept in plain(rows, **settings)), key=repr)


def report_rows(frame):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_op13_whole_table(spark, sf_dir, sf):
    folder = sf_dir.replace("sf0.001", sf)
    found = QUERIES["op13_line_dedup"](spark, folder)
    assert spark_rows(found) == duck_rows(connect(folder), SQL["op13_line_dedup"])
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert report_rows(found) == digested(rows) and sum(r[2] for r in digested(rows)) > 0


LINE = "A line of more than forty code points, which many share."
JUST = "x" * 39 + "é"
EDGES = [
    (1, f"{LINE}\nown one"), (2, f"  \t{LINE.upper()}\r\nown two\n"), (3, f"{LINE}\n{LINE}\nown three"), (4, f"{LINE}\x0b\n\n"), (5, f"own five\n{LINE.lower()}\nmore\n {LINE}"),
    *[(10 + i, f"{JUST}\n{JUST[:-1]}\n{JUST.upper()}\n {LINE}\n{LINE} ") for i in range(6)],
    (None, f"{LINE}\nnull id"), (None, f"{LINE}\nanother null id"), (5, f"own five\n{LINE.lower()}\nmore\n {LINE}"), (5, LINE),
    *[(None, "only rows without an id hold this line, five of them\n" + str(i)) for i in range(5)], (90, None), (91, ""), (92, "\n"), (93, LINE[:39]),
]


@pytest.mark.parametrize("keys_per_shard, block", [(line_dedup.KEYS_PER_SHARD, line_dedup.PROBES_PER_BLOCK), (2, 3), (1, 1)])
def test_edges_shards_and_blocks(spark, keys_per_shard, block):
    """Small shards and blocks: every line's documents are dealt to many blocks."""
    docs = spark.createDataFrame([(*r, 0, "x", "y") for r in EDGES], "doc_id int, text string, n_lines int, text_key string, lost string")
    found = line_dedup.without_common_lines(docs, keys_per_shard=keys_per_shard, block=block)
    assert found.columns == [*docs.columns, "n_lines_", "n_dropped"]
    got = sorted(((r.doc_id, r.n_lines_, r.n_dropped, r.text or "") for r in found.collect()), key=repr)
    assert got == sorted(plain(EDGES), key=repr)
    assert {r.doc_id for r in found.collect() if r.text is None} == {90}


def test_op13_odd_rows(odd_docs, no_docs):
    assert report_rows(line_dedup.line_report(odd_docs)) == digested([row[:2] for row in ROWS])
    assert line_dedup.line_report(no_docs).collect() == []


def test_a_third_of_all_rows_is_one_document(spark):
    rows = [(7, f"{LINE}\nhot")] * 400 + [(100 + i, f"{LINE}\nno {i}\n{LINE}!") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = line_dedup.line_report(docs)
    assert report_rows(found) == digested(rows)


def test_very_long_texts(spark):
    many = "\n".join(f"line number {i} of a text with very many different lines" for i in range(50_000))
    rows = [(i, many + f"\n{i}") for i in range(5)]
    assert report_rows(line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string"))) == digested(rows)


@pytest.mark.parametrize("size", [0, 1, 2, 7, 1000, 50_000])
def test_hash_is_perfect_and_minimal(size):
    rng = np.random.default_rng(size)
    high, low = (rng.integers(-(2**63), 2**63 - 1, 2 * size) for _ in range(2))
    high[: size // 2] = 5  # equal first halves
    own, other = slice(0, size), slice(size, None)
    hashed = line_dedup.PerfectHash.of(high[own], low[own])
    assert sorted(hashed.slots(high[own], low[own])) == list(range(size)) and len(hashed.bits) <= 4 * size + 64
    n = rng.integers(1, 9, size)
    last = [None if i % 5 == 0 else int(i) for i in range(size)]
    shard = line_dedup.Shard(line_dedup.shard_row(0, high[own], low[own], n, last))
    found, ids, has = shard.look_up(high[own], low[own])
    assert (found == n).all()
    for i in np.flatnonzero(n > 1).tolist():
        assert (int(ids[i]) if has[i] else None) == last[i]
    assert (shard.look_up(high[other], low[other])[0] > 0).sum() <= 2 + size // 1000
