"""Permutation index against brute force."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowledger.llm import permutation_index as index
from flowledger.llm.queries import QUERIES


def exact(vectors: dict, query: int, k: int = 20):
    scores = [(-float((np.asarray(v, np.float64) * np.asarray(vectors[query], np.float64)).sum()), i) for i, v in vectors.items() if i != query and len(v) == len(vectors[query])]
    return [(i, -s) for s, i in sorted(scores)[:k]]


def found_by_query(frame):
    found = defaultdict(list)
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(found[r.query_id]) + 1
        found[r.query_id].append((r.vec_id, r.score))
    return found


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_op2_recall_and_scores(spark, sf_dir, sf):
    folder = sf_dir.replace("sf0.001", sf)
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    found = found_by_query(QUERIES["op2_permutation_index"](spark, folder))
    assert sorted(found) == sorted(i for i in vectors if i % 20 == 0)
    hits = 0
    for query, rows in found.items():
        best = exact(vectors, query)
        hits += len({i for i, _ in rows} & {i for i, _ in best})
        for i, score in rows:
            assert i != query and score == pytest.approx(float(np.dot(np.float64(vectors[i]), np.float64(vectors[query]))), abs=1e-12)
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0])) and len(rows) == len(best)
    assert hits >= 0.93 * 20 * len(found)


def test_footrule_is_the_definition():
    rng = np.random.default_rng(2)
    orders = np.array([rng.permutation(12)[:5] for _ in range(40)])
    files = index.InvertedFiles(orders, 12)
    for query in (orders[0], np.array([11, 0, 3, 4, 7])):
        plain = [sum(abs(j - (list(row).index(p) if p in row else 5)) for j, p in enumerate(query)) for row in orders.tolist()]
        assert files.footrule(query).tolist() == plain


def test_blocks_ties_and_norms(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(0, 1, 8) * rng.uniform(0.2, 3)]) for i in range(300)]
    rows += [(1000 + i, [1.0] * 8) for i in range(60)]  # one very common vector
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = dict(rows)
    found = found_by_query(index.search(frame, F.col("vec_id") % 20 == 0, candidate_block=64, query_block=5, least=64))
    for query in vectors:
        if query % 20 == 0:
            best = exact(vectors, query)
            assert [i for i, _ in found[query]] == [i for i, _ in best]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [3.0, 4.0]), (20, [2.0, 1.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0]), (40, [1.0, 2.0, 3.0]), (9, [-1.0, 0.5])]
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, rank int, block string")
    found = found_by_query(index.nearest_report(frame))
    assert found == {0: [(7, 5.0), (8, 5.0), (20, 4.0), (9, 0.0)], 20: [(0, 4.0), (7, 4.0), (8, 4.0), (9, -1.5)]}
    assert index.nearest_report(frame.limit(0)).count() == 0


def test_pivots_of_few_different_vectors(spark):
    few = spark.range(4000).select(F.array((F.col("id") % 3 + 1).cast("float"), F.lit(1.0).cast("float")).alias("embedding"))
    assert sorted(index.pivots_of(few, 4).tolist()) == [[1.0, 1.0], [2.0, 1.0], [3.0, 1.0]]
    many = spark.range(4000).select(F.array((F.col("id") + 1).cast("float"), F.lit(1.0).cast("float")).alias("embedding"))
    assert len(np.unique(index.pivots_of(many, 4), axis=0)) == 4
