"""Whitening against dense linear algebra and exact integers."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest

from flowledger.llm import whitening
from flowledger.llm.queries import QUERIES


def fitted(rows):
    """vec_id → x of the rows that take part, and the different vectors."""
    x = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    return x, sorted({v for _, v in x})


def check(found, rows, wanted=4):
    x, fit = fitted(rows)
    by_component = defaultdict(list)
    for row in found:
        by_component[row.component].append(row)
    n, matrix = len(fit), np.array(fit, np.float64)
    sums = [sum(column) for column in zip(*fit)]
    centred = matrix - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert sorted(by_component) == list(range(1, min(wanted, matrix.shape[1]) + 1))
    whitened = {}
    for c, part in by_component.items():
        assert sorted(r.vec_id for r in part) == sorted(i for i, _ in x)
        by_id = dict(x)
        z = np.array([(np.array(by_id[r.vec_id]) - np.array(sums) / n) @ vectors[:, c - 1] / np.sqrt(values[c - 1]) for r in part])
        got = np.array([r.whitened for r in part])
        assert np.abs(got * np.sign(got @ z) - z).max() < 1e-9
        for r in part[:50]:
            assert r.n == n and r.deviation == sum((n * v - s) ** 2 for v, s in zip(by_id[r.vec_id], sums))
            assert r.explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-9) and r.identity_error < 1e-9
        whitened[c] = {by_id[r.vec_id]: r.whitened for r in part}
    z = np.array([[whitened[c][v] for c in sorted(whitened)] for v in fit])
    assert np.abs(np.cov(z.T, bias=True) - np.eye(z.shape[1])).max() < 1e-9


def test_op12_whole_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(QUERIES["op12_embedding_whitening"](spark, sf_dir).collect(), rows)


def test_copies_count_once_and_odd_rows_stay_out(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(0, [4, 2, 1, 0.5, 0.2, 0.1], 6)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # a common vector
    rows += [(7, rows[7][1]), (None, rows[3][1])]
    odd = [(2000, None), (2001, [float("nan")] * 6), (2002, [1.0, 2.0, None, 1.0, 1.0, 1.0]), (2003, [float("inf")] * 6), (2004, [])]
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows + odd], "vec_id long, embedding array<double>, n int, component string")
    found = whitening.whiten(frame).collect()
    assert len(found) == 4 * len(rows)
    own = [(i, v) for i, v in rows if i is not None]
    assert sum(r.vec_id == 7 for r in found) == 8 and sum(r.vec_id is None for r in found) == 4
    check([r for r in found if r.vec_id is not None], own)


def test_lengths_apart_and_few_dimensions(spark):
    rng = np.random.default_rng(4)
    two = [(i, [float(c) for c in rng.normal(0, 1, 2)]) for i in range(50)]
    three = [(100 + i, [float(c) for c in rng.normal(0, 1, 3)]) for i in range(60)]
    found = whitening.whiten(spark.createDataFrame(two + three, "vec_id long, embedding array<float>")).collect()
    single = [(i, [float(np.float32(c)) for c in v]) for i, v in two]
    check([r for r in found if r.vec_id < 100], single)
    check([r for r in found if r.vec_id >= 100], [(i, [float(np.float32(c)) for c in v]) for i, v in three])


def test_no_variance_no_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).count() == 0 and whitening.whiten(same.limit(0)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(6)], "vec_id long, embedding array<float>")
    assert {r.component for r in whitening.whiten(line).collect()} == {1}


def test_large_numbers_are_exact(spark):
    rows = [(1, [3.0e15, 1.0]), (2, [-2.0e15, 1.5]), (3, [1.0, 7.0]), (4, [1e300, 0.0])]
    packed = {r.vec_id: whitening._unpacked(bytes(r.x), 2).tolist() for r in whitening.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert packed == {1: [768 * 10**15, 256], 2: [-512 * 10**15, 384], 3: [256, 1792], 4: [2**63 - 1, 0]}
    found = whitening.whiten(spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in found} == {None}  # beyond 63 bits
    x = np.array([[5, 1], [9, -4]])
    assert whitening._deviations(x, whitening.Moments(10**8, [3, 4])) == [(5 * 10**8 - 3) ** 2 + (10**8 - 4) ** 2, (9 * 10**8 - 3) ** 2 + (4 * 10**8 + 4) ** 2]


@pytest.mark.parametrize("spectrum", ["flat", "steep", "close", "twins"])
def test_filter_finds_the_leading_components(spectrum):
    rng = np.random.default_rng(8)
    values = {"flat": np.linspace(1, 0.8, 90), "steep": 10.0 ** -np.linspace(0, 12, 90), "close": np.r_[1, 1 - 1e-5, 0.9, 0.9 - 1e-6, np.linspace(0.5, 0.1, 86)], "twins": np.r_[2, 2, 1, 1, np.linspace(0.9, 0.1, 86)]}[spectrum]
    turn = np.linalg.qr(rng.standard_normal((90, 90)))[0]
    matrix = turn * values @ turn.T
    found = whitening.leading_components(lambda columns: matrix @ columns, 90)
    assert found.values == pytest.approx(values[:4], rel=1e-11) and found.residual < 1e-12
    assert np.abs(found.vectors.T @ found.vectors - np.eye(4)).max() < 1e-13
    if spectrum != "twins":
        assert np.abs(np.abs((found.vectors * turn[:, :4]).sum(axis=0)) - 1).max() < 1e-9


def test_blocks_hold_all_vectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 64)
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(0, 1000 if i % 3 else 1, 5)]) for i in range(100)]
    check(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), rows)
