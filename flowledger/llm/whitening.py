"""Whitening of embeddings onto their leading components, by Chebyshev-filtered subspace iteration.

Vectors that are null or hold a null or non-finite entry are left out. Each entry c becomes the integer x = floor(256 c)
(as Spark casts it: beyond 64 bits the nearest 64-bit integer). The fit list holds each different x vector once; means
and covariance are over it. Vectors of each length are a table of their own; empty vectors give no rows.

The covariance V is never formed. A pass over the fit list, in blocks of rows, adds up XcᵀXcQ for the centred vectors Xc
and a few columns Q. A round applies a Chebyshev polynomial of V to the columns, by its three-term recurrence, one pass a
degree: it stays small on the unwanted part of the spectrum, between zero and the smallest Ritz value kept, and grows fast
above. Then the columns are made orthonormal (QR), and Rayleigh-Ritz gives the best eigenvectors within them. Rounds end
when the residuals of the wanted pairs, measured in a pass, are certified small and do not get smaller any more.

Components are numbered by falling eigenvalue; their sign makes the largest entry positive. Components without variance
(eigenvalue zero up to rounding) cannot be scaled to one and are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowledger.llm.common import staged

SCALE = 256
COMPONENTS = 4
GUARD = 16  # columns beyond the wanted ones; the filter has to part the last wanted value from those behind the guard
DEGREE = 8  # of the polynomial of a round
BLOCK_BYTES = 4 << 20  # of a block of vectors
TOLERANCE = 1e-12  # residual of a certified pair, as a share of the largest eigenvalue
ROUNDS = 500


# Integer vectors


def _packed(values: np.ndarray) -> bytes:
    """The integers in the smallest type that holds them all, so that equal vectors have equal bytes."""
    for kind in (np.int16, np.int32):
        if len(values) and np.iinfo(kind).min <= values.min() and values.max() <= np.iinfo(kind).max:
            return values.astype(kind).tobytes()
    return values.tobytes()


def _unpacked(data: bytes, length: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // length}").astype(np.int64)


def integer_vectors(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, length, x) of every row that takes part; x: the integer vector as bytes."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            values = lists.flatten()
            numbers = values.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
            sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            ends = np.cumsum(sizes)
            wrong = np.r_[0, np.cumsum(~np.isfinite(numbers))]
            rows = np.flatnonzero((sizes > 0) & (wrong[ends] == wrong[ends - sizes]))
            with np.errstate(over="ignore", invalid="ignore"):
                scaled = np.floor(scale * numbers)
                whole = np.clip(scaled, -(2.0**63), 2.0**62 * 1.9999999999999998)
                x = np.where(np.isfinite(numbers), whole, 0).astype(np.int64)
            x[(scaled >= 2.0**63) & np.isfinite(numbers)] = 2**63 - 1
            data = [_packed(x[ends[i] - sizes[i] : ends[i]]) for i in rows.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(sizes[rows], pa.int32()), pa.array(data, pa.binary())], names=["vec_id", "length", "x"]
            )

    source = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"))
    return source.mapInArrow(packed, "vec_id long, length int, x binary")


def fit_blocks(packed: DataFrame, length: int) -> DataFrame:
    """The different vectors of one length in blocks of bounded size: (rows, x), written once."""

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(BLOCK_BYTES // (8 * length), 1)
        for batch in batches:
            column = batch.column(0).to_pylist()
            parts = [column[i : i + most] for i in range(0, len(column), most)]
            matrices = [_packed(np.concatenate([_unpacked(data, length) for data in part])) for part in parts]
            yield pa.RecordBatch.from_arrays([pa.array([len(part) for part in parts], pa.int64()), pa.array(matrices, pa.binary())], names=["rows", "x"])

    different = packed.filter(F.col("length") == length).select("x").distinct()
    return staged(different.mapInArrow(blocked, "rows long, x binary"), "vectors")


def _matrices(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for rows, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield _unpacked(data, rows * length).reshape(rows, length)


# Passes over the fit list


class Moments(NamedTuple):
    """Number of different vectors and the exact sum of each dimension."""

    n: int
    sums: list[int]

    @property
    def mean(self) -> np.ndarray:
        """Correctly rounded quotients."""
        return np.array([s / self.n for s in self.sums])


def moments(blocks: DataFrame, length: int) -> Moments:
    """Sums are exact: the upper and lower halves of the integers are added up apart."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(length, np.int64), np.zeros(length, np.int64)
        for x in _matrices(batches, length):
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length), pa.int32()), pa.array(np.full(length, n)), pa.array(high), pa.array(low)], names=["i", "n", "high", "low"])

    total = blocks.mapInArrow(summed, "i int, n long, high long, low long").groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    rows = sorted(total.collect())
    return Moments(rows[0].n, [(int(row.high) << 32) + int(row.low) for row in rows])


def _product_rows(blocks: DataFrame, length: int, height: int, width: int, product) -> np.ndarray:
    """The sum of ``product(x)``, a small matrix, over all blocks: added up in every task, then by row of the matrix."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, width))
        for x in _matrices(batches, length):
            total += product(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(height), pa.int32()), *[pa.array(column) for column in total.T.copy()]], names=["i", *[f"c{k}" for k in range(width)]])

    rows = blocks.mapInArrow(partial, "i int, " + ", ".join(f"c{k} double" for k in range(width)))
    summed = rows.groupBy("i").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(width)])
    return np.array([row[1:] for row in sorted(summed.collect())]).reshape(height, width)


def covariance_times(blocks: DataFrame, found: Moments, columns: np.ndarray) -> np.ndarray:
    """V times the columns, in one pass. At most length × columns numbers go to the driver."""
    mean = found.mean

    def product(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return centred.T @ (centred @ columns)

    return _product_rows(blocks, len(mean), *columns.shape, product) / found.n


def total_variance(blocks: DataFrame, found: Moments) -> float:
    """The trace of the covariance."""
    mean = found.mean
    return float(_product_rows(blocks, len(mean), len(mean), 1, lambda x: ((x - mean) ** 2).sum(axis=0)[:, None]).sum() / found.n)


# Chebyshev-filtered subspace iteration


class Components(NamedTuple):
    values: np.ndarray
    vectors: np.ndarray  # one component a column
    residual: float  # largest residual norm, as a share of the largest eigenvalue
    rounds: int
    passes: int


def _filtered(apply, columns: np.ndarray, image: np.ndarray, cut: float) -> np.ndarray:
    """T_m((2V - cut) / cut) times the columns, whose image under V is known. The recurrence is scaled by its value at the
    largest Ritz value, so that nothing overflows."""
    half = cut / 2
    top = np.linalg.norm(image, axis=0).max()
    sigma = first = half / max(top - half, half)
    before, now = columns, (image - half * columns) * (sigma / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, 2 * (following / half) * (apply(now) - half * now) - sigma * following * before
        sigma = following
    return now


def leading_components(apply, length: int, wanted: int = COMPONENTS, guard: int = GUARD, tolerance: float = TOLERANCE, seed: int = 5) -> Components:
    """The largest eigenvalues and unit eigenvectors of a symmetric positive matrix given by its products, ``apply``."""
    wanted, width = min(wanted, length), min(wanted + guard, length)
    passes = 0

    def counted(columns: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return apply(columns)

    columns = np.linalg.qr(np.random.default_rng(seed).standard_normal((length, width)))[0]
    image, best, worse = counted(columns), None, 0
    for rounds in range(1, ROUNDS + 1):
        small = columns.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        columns, image = columns @ turn, image @ turn
        if values[0] <= 0:
            return Components(np.zeros(0), np.zeros((length, 0)), 0.0, rounds, passes)
        residual = float(np.linalg.norm(image - columns * values, axis=0)[:wanted].max() / values[0])
        if best is None or residual < best.residual / 2:
            best, worse = Components(values[:wanted], columns[:, :wanted], residual, rounds, passes), 0
        else:
            worse += 1
        if best.residual <= tolerance and (worse or width == length):
            return best._replace(rounds=rounds, passes=passes)
        cut = max(values[-1], values[0] * 1e-14)
        filtered = image if width == length else _filtered(counted, columns, image, cut)
        columns = np.linalg.qr(filtered / np.maximum(np.linalg.norm(filtered, axis=0), 1e-300))[0] if width < length else columns
        image = counted(columns)
    raise ArithmeticError(f"no certified components after {ROUNDS} rounds: residual {best.residual}")


# Whitened rows


class Fit(NamedTuple):
    found: Moments
    components: Components
    explained: np.ndarray
    identity_error: float


def fit(blocks: DataFrame, length: int, wanted: int = COMPONENTS) -> Fit:
    """Moments, components, shares of the variance, and how far the whitened fit list's covariance is from the identity."""
    found = moments(blocks, length)
    result = leading_components(lambda columns: covariance_times(blocks, found, columns), length, wanted)
    trace = total_variance(blocks, found)
    keep = result.values > max(trace, 0.0) * length * np.finfo(float).eps
    values, vectors = result.values[keep], result.vectors[:, keep]
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], 0)[0] < 0, -1.0, 1.0) if keep.any() else vectors
    result = result._replace(values=values, vectors=vectors)
    return Fit(found, result, values / trace if len(values) else values, _identity_error(blocks, found, result))


def _whitened(x: np.ndarray, mean: np.ndarray, components: Components) -> np.ndarray:
    return ((x - mean) @ components.vectors) / np.sqrt(components.values)


def _identity_error(blocks: DataFrame, found: Moments, components: Components) -> float:
    width, mean = len(components.values), found.mean
    if not width:
        return 0.0

    def product(x: np.ndarray) -> np.ndarray:
        z = _whitened(x, mean, components)
        return np.vstack([z.T @ z, z.sum(axis=0)])

    total = _product_rows(blocks, len(mean), width + 1, width, product) / found.n
    centre = total[width]
    return float(np.abs(total[:width] - np.outer(centre, centre) - np.eye(width)).max())


def _deviations(x: np.ndarray, found: Moments) -> list[int | None]:
    """Σ (n x - S)² exactly; null beyond 63 bits."""
    largest = found.n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, found.sums)) if x.size else 0
    if largest * largest * x.shape[1] < 2**63:
        return ((found.n * x - np.array(found.sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((found.n * v - s) ** 2 for v, s in zip(row, found.sums)) for row in x.tolist()]
    return [value if value < 2**63 else None for value in exact]


ROWS = pa.schema(
    [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())]
)
ROWS_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, wanted: int = COMPONENTS, id_column: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """One row for each row of ``vectors`` that takes part and each component: vec_id, component, n, deviation, whitened,
    explained, identity_error. Repeated rows repeat. The lengths that occur are collected, one fit a length."""
    packed = staged(integer_vectors(vectors, id_column, vector, scale), "integers")
    lengths = sorted(row.length for row in packed.select("length").distinct().collect())
    fits = {length: fit(fit_blocks(packed, length), length, wanted) for length in lengths}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(1).to_numpy()
            for length in np.unique(size).tolist():
                of_length = fits[length]
                width, at = len(of_length.components.values), np.flatnonzero(size == length)
                for part in np.array_split(at, max(len(at) * length // (1 << 20), 1)):
                    if not width or not len(part):
                        continue
                    x = np.stack([_unpacked(data.as_py(), length) for data in batch.column(2).take(pa.array(part))])
                    z = _whitened(x, of_length.found.mean, of_length.components)
                    repeated = np.repeat(part, width)
                    count = len(repeated)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(repeated)),
                            pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(part))),
                            pa.array(np.full(count, of_length.found.n)),
                            pa.array([d for d in _deviations(x, of_length.found) for _ in range(width)], pa.int64()),
                            pa.array(z.ravel()),
                            pa.array(np.tile(of_length.explained, len(part))),
                            pa.array(np.full(count, of_length.identity_error)),
                        ],
                        schema=ROWS,
                    )

    return packed.mapInArrow(rows, ROWS_SCHEMA)
