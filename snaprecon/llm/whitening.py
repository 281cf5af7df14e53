"""Embedding whitening by FEAST: contour integration over eigenvalue intervals of the covariance.

The table is read for its distinct integer vectors, which are written once;
their sums, their centred products and the check of the result are three
passes over them, each a small matrix a task, added up by Spark. What reaches
the driver is one matrix of dimension squared, whatever the number of rows.
Its leading components are found there: inertia counts (the negative pivots of
the shifted tridiagonal form) cut the spectrum into intervals that hold a few
eigenvalues each; on each, a quadrature of complex shifted solves projects a
random block onto the interval's subspace, Rayleigh-Ritz extracts the pairs,
and the interval is done only when it has as many as the inertia says.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal, localcontext

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import snaprecon.llm._common  # noqa: F401 - task functions travel by value
from snaprecon.session import fresh_path

NODES = 8  # quadrature points on the upper half circle
PER_INTERVAL = 6
ROUNDS = 60
SMALLEST = 1e-13  # of the largest eigenvalue: what is below is not a component
_EXACT = 2.0**53
_BATCH = 2048


# ---- the eigenproblem


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a symmetric matrix's Householder form, which has the same spectrum."""
    a = np.array(matrix, float)
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v[0] += np.copysign(size, v[0])
        v /= np.linalg.norm(v)
        a[k + 1 :] -= 2 * np.outer(v, v @ a[k + 1 :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def above(form: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """Inertia: how many eigenvalues are greater than ``shift`` (the positive pivots of the shifted form)."""
    diagonal, off = form
    tiny = np.finfo(float).eps * max(np.abs(diagonal).max(initial=0), np.abs(off).max(initial=0), 1e-300)
    count, pivot = 0, 1.0
    for k, d in enumerate(diagonal):
        pivot = d - shift - (off[k - 1] ** 2 / pivot if k else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot > 0
    return count


def intervals(form: tuple[np.ndarray, np.ndarray], low: float, high: float, wanted: int, size: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, count) from the top down until ``wanted`` eigenvalues are inside, halved until each holds at most ``size``.

    A run of eigenvalues that no halving parts (equal to working precision) stays one interval.
    """
    todo, found, held = [(low, high, above(form, low) - above(form, high))], [], 0
    while todo and held < wanted:
        lo, hi, count = todo.pop()
        if count == 0:
            continue
        if count > size and hi - lo > 1e-9 * high:
            middle = (lo + hi) / 2
            upper = above(form, middle) - above(form, hi)
            todo += [(lo, middle, count - upper), (middle, hi, upper)]
            continue
        found.append((lo, hi, count))
        held += count
    return found


def feast(matrix: np.ndarray, low: float, high: float, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs with eigenvalues in (low, high], ascending, to double precision.

    Every round applies the rational filter of the contour to the block and
    extracts Ritz pairs; an interval whose edge cuts through close neighbours
    converges slowly, so the block is wider than the count and grows if need be.
    """
    size = len(matrix)
    points, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi / 2 * (1 + points))
    centre, radius = (low + high) / 2, (high - low) / 2
    scale = np.abs(matrix).sum(axis=1).max(initial=0) or 1.0
    solves = [np.linalg.inv((centre + radius * t) * np.eye(size) - matrix) for t in turn]
    width = min(size, 2 * count + 4)
    block = np.random.default_rng(seed).standard_normal((size, width))
    for step in range(1, ROUNDS + 1):
        filtered = sum(w / 2 * (radius * t * (inverse @ block)).real for w, t, inverse in zip(weights, turn, solves, strict=True))
        basis = np.linalg.qr(filtered)[0]
        values, rotation = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ rotation
        inside = (values > low) & (values <= high)
        residual = np.linalg.norm(matrix @ block - block * values, axis=0)
        # pairs of the filter's far side may stray in before they converge
        good = inside & (residual <= 1e-13 * scale * np.sqrt(size))
        if good.sum() == count == inside.sum():
            return values[good], block[:, good]
        if step % 10 == 0 and width < size:
            more = min(size, 2 * width) - width
            block, width = np.hstack([block, np.random.default_rng(seed + step).standard_normal((size, more))]), width + more
    raise ArithmeticError(f"{count} eigenvalues lie in ({low}, {high}], {int(good.sum())} converged")


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns; fewer if the matrix has a lower rank.

    The number found in every interval equals its inertia count, so none is missed.
    """
    size = len(matrix)
    top = np.abs(matrix).sum(axis=1).max(initial=0)
    if not top > 0:
        return np.zeros(0), np.zeros((size, 0))
    form = tridiagonal(matrix / top)
    edge = 1.0 + 1e-9
    parts = [feast(matrix / top, lo, hi, count) for lo, hi, count in intervals(form, SMALLEST, edge, wanted)]
    values = np.concatenate([v for v, _ in parts]) if parts else np.zeros(0)
    vectors = np.hstack([v for _, v in parts]) if parts else np.zeros((size, 0))
    basis = np.linalg.qr(vectors)[0]  # a last Rayleigh-Ritz step over all intervals: close pairs that an edge parted become orthogonal
    values, rotation = np.linalg.eigh(basis.T @ (matrix / top) @ basis)
    vectors = basis @ rotation
    order = np.argsort(-values, kind="stable")[:wanted]
    order = order[values[order] > SMALLEST * values.max(initial=0) * size]
    return values[order] * top, vectors[:, order]


# ---- passes over the table


def integer_vectors(embeddings: DataFrame, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """(vec_id, x): the integer vectors of all rows whose vector is whole: not null, no null and no non-finite entry."""
    entries = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), entries.alias("e"))
    whole = rows.where(F.col("e").isNotNull() & F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return whole.select("vec_id", F.transform("e", lambda c: F.floor(c * scale) + shift).alias("x"))


def _added(rows: DataFrame, per_batch: Callable[[np.ndarray], list[tuple[int, int | float]]], kind: str) -> dict[int, Decimal | float]:
    """The values that ``per_batch`` gives by slot for blocks of vectors, added up within tasks and then by Spark."""

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, int | float] = {}
        for frame in frames:
            for at in range(0, len(frame), _BATCH):
                for slot, value in per_batch(np.array(frame["x"].iloc[at : at + _BATCH].tolist(), np.int64)):
                    held[slot] = held.get(slot, 0) + value
        if held:
            values = [Decimal(v) for v in held.values()] if kind != "double" else list(held.values())
            yield pd.DataFrame({"slot": list(held), "value": values})

    parts = rows.select("x").mapInPandas(task, f"slot int, value {kind}")
    return {r["slot"]: r["value"] for r in parts.groupBy("slot").agg(F.sum("value").cast(kind).alias("value")).collect()}


def _upper(block: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> list[int]:
    """Sums of products of the centred entries, exact."""
    size = float(np.abs(block).max(initial=0))
    if size * size * len(block) < _EXACT:
        wide = block.astype(float)
        return [int(v) for v in (wide.T @ wide)[pairs]]
    wide = block.astype(object)
    return list((wide.T @ wide)[pairs])


def whiten(embeddings: DataFrame, wanted: int = 16) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each whole row and component.

    Rows whose vector is null or holds a null or non-finite entry are dropped,
    as are empty vectors and those of another length than most (ties: the
    greater), for which the covariance has no place. Repeated rows and ids are
    answered row by row, and count once in the fit. Components with an
    eigenvalue of zero (fewer distinct vectors than dimensions, say) do not
    exist: with a single distinct vector no row comes out, nor of an empty
    table. A deviation beyond 64 bits is null.
    """
    spark = embeddings.sparkSession
    vectors = integer_vectors(embeddings)
    empty = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = vectors.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("rows")).where("d > 0")
    size = lengths.agg(F.max_by("d", F.struct("rows", "d"))).first()[0]
    if size is None:
        return spark.createDataFrame([], empty)
    vectors = vectors.where(F.size("x") == size)
    path = fresh_path(spark, "whitening-fit")
    vectors.select("x").distinct().write.parquet(path)
    fit = spark.read.parquet(path)

    def column_sums(block: np.ndarray) -> list[tuple[int, int]]:
        wide = block if float(np.abs(block).max(initial=0)) * len(block) < 2.0**62 else block.astype(object)
        return [(-1, len(block)), *enumerate(int(v) for v in wide.sum(axis=0))]

    sums = _added(fit, column_sums, "decimal(38,0)")
    n, total = int(sums[-1]), [int(sums[k]) for k in range(size)]
    near = [(2 * s + n) // (2 * n) for s in total]  # the mean as whole numbers: what is centred on it stays exact
    pairs = np.triu_indices(size)

    def products(block: np.ndarray) -> list[tuple[int, int]]:
        centred = block.astype(object) - np.array(near, object) if any(abs(v) >= 1 << 62 for v in near) else block - np.array(near, np.int64)
        return list(enumerate(_upper(centred, pairs)))

    sums = _added(fit, products, "decimal(38,0)")
    rest = [s - n * c for s, c in zip(total, near, strict=True)]  # n times the mean's distance from ``near``
    covariance = np.zeros((size, size))
    with localcontext() as context:
        context.prec = 60
        for slot, (i, j) in enumerate(zip(*pairs, strict=True)):
            covariance[i, j] = covariance[j, i] = float((Decimal(int(sums[slot]) * n) - rest[i] * rest[j]) / (Decimal(n) * n))
    values, components = leading(covariance, wanted)
    if not len(values):
        return spark.createDataFrame([], empty)
    spread = components / np.sqrt(values)
    offset = np.array([r / n for r in rest])
    whole = np.array(near, np.int64)

    def projected(block: np.ndarray) -> np.ndarray:
        return ((block - whole).astype(float) - offset) @ spread

    many = len(values)
    square = np.triu_indices(many)

    def moments(block: np.ndarray) -> list[tuple[int, float]]:
        y = projected(block)
        return [*((-1 - k, float(v)) for k, v in enumerate(y.sum(axis=0))), *enumerate(float(v) for v in (y.T @ y)[square])]

    sums = _added(fit, moments, "double")
    error = max(abs(sums[slot] / n - (sums[-1 - int(i)] / n) * (sums[-1 - int(j)] / n) - (i == j)) for slot, (i, j) in enumerate(zip(*square, strict=True)))
    explained = values / np.trace(covariance)

    def deviations(block: np.ndarray) -> list[int | None]:
        most = float(np.abs(block - whole).max(initial=0)) * n + float(np.abs(np.array(rest, float)).max(initial=0))
        centred = n * (block - whole) - np.array(rest, np.int64) if most**2 * size < 2.0**62 else n * (block.astype(object) - whole) - np.array(rest, object)
        found = [int(v) for v in (centred * centred).sum(axis=1)]
        return [v if v < 1 << 63 else None for v in found]

    def answers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), _BATCH):
                part = frame.iloc[at : at + _BATCH]
                block = np.array(part["x"].tolist(), np.int64)
                ids = part["vec_id"].astype("Int64").repeat(many).reset_index(drop=True)
                yield pd.DataFrame({
                    "vec_id": ids, "component": np.tile(np.arange(1, many + 1), len(block)), "n": n,
                    "deviation": pd.array(deviations(block), "Int64").repeat(many), "whitened": projected(block).ravel(),
                    "explained": np.tile(explained, len(block)), "identity_error": error,
                })

    return vectors.mapInPandas(answers, empty)
