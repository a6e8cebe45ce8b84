"""Whitening of vectors by their leading principal components, found by Jacobi-Davidson.

Vectors are fitted as whole numbers x = floor(256 c), each distinct one once. The covariance is never formed: Spark
multiplies it with a few columns at a time, centred before multiplying, in one pass over the fitted vectors. The
driver holds what has the size of the components only: a search space that grows by the corrections of all open
components at once. Each correction equation is projected off what is found and solved by MINRES, whose products
share the passes. Rayleigh-Ritz in the space gives the next approximations; components are locked, the largest
first, once their residuals are at double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewright.llm.tables import written

COMPONENTS = 4
SCALE = 256
# Columns of the first space beyond the wanted ones, and the space's size when it is begun anew.
GUARD = 8
SPACE = 40
# MINRES steps per correction, and the share of the residual at which it may stop.
INNER = 3
ENOUGH = 0.1
# A residual of this share of the largest eigenvalue is double precision: a few hundred roundings of a sum.
PRECISION = 1e-13
ROUNDS = 300
# Vectors in one block of the fitted table.
ROWS = 4096


def usable(vector: Column) -> Column:
    """Not null, and each component finite and, scaled, in the range of a long."""
    most = F.lit(float(2**62) / SCALE)
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < most))
    return vector.isNotNull() & finite


def scaled(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def orthonormal(columns: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """The columns made orthogonal to the bases and each other; those that vanish are left out."""
    kept: list[np.ndarray] = []
    for column in columns.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(3):
            for base in bases:
                column = column - base @ (base.T @ column)
            for other in kept:
                column = column - other * (other @ column)
            size = np.linalg.norm(column)
            if size < 1e-10:
                break
            column = column / size
        else:
            kept.append(column)
    return np.stack(kept, axis=1) if kept else np.zeros((len(columns), 0))


def minres(apply, right: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Solves a symmetric system for each column by itself; ``apply(columns, which)`` multiplies some of them."""
    answer = np.zeros_like(right)
    start = np.linalg.norm(right, axis=0)
    which = np.flatnonzero(start)
    beta = start[which]
    v = right[:, which] / beta
    before, w, w_before = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    eta, cos, cos_before = beta.copy(), np.ones(len(which)), np.ones(len(which))
    sin, sin_before = np.zeros(len(which)), np.zeros(len(which))
    for _ in range(steps):
        if not len(which):
            break
        image = apply(v, which) - before * beta
        alpha = (v * image).sum(axis=0)
        image = image - v * alpha
        following = np.linalg.norm(image, axis=0)
        delta = cos * alpha - cos_before * sin * beta
        one = np.hypot(delta, following)
        two, three = sin * alpha + cos_before * cos * beta, sin_before * beta
        one = np.where(one > 0, one, 1)
        cos_before, sin_before, cos, sin = cos, sin, delta / one, following / one
        w_before, w = w, (v - w_before * three - w * two) / one
        answer[:, which] += w * (cos * eta)
        eta = -sin * eta
        beta = following
        go_on = (np.abs(eta) > enough * start[which]) & (following > 1e-14 * start[which])
        before, v = v[:, go_on], image[:, go_on] / np.where(following > 0, following, 1)[go_on]
        w, w_before = w[:, go_on], w_before[:, go_on]
        which, beta, eta = which[go_on], beta[go_on], eta[go_on]
        cos, sin, cos_before, sin_before = cos[go_on], sin[go_on], cos_before[go_on], sin_before[go_on]
    return answer


def jacobi_davidson(product, size: int, wanted: int, precision: float = PRECISION, seed: int = 0):
    """(values, vectors): the largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns.

    ``product(columns)`` multiplies the matrix with columns; there is one call per step, for all open components.
    """
    draw = np.random.default_rng(seed)
    wanted = min(wanted, size)
    locked, values = np.zeros((size, 0)), []
    basis = orthonormal(draw.normal(size=(size, min(size, wanted + GUARD))))
    image = product(basis)
    largest = 0.0
    for _ in range(ROUNDS):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        largest = max([largest, *np.abs(theta), *np.abs(values)])
        open_ = min(wanted - len(values), basis.shape[1])
        residual = image[:, :open_] - basis[:, :open_] * theta[:open_]
        residual -= locked @ (locked.T @ residual)
        near = np.linalg.norm(residual, axis=0) <= precision * largest
        done = int(np.argmin(near)) if not near.all() else open_
        if done:
            values += theta[:done].tolist()
            locked = np.concatenate([locked, basis[:, :done]], axis=1)
            basis, image, theta = basis[:, done:], image[:, done:], theta[done:]
            residual, open_ = residual[:, done:], open_ - done
        if len(values) == wanted:
            order = np.argsort(values)[::-1]
            return np.array(values)[order], locked[:, order]
        if basis.shape[1] + len(values) + open_ > max(SPACE, 2 * (wanted + GUARD)):
            keep = wanted + GUARD
            basis, image = basis[:, :keep], image[:, :keep]
        if open_:
            around = np.concatenate([locked, basis[:, :open_]], axis=1)

            def projected(columns, around=around):
                return columns - around @ (around.T @ columns)

            def apply(columns, which, projected=projected, theta=theta):
                columns = projected(columns)
                return projected(product(columns) - columns * theta[which])

            new = minres(apply, -projected(residual), INNER, ENOUGH)
            fresh = orthonormal(np.concatenate([new, residual], axis=1), locked, basis)[:, :open_]
        else:
            fresh = np.zeros((size, 0))
        if not fresh.shape[1] and basis.shape[1] + len(values) < size:
            fresh = orthonormal(draw.normal(size=(size, wanted)), locked, basis)
        if fresh.shape[1]:
            basis, image = np.concatenate([basis, fresh], axis=1), np.concatenate([image, product(fresh)], axis=1)
        else:
            # The space is whole: products of its turned columns round anew.
            basis = orthonormal(basis, locked)
            image = product(basis)
    raise ArithmeticError(f"residuals stay above {precision} of the largest eigenvalue")


def _fitted(rows: DataFrame, size: int) -> DataFrame:
    """The distinct vectors, written as blocks of whole numbers."""

    def blocks(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.column(0).slice(first, ROWS)
                yield pa.RecordBatch.from_arrays([pa.array([part.flatten().to_numpy().tobytes()], pa.binary())], ["block"])

    distinct = rows.select("x").groupBy("x").agg(F.lit(1).alias("one")).select("x")
    return written(distinct.mapInArrow(blocks, "block binary"), "fitted")


def _matrices(batches, size: int):
    for batch in batches:
        for block in batch.column(0):
            yield np.frombuffer(block.as_buffer(), np.int64).reshape(-1, size)


def _added(fit: DataFrame, size: int, parts: int, add) -> np.ndarray:
    """Sums over all blocks of the arrays that ``add(matrix)`` gives, each of ``parts`` doubles."""

    def partial(batches):
        total = np.zeros(parts)
        for matrix in _matrices(batches, size):
            total += add(matrix)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts)), pa.array(total)], ["at", "value"])

    rows = fit.mapInArrow(partial, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(parts)
    out[rows.column("at").to_numpy()] = rows.column("value").to_numpy()
    return out


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """How many vectors there are, and their exact sum; halves of 32 bits are added by themselves."""

    def partial(batches):
        total = np.zeros((2, size + 1), object)
        for matrix in _matrices(batches, size):
            total[0, :size] += (matrix >> 32).sum(axis=0)
            total[1, :size] += (matrix & 0xFFFFFFFF).sum(axis=0)
            total[1, size] += len(matrix)
        at = [i for i in range(size + 1) for _ in (0, 1)]
        values = [str(int(total[half, i])) for i in range(size + 1) for half in (0, 1)]
        yield pa.RecordBatch.from_pydict(
            {"at": pa.array(at, pa.int64()), "high": pa.array([True, False] * (size + 1)), "value": pa.array(values)}
        )

    rows = fit.mapInArrow(partial, "at long, high boolean, value string")
    rows = rows.groupBy("at", "high").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    sums = [0] * (size + 1)
    for at, high, value in rows:
        sums[at] += int(value) << 32 if high else int(value)
    return sums[size], sums[:size]


def whiten(
    frame: DataFrame,
    components: int = COMPONENTS,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every vector and component.

    Fitted are the distinct vectors x = floor(256 c): ``n`` of them. ``deviation`` is the squared distance of n x from
    their sum, in whole numbers (null beyond a long); ``whitened`` the centred x projected on the component over the
    root of its variance; ``explained`` its variance over that of all components; ``identity_error`` the largest entry
    of the whitened fitted vectors' covariance minus the identity, one value for all.

    Vectors that are null, empty, or hold a null or non-finite component or one beyond 2^54 take no part, and neither
    do those of another number of components than most have (ties: more components). Repeated rows are fitted once
    and returned each; a null id stays. Components without variance are none: vectors that are all equal, a single one,
    and an empty table give no rows. Other columns are not looked at.
    """
    rows = frame.select(frame[key].alias("vec_id"), frame[vector].alias("vector"))
    rows = rows.where(usable(F.col("vector")) & (F.size("vector") > 0))
    most = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    if most is None:
        return frame.sparkSession.createDataFrame([], schema)
    size = most["size"]
    rows = rows.where(F.size("vector") == size).select("vec_id", scaled(F.col("vector")).alias("x"))
    fit = _fitted(rows, size)
    n, sums = _sums(fit, size)
    mean = np.array([s / n for s in sums])

    def product(columns: np.ndarray) -> np.ndarray:
        def add(matrix):
            centred = matrix - mean
            return (centred.T @ (centred @ columns)).ravel()

        return _added(fit, size, columns.size, add).reshape(columns.shape) / n

    trace = float(_added(fit, size, size, lambda matrix: ((matrix - mean) ** 2).sum(axis=0)).sum() / n)
    values, vectors = jacobi_davidson(product, size, components)
    real = values > size * np.finfo(float).eps * max(values.max(), 0)
    values, vectors = values[real], vectors[:, real]
    number = len(values)
    if not number:
        return frame.sparkSession.createDataFrame([], schema)
    turn = vectors / np.sqrt(values)

    def moments(matrix):
        white = (matrix - mean) @ turn
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    added = _added(fit, size, number + number * number, moments) / n
    middle = added[:number]
    covariance = added[number:].reshape(number, number) - np.outer(middle, middle)
    error = float(np.abs(covariance - np.eye(number)).max())
    explained = values / trace
    total = np.array([s % 2**64 for s in sums], np.uint64)
    near = np.array([float(s) for s in sums])

    def project(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, size)
            white = (x - mean) @ turn
            with np.errstate(over="ignore"):
                apart = x.astype(np.uint64) * np.uint64(n) - total
                away = (apart * apart).sum(axis=1, dtype=np.uint64).view(np.int64)
            # Whole numbers wrap to the right result if that is in range; doubles tell whether it is.
            large = ((x * float(n) - near) ** 2).sum(axis=1) > 2.0**63 * (1 - 1e-9)
            count = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(count), number))),
                    pa.array(np.tile(np.arange(1, number + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * number, n)),
                    pa.array(np.repeat(away, number), mask=np.repeat(large, number)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, count)),
                    pa.array(np.full(count * number, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(project, schema)
