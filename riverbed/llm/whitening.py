"""Whitening of embeddings by a distributed Jacobi-Davidson eigensolver.

Entries are scaled to integers, ``x = floor(scale * c)``, and each distinct
vector is fitted once. The covariance is never formed: a product with a block
of vectors is one Spark job over the fit table, in which each task centres its
rows, multiplies them with the block and adds up ``C^T (C b)``; tasks' sums
meet in an aggregation by entry, and d x b numbers reach the driver.

The driver holds the search space, at most ``max_basis`` vectors of the
embeddings' dimension. Each round: Rayleigh-Ritz in the space; Ritz pairs whose
residual has reached double precision are locked, from the largest on, and
projected out; for the other wanted pairs the correction equations

    (I - P P^T) (A - theta I) (I - P P^T) t = -r,   P = locked and current vectors

are solved by a few steps of MINRES, all of them in lockstep so that a step is
one product; the corrections, made orthogonal, extend the space, and a space
that is full restarts from its leading Ritz vectors.

At scale: distinct vectors are found by a partial aggregation (a vector that
fills a third of the rows costs a row per task), sums are 38-digit decimals,
tasks hold one Arrow batch, and a lost executor repeats its part of one
product. The fit table is written to the shared folder and read per product.

Defined cases: vectors that are NULL, hold a NULL or a non-finite entry are
left out, as are those whose length is not that of most rows (ties: the longer
one) and empty ones; repeated rows and ids are all returned, a NULL id stays
NULL. Directions without variance are no components, so fewer than four may
come back; a table without two different vectors gives none and an empty
result. A ``deviation`` that no long holds is NULL. Only the id and vector
columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import stage_table

SCALE, COMPONENTS = 256, 4
EPS = float(np.finfo(np.float64).eps)


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the rows whose vectors count, from the built-in functions."""
    entries = F.transform(F.col(f"`{vector_col}`"), lambda c: c.cast("double"))
    good = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    ok = (rows.select(F.col(f"`{id_col}`").alias("vec_id"), entries.alias("x"))
          .filter(F.col("x").isNotNull() & (F.size("x") > 0) & good)
          .withColumn("x", F.transform("x", lambda c: F.floor(c * scale))))
    top = (ok.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.col("n").desc(), F.col("d").desc()).first())
    return ok.filter(F.size("x") == (top["d"] if top else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of an Arrow batch as rows of one integer array."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0), np.int64)


class Fit(NamedTuple):
    """The fit table and its exact count and sums."""
    table: DataFrame
    n: int
    sums: list[int]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _task_sums(table: DataFrame, size: int, add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``add(rows)``, ``size`` doubles, over all rows of the table:
    added up per task, then by place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros(size), False
        for b in batches:
            if b.num_rows:
                any_rows = True
                total += add(matrix(b.column("x")))
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)],
                                             ["place", "value"])

    out = np.zeros(size)
    sums = table.select("x").mapInArrow(run, "place int, value double").groupBy("place")
    for r in sums.agg(F.sum("value").alias("value")).collect():
        out[r["place"]] = r["value"]
    return out


def fit_list(vectors: DataFrame) -> Fit:
    """Each distinct vector once, written to the shared folder."""
    table = stage_table(vectors.select("x").distinct(), "whitening-fit")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column("x"))
            # Halves of 32 bits: sums of a batch fit a long whatever the entries are.
            low, high = (x & 0xFFFFFFFF).sum(0), (x >> 32).sum(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(x.shape[1], dtype=np.int32)), pa.array(np.full(x.shape[1], len(x))),
                 pa.array(low), pa.array(high)], ["place", "n", "low", "high"])

    total = (table.mapInArrow(add, "place int, n bigint, low bigint, high bigint").groupBy("place")
             .agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("low", "high")])
             .orderBy("place").collect())
    sums = [int(r["low"]) + (int(r["high"]) << 32) for r in total]
    return Fit(table, total[0]["n"] if total else 0, sums)


def covariance_product(fit: Fit) -> Callable[[np.ndarray], np.ndarray]:
    """v -> V v for a block of vectors, V the covariance of the fit list."""
    mean, n = fit.mean, fit.n

    def product(block: np.ndarray) -> np.ndarray:
        def add(x: np.ndarray) -> np.ndarray:
            c = x - mean
            return (c.T @ (c @ block)).ravel()
        return _task_sums(fit.table, block.size, add).reshape(block.shape) / n
    return product


def _orthogonal(block: np.ndarray, to: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the block's part that is orthogonal to ``to``."""
    out = np.zeros((block.shape[0], 0))
    for k in range(block.shape[1]):
        v = block[:, k] / (np.linalg.norm(block[:, k]) or 1.0)
        for _ in range(3):
            v = v - to @ (to.T @ v)
            v = v - out @ (out.T @ v)
            size = np.linalg.norm(v)
            if size < 1e-10:
                break
            v = v / size
        else:
            out = np.column_stack([out, v])
    return out


def minres(product: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Approximate solutions of symmetric systems, a column each, in lockstep:
    ``steps`` products at most, or until every residual fell by ``enough``."""
    x = np.zeros_like(rhs)
    beta = np.linalg.norm(rhs, axis=0)
    safe = np.where(beta > 0, beta, 1.0)
    v_old, v = np.zeros_like(rhs), rhs / safe
    w_old, w = np.zeros_like(rhs), np.zeros_like(rhs)
    eta, first = beta.copy(), beta.copy()
    c_old = c = np.ones(rhs.shape[1])
    s_old = s = np.zeros(rhs.shape[1])
    b = np.zeros(rhs.shape[1])
    for _ in range(steps):
        p = product(v)
        alpha = (v * p).sum(0)
        p = p - alpha * v - b * v_old
        b_next = np.linalg.norm(p, axis=0)
        # Givens rotations of the tridiagonal matrix's next column.
        r3, r2 = s_old * b, s * alpha + c_old * c * b
        r1 = c * alpha - c_old * s * b
        size = np.hypot(r1, b_next)
        live = (size > EPS * np.abs(alpha).max(initial=1e-300)) & (eta != 0)
        size = np.where(live, size, 1.0)
        c_old, s_old = c, s
        c, s = np.where(live, r1 / size, 1.0), np.where(live, b_next / size, 0.0)
        w_new = np.where(live, (v - r3 * w_old - r2 * w) / size, 0.0)
        w_old, w = w, w_new
        x = x + np.where(live, c * eta, 0.0) * w
        eta = np.where(live, -s * eta, 0.0)
        v_old, v = v, p / np.where(b_next > 0, b_next, 1.0)
        b = b_next
        if np.all(np.abs(eta) <= enough * first):
            break
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, *, inner: int = 4,
                    max_basis: int = 24, max_rounds: int = 100, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric positive semidefinite
    operator and their unit eigenvectors, falling, with residuals of at most
    16 sqrt(dim) units of double rounding of the largest eigenvalue."""
    wanted = min(wanted, dim)
    locked, values = np.zeros((dim, 0)), []
    start = np.random.default_rng(seed).standard_normal((dim, min(dim, 2 * wanted)))
    space = _orthogonal(start, locked)
    image = product(space)
    for _ in range(max_rounds):
        inside = space.T @ image
        theta, turn = np.linalg.eigh((inside + inside.T) / 2)
        space, image = space @ turn[:, ::-1], image @ turn[:, ::-1]
        theta = theta[::-1]
        rest = image - space * theta
        rest = rest - locked @ (locked.T @ rest)
        limit = 16 * np.sqrt(dim) * EPS * max([abs(theta[0]) if len(theta) else 0.0, *values])
        done = 0
        while done < len(theta) and len(values) + done < wanted and np.linalg.norm(rest[:, done]) <= limit:
            done += 1
        values += theta[:done].tolist()
        locked = np.column_stack([locked, space[:, :done]])
        space, image, theta, rest = space[:, done:], image[:, done:], theta[done:], rest[:, done:]
        if len(values) == wanted:
            break
        if space.shape[1] + (wanted - len(values)) > max_basis:
            keep = max_basis // 2
            space, image, theta, rest = space[:, :keep], image[:, :keep], theta[:keep], rest[:, :keep]
        todo = min(wanted - len(values), space.shape[1])
        if todo:
            known = np.column_stack([locked, space[:, :todo]])
            shift = theta[:todo]

            def projected(t: np.ndarray) -> np.ndarray:
                t = t - known @ (known.T @ t)
                t = product(t) - t * shift
                return t - known @ (known.T @ t)

            rhs = rest[:, :todo]
            more = minres(projected, -(rhs - known @ (known.T @ rhs)), inner, 1e-4)
        else:
            more = np.random.default_rng(seed + len(values)).standard_normal((dim, wanted - len(values)))
        more = _orthogonal(more, np.column_stack([locked, space]))
        if not more.shape[1]:  # the corrections add nothing: look elsewhere
            more = np.random.default_rng(seed + 1 + len(values)).standard_normal((dim, max(todo, 1)))
            more = _orthogonal(more, np.column_stack([locked, space]))
        if more.shape[1]:
            space, image = np.column_stack([space, more]), np.column_stack([image, product(more)])
    else:
        raise RuntimeError(f"{wanted - len(values)} eigenpairs did not reach double precision in {max_rounds} rounds")
    order = np.argsort(values)[::-1]
    return np.array(values)[order], locked[:, order]


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE) -> DataFrame:
    """One row per counted row and component: vec_id, component (from 1, by
    falling variance), n, deviation, whitened, explained, identity_error."""
    schema = ("component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    id_type = rows.schema[id_col].dataType.simpleString()
    vectors = integer_vectors(rows, id_col, vector_col, scale)
    fit = fit_list(vectors)
    empty = rows.sparkSession.createDataFrame([], f"vec_id {id_type}, {schema}")
    if fit.n < 2:
        return empty
    mean, n, dim = fit.mean, fit.n, len(fit.sums)
    values, axes = jacobi_davidson(covariance_product(fit), dim, components)
    real = values > dim * EPS * values[0]
    values, axes = values[real], axes[:, real]
    k = len(values)
    if not k:
        return empty
    turn = axes / np.sqrt(values)
    trace = _task_sums(fit.table, 1, lambda x: np.array([np.square(x - mean).sum()]))[0] / n
    middle = _task_sums(fit.table, k, lambda x: ((x - mean) @ turn).sum(0)) / n

    def spread(x: np.ndarray) -> np.ndarray:
        z = (x - mean) @ turn - middle
        return (z.T @ z).ravel()

    error = float(np.abs(_task_sums(fit.table, k * k, spread).reshape(k, k) / n - np.eye(k)).max())
    explained, sums = values / trace, fit.sums

    def deviations(x: np.ndarray) -> pa.Array:
        """sum of (n x - S)^2, exact: in longs where they surely hold it, else in Python's integers."""
        most = n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, sums))
        if most * most * dim < 1 << 63:
            return pa.array(np.square(n * x - np.array(sums)).sum(1))
        exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.tolist()]
        return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column("x"))
            rows_, each = np.repeat(np.arange(len(x)), k), np.tile(np.arange(k), len(x))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(rows_)), pa.array((each + 1).astype(np.int32)),
                 pa.array(np.full(len(rows_), n)), deviations(x).take(pa.array(rows_)),
                 pa.array(((x - mean) @ turn).ravel()), pa.array(explained[each]),
                 pa.array(np.full(len(rows_), error))],
                ["vec_id", *(f.split()[0] for f in schema.split(", "))])

    return vectors.mapInArrow(project, f"vec_id {id_type}, {schema}")
