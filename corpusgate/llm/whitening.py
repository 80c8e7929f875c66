"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors are put on an integer grid, x = floor(scale * c) + shift, and each distinct x counts once in the
fit. With A the centred fit rows, alternating distributed products Av and Aᵀu give A V = U B, B upper
bidiagonal; its small SVD yields the principal components and their deviations. A column u of U is A c for
a short vector c that the driver holds, so every step is one pass over the stored fit rows: it returns
Aᵀu, Uᵀu and |u|², which reorthogonalise u against all columns before it (a second pass is taken where
that removed much), while v is reorthogonalised on the driver. All dimensions are gone through, so
repeated deviations are not missed; where a column vanishes the next v is a fresh orthogonal direction.
Sums, counts and squared deviations are exact integers; rows are centred before they are multiplied.

The driver holds vectors and matrices of the dimension only. Passes: one per dimension, and three.

Defined cases: rows whose vector is null or holds null or non-finite entries, or entries beyond the range
of a long on the grid, are left out, as are those whose length is not the most frequent one (ties: the
longer); repeated rows are projected one by one but fitted once; components without deviation (relative
to the first, below what a double can tell from 0) are not returned, so equal vectors give arrays of
length 0; an empty table gives an empty result; a squared deviation beyond a long is null; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgate.llm import texts
from corpusgate.session import durable

#: Entries are split at this bit for exact sums.
SPLIT = 20
#: Largest number on the grid.
LARGEST = float(1 << 62)


@dataclass(frozen=True)
class Model:
    """Exact centre (sums over the fit rows, and their number), components as columns, and what they explain."""

    n: int
    sums: list[int]
    components: np.ndarray
    deviations: np.ndarray  # eigenvalues of the covariance, falling
    explained: np.ndarray
    identity_error: float


def gridded(vectors: DataFrame, id_col: str, vector_col: str, scale: float, shift: int) -> DataFrame:
    """(id, x) of the rows that count, all of one length."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    rows = rows.where(F.forall("v", lambda c: F.abs(c * F.lit(float(scale))) < LARGEST))  # false for NaN, null for null
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    x = F.transform("v", lambda c: F.floor(c * F.lit(float(scale))).cast("long") + F.lit(shift).cast("long"))
    return rows.where(F.size("v") == (sizes[0]["size"] if sizes else 0)).select("id", x.alias("x"))


def matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: 64-bit numbers where they suffice, else Python's."""
    most = max(abs(int(x.max())), abs(int(x.min())), max(map(abs, sums)) // n + 1) * 2 * n
    if most < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(c: np.ndarray) -> list[int | None]:
    """Exact sum of squares of each row; None beyond a long."""
    most = max(abs(int(c.max(initial=0))), abs(int(c.min(initial=0))))
    if most * most * c.shape[1] < 1 << 63:
        return (c * c).sum(axis=1).tolist()
    exact = (c.astype(object) ** 2).sum(axis=1).tolist()
    return [x if x < 1 << 63 else None for x in exact]


def totals(fit: DataFrame, d: int, width: int, kind: str, share: Callable[[np.ndarray], np.ndarray]) -> list:
    """Sum over all fit rows of what ``share`` makes of a block of them; ``width`` numbers a task are sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.float64 if kind == "double" else np.int64)
        for _, x in matrices(batches, d):
            total += share(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["slot", "value"])

    got = texts.arrow(fit, run, f"slot long, value {kind}").groupBy("slot").agg(F.sum("value").alias("value")).collect()
    values = dict(map(tuple, got))
    return [values.get(k, 0) for k in range(width)]


def bidiagonalised(product: Callable[[np.ndarray, np.ndarray], tuple], d: int, size: float, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(V, B) of a matrix with Frobenius norm ``size``; ``product(c, C)`` gives (Aᵀ A c, (A C)ᵀ A c, |A c|²)."""
    rng = np.random.default_rng(seed)
    v_all, c_all, back = np.zeros((d, d)), np.zeros((d, d)), np.zeros((d, d))  # V, U = A c_all, Aᵀ U
    b, tiny = np.zeros((d, d)), size * d * np.finfo(float).eps

    def against(w: np.ndarray, k: int) -> np.ndarray:
        for _ in range(2):
            w = w - v_all[:, :k] @ (v_all[:, :k].T @ w)
        return w

    def fresh(k: int) -> np.ndarray:
        w = against(rng.standard_normal(d), k)
        w = against(w / np.linalg.norm(w), k)
        return w / np.linalg.norm(w)

    v = fresh(0)
    for k in range(d):
        v_all[:, k] = v
        c = v - (b[k - 1, k] * c_all[:, k - 1] if k else 0)
        norm = 0.0
        for _ in range(4):
            g, h, square = product(c, c_all[:, :k])
            c, g, left = c - c_all[:, :k] @ h, g - back[:, :k] @ h, square - h @ h
            norm = np.sqrt(max(left, 0.0))
            if left >= 0.99 * square or norm <= tiny:
                break
        if norm > tiny:
            b[k, k], c_all[:, k], back[:, k] = norm, c / norm, g / norm
        if k + 1 < d:
            w = against(back[:, k] - b[k, k] * v, k + 1)
            beta = np.linalg.norm(w)
            if norm > tiny and beta > tiny:
                b[k, k + 1], v = beta, against(w / beta, k + 1)
                v = v / np.linalg.norm(v)
            else:
                v = fresh(k + 1)
    return v_all, b


def fitted(fit: DataFrame, d: int, components: int = 16) -> Model | None:
    """Model of a stored table of distinct vectors ``x`` of length ``d``; None where it has no row."""

    def parts(x: np.ndarray) -> np.ndarray:
        high = x >> SPLIT
        return np.concatenate([[len(x)], high.sum(axis=0), (x - (high << SPLIT)).sum(axis=0)])

    n, *halves = totals(fit, d, 1 + 2 * d, "long", parts)
    if not n or not d:
        return None
    sums = [(a << SPLIT) + b for a, b in zip(halves[:d], halves[d:])]
    rows = lambda x: (centred(x, n, sums) / n).astype(np.float64)

    def product(c: np.ndarray, done: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        def share(x: np.ndarray) -> np.ndarray:
            a = rows(x)
            u = a @ c
            return np.concatenate([a.T @ u, (a @ done).T @ u, [u @ u]])

        got = np.array(totals(fit, d, d + done.shape[1] + 1, "double", share))
        return got[:d], got[d:-1], float(got[-1])

    square = totals(fit, d, 1, "double", lambda x: np.array([(rows(x) ** 2).sum()]))[0]
    v, b = bidiagonalised(product, d, float(np.sqrt(square)))
    _, sigma, right = np.linalg.svd(b)
    real = int((sigma > sigma[0] * d * 8 * np.finfo(float).eps).sum()) if square else 0
    k = min(components, real)
    axes, deviations = v @ right[:k].T, sigma[:k] ** 2 / n

    def spread(x: np.ndarray) -> np.ndarray:
        w = rows(x) @ axes / np.sqrt(deviations)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    got = np.array(totals(fit, d, k + k * k, "double", spread)) / n if k else np.empty(0)
    error = np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max() if k else 0.0
    return Model(n, sums, axes, deviations, deviations / (square / n) if k else deviations, float(error))


def whitened(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 64.0,
    shift: int = 1_000_000,
    components: int = 16,
) -> DataFrame:
    """(id, n, squared deviation, whitened array, explained array, identity error) of every row that counts."""
    grid = gridded(vectors, id_col, vector_col, scale, shift)
    fit = durable(grid.select("x").distinct(), "whitening-fit")
    head = fit.select(F.size("x")).first()
    d = head[0] if head else 0
    model = fitted(fit, d, components)
    schema = f"id {grid.schema['id'].dataType.simpleString()}, deviation long, whitened array<double>"

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in matrices(batches, d):
            c = centred(x, model.n, model.sums)
            w = (c / model.n).astype(np.float64) @ model.components / np.sqrt(model.deviations)
            ends = np.arange(len(x) + 1) * w.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(squares(c), pa.int64()), lists], names=["id", "deviation", "whitened"]
            )

    rows = texts.arrow(grid, project, schema) if model else texts.arrow(grid.limit(0), lambda b: iter(()), schema)
    explained = [float(x) for x in model.explained] if model else []
    return rows.select(
        F.col("id").alias(id_col),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*map(F.lit, explained)).cast("array<double>").alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"),
    )


def by_component(rows: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """One row per row of `whitened` and component, numbered from 1."""
    return rows.select("*", F.posexplode("whitened").alias("place", "own")).select(
        F.col(f"`{id_col}`"),
        (F.col("place") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("own").alias("whitened"),
        F.get("explained", F.col("place")).alias("explained"),
        "identity_error",
    )
