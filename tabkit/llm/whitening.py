"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The fit list X (distinct integer vectors) is persisted in blocks. With A the
centred rows, every step is one Spark job: tasks form u = A v - beta u' on their
blocks (Xv) and return the partial sums of A'u (X'u), of U'u and of u'u; sums
per entry are taken in Spark and one row per entry reaches the driver. Left
vectors are n long and never stored: a task builds those of its block again
from the few coefficients, in the same order of operations. Both sides are
fully reorthogonalised, a second time where much cancels. The small upper
bidiagonal matrix's SVD gives components (right vectors) and deviations
(singular values over sqrt(n)). A space that closes early is continued from a
new start vector, so repeated eigenvalues are all found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import land

SCALE = 256
COMPONENTS = 4
#: Rows of a block of the fit list.
BLOCK_ROWS = 4096
#: A direction is lost where its length is this share of the longest.
LOST = 1e-13


def integer_rows(rows: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """``id`` and ``x`` (array of long) of the rows whose vector is neither null
    nor empty and holds neither null nor non-finite entries."""
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    good = vec.isNotNull() & (F.size(vec) > 0) & ~F.exists(vec, bad)
    return (rows.select(F.col(f"`{id_col}`").alias("id"), vec.alias("v")).where(F.coalesce(good, F.lit(False)))
            .select("id", F.transform("v", lambda c: F.floor(c * scale).cast("long")).alias("x")))


def usual_length(rows: DataFrame) -> int | None:
    """The most frequent vector length, the larger one of equals; None without rows."""
    top = (rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.desc("d")).take(1))
    return top[0]["d"] if top else None


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _blocks(dim: int):
    """Rows of little-endian int64 matrices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0

        def block() -> pa.RecordBatch:
            x = np.concatenate(kept)
            return pa.RecordBatch.from_arrays([pa.array([x.astype("<i8").tobytes()], pa.binary())], names=["x"])
        for b in batches:
            x = matrix(b.column("x"), dim)
            for at in range(0, len(x), BLOCK_ROWS):
                kept.append(x[at:at + BLOCK_ROWS])
                size += len(kept[-1])
                if size >= BLOCK_ROWS:
                    yield block()
                    kept, size = [], 0
        if size:
            yield block()
    return run


@dataclass
class Steps:
    """What a task needs to build the left vectors again: for step j,
    u_j = (A v_j - sum_i< j r_ij u_i) / r_jj."""
    mean: np.ndarray
    right: list[np.ndarray] = field(default_factory=list)  # v_1, v_2, ...
    upper: list[np.ndarray] = field(default_factory=list)  # r_1j .. r_jj

    def left(self, centred: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for v, r in zip(self.right, self.upper, strict=True):
            u = centred @ v
            for c, w in zip(r[:-1], out, strict=True):
                if c:
                    u -= c * w
            out.append(u / r[-1])
        return out


def _products(steps: Steps, v: np.ndarray, minus: np.ndarray):
    """Partial sums over a task's blocks for u = A v - U minus: A'u, U'u, u'u."""
    dim = len(v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim + len(minus) + 1)
        for b in batches:
            for x in b.column("x"):
                a = np.frombuffer(x.as_py(), "<i8").reshape(-1, dim) - steps.mean
                left = steps.left(a)
                u = a @ v
                for c, w in zip(minus, left, strict=True):
                    if c:
                        u -= c * w
                total += np.concatenate([u @ a, [w @ u for w in left], [u @ u]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)],
                                         names=["at", "v"])
    return run


def summed(blocks: DataFrame, fn, size: int) -> np.ndarray:
    """Entry-wise sum of what the tasks return: one row an entry at the driver."""
    out = np.zeros(size)
    for r in blocks.mapInArrow(fn, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out


@dataclass
class Whitening:
    n: int
    sums: list[int]  # S, exact
    components: np.ndarray  # (found, dim), unit rows by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float
    steps: int  # Lanczos steps taken
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _moments(dim: int):
    """n, exact sums and exact sum of squares, as text (they may pass 64 bits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, squares, sums = 0, 0, [0] * dim
        for b in batches:
            for blob in b.column("x"):
                x = np.frombuffer(blob.as_py(), "<i8").reshape(-1, dim)
                wide = x if max(abs(int(x.min())), abs(int(x.max()))) < 1 << 20 else x.astype(object)
                n, squares = n + len(x), squares + int((wide * wide).sum())
                sums = [s + int(c) for s, c in zip(sums, wide.sum(axis=0), strict=True)]
        values = [n, squares, *sums]
        yield pa.RecordBatch.from_arrays([pa.array(range(dim + 2), pa.int32()), pa.array([str(v) for v in values])],
                                         names=["at", "v"])
    return run


def bidiagonalise(blocks: DataFrame, mean: np.ndarray, n: int, trace: float, wanted: int, seed: int = 13):
    """Golub-Kahan-Lanczos: (components, singular values, steps).

    Ends when the space is full, or when the wanted singular triplets have
    converged to double precision and what is left of the trace is too small to
    hold another value as large."""
    dim, steps = len(mean), Steps(mean)
    rng = np.random.default_rng(seed)
    done: list[np.ndarray] = []  # A'u_j, for reorthogonalising products

    v, scale, beta, previous, dead = _fresh(rng, [], dim), 0.0, 0.0, None, []
    while v is not None:
        k = len(steps.right)
        minus = np.zeros(k)
        if beta:
            minus[previous] = beta
        total = summed(blocks, _products(steps, v, minus), dim + k + 1)
        g, overlap, square = total[:dim], total[dim:dim + k], total[-1]
        if square > 0 and overlap @ overlap > 0.25 * square:
            # much cancels: correct and look again
            minus = minus + overlap
            total = summed(blocks, _products(steps, v, minus), dim + k + 1)
            g, overlap, square = total[:dim], total[dim:dim + k], total[-1]
        minus = minus + overlap
        for c, w in zip(overlap, done, strict=True):
            g = g - c * w
        alpha = np.sqrt(max(0.0, square - overlap @ overlap))
        scale = max(scale, alpha)
        if alpha <= LOST * scale or alpha == 0:
            # A v lies in the span of the left vectors: v closes the space
            dead.append((v, minus))
            v, beta = None, 0.0
        else:
            steps.right.append(v)
            steps.upper.append(np.append(minus, alpha))
            done.append(g / alpha)
            w = g / alpha - alpha * v
            for _ in range(2):
                for x in [*steps.right, *(d for d, _ in dead)]:
                    w -= (x @ w) * x
            beta, previous = float(np.linalg.norm(w)), k
            scale = max(scale, beta)
            v = w / beta if beta > LOST * scale else None
        known = len(steps.right) + len(dead)
        if known >= dim:
            break
        b = _small(steps, dead)
        p, s, q = np.linalg.svd(b)
        left_trace = n * trace - float((s * s).sum())
        if v is not None and len(s) >= wanted:
            residual = beta * np.abs(p[len(steps.right) - 1, :wanted])
            if residual.max() <= 1e-14 * s[0] and left_trace < 0.5 * s[wanted - 1] ** 2:
                break
        if v is None:
            if len(s) >= wanted and left_trace < 0.5 * s[wanted - 1] ** 2:
                break
            beta = 0.0
            basis = steps.right + [d for d, _ in dead]
            v = _fresh(rng, basis, dim)
    if not steps.right:
        return np.zeros((0, dim)), np.zeros(0), 0
    p, s, q = np.linalg.svd(_small(steps, dead))
    basis = np.array(steps.right + [d for d, _ in dead])
    found = q[:len(s)] @ basis
    keep = min(wanted, int((s > 1e-7 * s[0]).sum()) if s[0] > 0 else 0)
    found = found[:keep] / np.linalg.norm(found[:keep], axis=1, keepdims=True)
    return found, s[:keep], len(basis)


def _fresh(rng, basis: list[np.ndarray], dim: int) -> np.ndarray | None:
    """A unit vector orthogonal to the basis, None where the basis is full."""
    if len(basis) >= dim:
        return None
    while True:
        v = rng.standard_normal(dim)
        for _ in range(3):
            for w in basis:
                v -= (w @ v) * w
        if (size := np.linalg.norm(v)) > 1e-6:
            return v / size


def _small(steps: Steps, dead: list) -> np.ndarray:
    """U'A[right vectors, closing vectors]: upper bidiagonal but for rounding
    and the columns that closed a space."""
    k = len(steps.right)
    b = np.zeros((max(k, 1), k + len(dead)))
    for j, r in enumerate(steps.upper):
        b[:j + 1, j] = r
    for j, (_, r) in enumerate(dead):
        b[:len(r), k + j] = r
    return b


def _white_moments(fit: Whitening):
    """Sums and products of the whitened fit rows."""
    dim, k = fit.components.shape[1], len(fit.components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for b in batches:
            for x in b.column("x"):
                w = whiten(np.frombuffer(x.as_py(), "<i8").reshape(-1, dim), fit)
                total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)],
                                         names=["at", "v"])
    return run


def whiten(x: np.ndarray, fit: Whitening) -> np.ndarray:
    return (x - fit.mean) @ fit.components.T / np.sqrt(fit.eigenvalues)


def fit(rows: DataFrame, components: int = COMPONENTS, dim: int | None = None) -> Whitening | None:
    """Fit on the distinct vectors of ``integer_rows``; None without rows.
    Vectors of another length than ``dim`` (default: the most frequent one)
    are left out."""
    dim = dim or usual_length(rows)
    if dim is None:
        return None
    distinct = rows.where(F.size("x") == dim).select("x").distinct()
    blocks = land(distinct.mapInArrow(_blocks(dim), "x binary"), "fit_list").persist()
    try:
        exact: dict[int, int] = {}
        found = blocks.mapInArrow(_moments(dim), "at int, v string").select("at", F.col("v").cast("decimal(38,0)").alias("v"))
        for r in found.groupBy("at").agg(F.sum("v").cast("decimal(38,0)").alias("v")).collect():
            exact[r["at"]] = int(r["v"])
        n, squares = exact.get(0, 0), exact.get(1, 0)
        if not n:
            return None
        sums = [exact[2 + i] for i in range(dim)]
        trace = float((n * squares - sum(s * s for s in sums)) / (n * n))
        mean = np.array([s / n for s in sums])
        if trace <= 0:
            return Whitening(n, sums, np.zeros((0, dim)), np.zeros(0), 0.0, 0)
        vectors, singular, taken = bidiagonalise(blocks, mean, n, trace, min(components, dim))
        result = Whitening(n, sums, vectors, singular ** 2 / n, trace, taken)
        k = len(vectors)
        total = summed(blocks, _white_moments(result), k + k * k)
        m = total[:k] / n
        result.identity_error = float(np.abs(total[k:].reshape(k, k) / n - np.outer(m, m) - np.eye(k)).max()) if k else 0.0
        return result
    finally:
        blocks.unpersist()


def exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over the dimensions of (n x - S)^2, in integers of any size."""
    most = max((abs(int(x.max())) if x.size else 0, abs(int(x.min())) if x.size else 0))
    bound = n * most + max(abs(s) for s in sums)
    if len(sums) * bound * bound < 1 << 62:
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    d = n * x.astype(object) - np.array(sums, object)
    return [int(v) for v in (d * d).sum(axis=1)]


def _apply(fit_: Whitening):
    dim, k = fit_.components.shape[1], len(fit_.components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            x = matrix(b.column("x"), dim)
            deviation = pa.array([str(v) for v in exact_deviation(x, fit_.n, fit_.sums)])
            at = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 deviation.take(pa.array(at)), pa.array(whiten(x, fit_).ravel()),
                 pa.array(np.tile(fit_.eigenvalues / fit_.trace, m))],
                names=["id", "component", "deviation", "whitened", "explained"])
    return run


def whitened(table: DataFrame, components: int = COMPONENTS, vec_col: str = "embedding", id_col: str = "vec_id",
             scale: int = SCALE) -> DataFrame:
    """One row per usable row of ``table`` and component: id, component (from 1),
    n, deviation (decimal), whitened, explained, identity_error.

    x = floor(scale * entry); rows whose vector is null, empty, holds null or
    non-finite entries or has another length than most are left out. The fit
    list is every distinct x once; repeated rows all get results. There are at
    most ``components`` components, fewer where the covariance has fewer
    eigenvalues above rounding; equal vectors only, or an empty table, give no
    rows. Null ids stay null; other columns are not read."""
    rows = integer_rows(table, vec_col, id_col, scale)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, deviation string, whitened double, explained double"
    result = fit(rows, components)
    if result is None or not len(result.components):
        out = rows.sparkSession.createDataFrame([], schema)
        n, error = 0, 0.0
    else:
        dim = result.components.shape[1]
        out = rows.where(F.size("x") == dim).mapInArrow(_apply(result), schema)
        n, error = result.n, result.identity_error
    return out.select("id", "component", F.lit(n).cast("long").alias("n"),
                      F.col("deviation").cast("decimal(38,0)").alias("deviation"), "whitened", "explained",
                      F.lit(error).alias("identity_error"))
