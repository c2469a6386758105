"""Whitening of embeddings by a block Jacobi-Davidson method.

The covariance matrix is never formed.  What the method needs of it are its products with a block of a few vectors; each is one pass over the
table: tasks centre their rows, multiply, and send one small block; Spark adds the blocks.  On the driver are matrices of the vectors' length
times a few dozen columns.

* Rayleigh-Ritz: the search space's projected matrix gives the Ritz pairs of all components at once.
* Pairs whose residual reaches double precision are locked and leave the search space.
* Each other pair's projected correction equation is solved inexactly by a few steps of MINRES, all of them side by side, so a step is one
  pass for all pairs.  The corrections extend the search space; a space that grows too large is restarted from its best Ritz vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stage

COMPONENTS = 32
#: Fixed values of the integer coordinates: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Steps of MINRES for a correction; columns of the search space for each wanted component; largest residual against the largest eigenvalue.
INNER, SPACE, TOLERANCE, ROUNDS, SEED = 4, 4, 1e-13, 100, 29
#: Components below this share of the largest eigenvalue have no direction of their own and are left out.
LEAST_SHARE = 1e-10


@dataclass
class Whitening:
    """A fitted model; ``vectors`` has a unit column for each component."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float
    residual: float


def usable(vector: Column) -> Column:
    """Whether a vector has entries, all of them numbers."""
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))


def coordinates(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, x)`` of the usable vectors, staged."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("c")).where(usable(F.col("c")))
    return stage(rows.select("id", F.transform("c", lambda c: F.floor(SCALE * c).cast("long") + SHIFT).alias("x")), "coordinates")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _added(rows: DataFrame, shape: tuple[int, ...], part: Callable[[np.ndarray], np.ndarray], start: np.dtype) -> np.ndarray:
    """Sum over all rows of ``part`` of each batch's coordinates, an array of ``shape``.  A task sends one array; Spark adds them by cell."""
    kind = "long" if np.issubdtype(start, np.integer) else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, start)
        for batch in batches:
            if batch.num_rows:
                total += part(_matrix(batch.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "v"])

    out = np.zeros(shape, start).ravel()
    for r in rows.select("x").mapInArrow(run, f"cell long, v {kind}").groupBy("cell").agg(F.sum("v").alias("v")).collect():
        out[r["cell"]] = r["v"]
    return out.reshape(shape)


def minres(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of ``product(t) = right`` for the columns of ``right``, with one symmetric operator for each column, side by
    side.  A column that is solved exactly stands still."""
    eps = np.finfo(float).eps
    beta = np.linalg.norm(right, axis=0)
    live, x = beta > 0, np.zeros_like(right)
    w, w2, r1, r2, y = np.zeros_like(right), np.zeros_like(right), right.copy(), right.copy(), right.copy()
    least = eps * beta
    oldb, dbar, epsln, phibar = np.zeros_like(beta), np.zeros_like(beta), np.zeros_like(beta), beta.copy()
    cs, sn = -np.ones_like(beta), np.zeros_like(beta)
    for step in range(steps):
        live &= beta > least
        if not live.any():
            break
        safe = np.where(live, beta, 1.0)
        v = np.where(live, y / safe, 0.0)
        y = product(v)
        if step:
            y = y - (beta / np.where(live, oldb, 1.0)) * r1
        alfa = (v * y).sum(axis=0)
        y = y - (alfa / safe) * r2
        r1, r2, oldb, beta = r2, y, beta, np.linalg.norm(y, axis=0)
        oldeps, delta = epsln, cs * dbar + sn * alfa
        gbar, epsln, dbar = sn * dbar - cs * alfa, sn * beta, -cs * beta
        gamma = np.maximum(np.hypot(gbar, beta), eps)
        cs, sn = gbar / gamma, beta / gamma
        phi, phibar = cs * phibar, sn * phibar
        w1, w2 = w2, w
        w = (v - oldeps * w1 - delta * w2) / gamma
        x = x + np.where(live, phi * w, 0.0)
    return x


def _orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal base of what ``block`` adds to the orthonormal columns of ``against``."""
    size = np.linalg.norm(block, axis=0)
    block = block[:, size > 0] / size[size > 0]
    for _ in range(2):
        for base in against:
            block = block - base @ (base.T @ block)
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    base = u[:, s > 1e-10]
    for other in against:
        base = base - other @ (other.T @ base)
    return np.linalg.qr(base)[0]


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, inner: int = INNER, space: int = SPACE,
                    tolerance: float = TOLERANCE, rounds: int = ROUNDS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest ``wanted`` eigenvalues, falling, their unit vectors as columns, and the largest residual against the largest eigenvalue,
    of the symmetric matrix that ``product`` multiplies blocks of columns with."""
    wanted = min(wanted, dim)
    most = max(space * wanted, wanted + 1)
    v = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, wanted)))[0]
    av = product(v)
    locked, values, worst = np.zeros((dim, 0)), np.zeros(0), 0.0
    for _ in range(rounds):
        h = v.T @ av
        ritz, s = np.linalg.eigh((h + h.T) / 2)
        ritz, s = ritz[::-1], s[:, ::-1]
        v, av = v @ s, av @ s
        r = av - v * ritz
        r = r - locked @ (locked.T @ r)
        scale = max([*values, *np.abs(ritz), np.finfo(float).tiny])
        size = np.linalg.norm(r, axis=0) / scale
        # Pairs that may be wanted: those above the least of the best ones found so far.
        ahead = np.arange(len(ritz)) + np.searchsorted(np.sort(-values), -ritz) < wanted
        spans_all = locked.shape[1] + v.shape[1] == dim
        lock = ahead & ((size <= tolerance) | spans_all & (size <= 100 * tolerance))
        worst = max([worst, *size[lock]])
        locked, values = np.hstack([locked, v[:, lock]]), np.concatenate([values, ritz[lock]])
        open_ = ahead & ~lock
        v, av, ritz, r, todo = v[:, ~lock], av[:, ~lock], ritz[~lock], r[:, ~lock], open_[~lock]
        if len(values) >= wanted and not todo.any():
            best = np.argsort(-values, kind="stable")[:wanted]
            return values[best], locked[:, best], worst
        theta, base = ritz[todo], np.hstack([locked, v[:, todo]])

        def project(t: np.ndarray) -> np.ndarray:
            return t - base @ (base.T @ t)

        t = minres(lambda t: project(product(project(t)) - project(t) * theta), -project(r[:, todo]), inner) if todo.any() else r[:, :0]
        if v.shape[1] + t.shape[1] > most:
            keep = max(wanted, int(todo.sum()))
            v, av = v[:, :keep], av[:, :keep]
        t = _orthonormal(t, locked, v)
        if not t.shape[1] and not spans_all:          # the corrections add nothing: go on in a fresh direction
            t = _orthonormal(np.random.default_rng(seed + v.shape[1] + 1).normal(size=(dim, 1)), locked, v)
        if t.shape[1]:
            v, av = np.hstack([v, t]), np.hstack([av, product(t)])
        else:
            av = product(v)
    raise ArithmeticError(f"not all residuals reached {tolerance} in {rounds} rounds")


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The model of ``(id, x)`` rows; None without rows.  All vectors must have one length."""
    n, dim, longest = rows.agg(F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))).first()
    if not n:
        return None
    if dim != longest:
        raise ValueError(f"vectors of {dim} and of {longest} entries in one table")
    sums = _added(rows, (dim,), lambda x: x.sum(axis=0), np.dtype(np.int64))

    def centred(x: np.ndarray) -> np.ndarray:
        return (n * x - sums) / n

    def product(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return c.T @ (c @ block)
        return _added(rows, block.shape, part, np.dtype(float)) / n

    trace = float(_added(rows, (dim,), lambda x: np.square(centred(x)).sum(axis=0), np.dtype(float)).sum()) / n
    if trace == 0:
        return Whitening(n, sums, np.zeros(0), np.zeros((dim, 0)), np.zeros(0), 0.0, 0.0)
    values, vectors, residual = jacobi_davidson(product, dim, components)
    good = values > LEAST_SHARE * values[0]
    values, vectors = values[good], vectors[:, good]
    scaled = vectors / np.sqrt(values)
    k = len(values)

    def moments(x: np.ndarray) -> np.ndarray:
        z = centred(x) @ scaled
        return np.vstack([z.T @ z, z.sum(axis=0)])

    m = _added(rows, (k + 1, k), moments, np.dtype(float)) / n
    error = float(np.abs(m[:k] - np.outer(m[k], m[k]) - np.eye(k)).max())
    return Whitening(n, sums, values, vectors, values / trace, error, residual)


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """``(id, deviation, whitened)`` of ``(id, x)`` rows: the exact sum over dimensions of ``(n * x - sums) ** 2`` as decimal, and the whitened
    vector, an entry for each component."""
    n, sums, scaled = model.n, model.sums, model.vectors / np.sqrt(model.values)
    kind, id_type = pa.decimal128(38, 0), rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            off = n * _matrix(batch.column(1)) - sums
            if float(np.abs(off).max()) ** 2 * off.shape[1] < 2 ** 62:
                deviation = pa.array(np.square(off).sum(axis=1)).cast(kind)
            else:
                deviation = pa.array([sum(int(v) ** 2 for v in row) for row in off], kind)
            z = (off / n) @ scaled
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, lists], ["id", "deviation", "whitened"])

    return rows.select("id", "x").mapInArrow(run, f"id {id_type}, deviation decimal(38,0), whitened array<double>")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """``(id, deviation, whitened)`` of the usable vectors, and the model fitted on all of them.

    Vectors that are null or empty, or hold null or non-finite entries, are left out; repeated rows and null ids stay and count.  Entries times 64
    must fit 64 bits.  There are fewer components than asked for where vectors are shorter or vary in fewer directions, none if all are equal;
    components of equal eigenvalues are any base of their space.  No usable vector: an empty table and no model."""
    rows = coordinates(vectors, id_col, vector_col)
    model = fit(rows, components)
    if model is None:
        return rows.select("id", F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")), None
    return transform(rows, model), model
