"""Whitening of embeddings by their leading principal components, found by Jacobi-Davidson.

The covariance is never formed.  The fit list, each distinct vector of whole
numbers once, is stored as blocks of rows; a product of the covariance with a
few directions is one pass over them, in which every task centres its rows,
multiplies and adds up, and the partial sums are added by a shuffle.  The
driver has only vectors of the dimensions' length: the search space, on which
Rayleigh-Ritz gives the approximate pairs, and the pairs that are locked.
Each step solves the projected correction equations of all open pairs at once
by MINRES, so that one pass serves them all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stash, workers_import
from .vectors import matrix

COMPONENTS, SCALE = 4, 256
#: Rows of a stored block of the fit list.
BLOCK = 8192
#: Pairs that the search follows beyond those wanted, MINRES steps a correction, and the widest search space.
GUARD, INNER, WIDEST = 4, 4, 64
MOST_STEPS = 200
EPS = float(np.finfo(np.float64).eps)


def floors(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * c) of each component, as whole numbers; null for a null vector or one with null or non-finite entries.

    A component whose floor has no place in 64 bits raises.
    """
    v = F.col(vector)
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(v.isNotNull() & ~odd, F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long")))


# ------------------------------------------------------- products over blocks

def store_blocks(distinct: DataFrame, d: int) -> DataFrame:
    """(rows, x): the fit list's vectors in blocks of at most ``BLOCK`` rows, as packed doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(matrix(batch.column(0), d))
            n += len(held[-1])
            if n >= BLOCK:
                yield packed(held, n)
                held, n = [], 0
        if n:
            yield packed(held, n)

    def packed(held: list[np.ndarray], n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()),
                                           pa.array([np.concatenate(held).tobytes()], pa.binary())], names=["rows", "x"])

    return stash(arrow_map(distinct, run, "rows long, x binary"), "fit-blocks")


class Products:
    """Passes over the blocks of a fit list with ``d`` dimensions, centred on ``mean``."""

    def __init__(self, blocks: DataFrame, n: int, mean: np.ndarray):
        self.blocks, self.n, self.mean, self.passes = blocks, n, mean, 0

    def _added(self, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """The sum of ``part`` of the centred rows of every block: one row a task, then one a cell of the result."""
        mean, d = self.mean, len(self.mean)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                for data in batch.column(0).to_pylist():
                    total += part(np.frombuffer(data, np.float64).reshape(-1, d) - mean)
            flat = total.reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int64()), pa.array(flat)], names=["i", "s"])

        self.passes += 1
        sums = arrow_map(self.blocks.select("x"), run, "i long, s double").groupBy("i").agg(F.sum("s").alias("s"))
        out = np.zeros(int(np.prod(shape)))
        for row in sums.collect():  # as many rows as the result has cells
            out[row.i] = row.s
        return out.reshape(shape)

    def covariance_times(self, u: np.ndarray) -> np.ndarray:
        """V u for a few columns: centred rows times u, times the centred rows, over n."""
        return self._added(lambda x: x.T @ (x @ u), u.shape) / self.n

    def trace(self) -> float:
        return float(self._added(lambda x: (x * x).sum(), ())) / self.n

    def projected_covariance(self, u: np.ndarray) -> np.ndarray:
        """The covariance of the centred rows' images under ``u``, whose mean is taken off first."""
        own = self._added(lambda x: (x @ u).sum(axis=0), (u.shape[1],)) / self.n
        return self._added(lambda x: (x @ u - own).T @ (x @ u - own), (u.shape[1],) * 2) / self.n


# ------------------------------------------------------------ Jacobi-Davidson

def orthonormal(t: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """The columns of ``t`` made orthonormal to each other and to ``against``; those without a part of their own go."""
    out = []
    for column in t.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        column = column / size
        for _ in range(3):
            for other in (*against, *(x[:, None] for x in out)):
                column = column - other @ (other.T @ column)
            size = np.linalg.norm(column)
            if size < 1e-8:
                break
            column = column / size
        else:
            out.append(column)
    return np.array(out).T.reshape(len(t), -1)


def corrections(product: Callable[[np.ndarray], np.ndarray], value: np.ndarray, away: list[np.ndarray], residual: np.ndarray, steps: int) -> np.ndarray:
    """MINRES for (I-QQ')(V-value I)(I-QQ') t = -residual, one system a column, in step: each step is one product."""
    k = residual.shape[1]

    def clear(x: np.ndarray) -> np.ndarray:
        return np.stack([x[:, i] - away[i] @ (away[i].T @ x[:, i]) for i in range(k)], axis=1)

    r = clear(-residual)
    beta = np.linalg.norm(r, axis=0)
    start = np.maximum(beta, 1e-300)
    live = beta > 0
    v, before = r / start, np.zeros_like(r)
    t, w, w_before = np.zeros_like(r), np.zeros_like(r), np.zeros_like(r)
    c, s, c_before, s_before = np.ones(k), np.zeros(k), np.ones(k), np.zeros(k)
    eta, last = beta.copy(), np.zeros(k)
    for _ in range(steps):
        if not live.any():
            break
        p = clear(product(v) - v * value)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - last * before
        beta = np.linalg.norm(p, axis=0)
        # the QR step of the tridiagonal matrix, by two rotations
        low = s_before * last
        mid = c * c_before * last + s * alpha
        diagonal = c * alpha - s * c_before * last
        size = np.maximum(np.hypot(diagonal, beta), 1e-300)
        c_new, s_new = diagonal / size, beta / size
        w_new = (v - low * w_before - mid * w) / size
        t = t + np.where(live, c_new * eta, 0) * w_new
        eta = -s_new * eta
        w_before, w = w, w_new
        c_before, s_before, c, s = c, s, c_new, s_new
        before, last = v, beta
        live = live & (beta > 1e-14 * start) & (np.abs(eta) > 1e-3 * start)
        v = np.where(live, p / np.maximum(beta, 1e-300), 0)
    return clear(t)


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, guard: int = GUARD, inner: int = INNER,
                  widest: int = WIDEST, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of the ``k`` largest pairs of the symmetric map ``product``.

    A pair is locked when its residual is at the rounding of double precision
    next to the largest eigenvalue.  Raises if ``MOST_STEPS`` don't get there.
    """
    k = min(k, d)
    block = min(d, k + guard)
    widest = min(d, max(widest, 3 * block))
    locked, values = np.zeros((d, 0)), []
    basis = orthonormal(np.random.default_rng(seed).standard_normal((d, block)))
    image = product(basis)
    least, stalled = np.inf, 0
    for _ in range(MOST_STEPS):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        scale = max([abs(float(theta[0])), *map(abs, values)])
        while len(values) < k and basis.shape[1]:
            r = image[:, 0] - theta[0] * basis[:, 0]
            r = r - locked @ (locked.T @ r)
            size = float(np.linalg.norm(r))
            whole = basis.shape[1] + len(values) == d  # nothing is left to search
            if size > 16 * EPS * np.sqrt(d) * scale and not whole and not (stalled >= 3 and size < 1e-11 * scale):
                break
            locked = np.concatenate([locked, basis[:, :1]], axis=1)
            values.append(float(theta[0]))
            basis, image, theta = basis[:, 1:], image[:, 1:], theta[1:]
            least, stalled = np.inf, 0
        if len(values) == k:
            order = np.argsort(-np.array(values), kind="stable")
            return np.array(values)[order], locked[:, order]
        stalled = stalled + 1 if size > 0.5 * least else 0  # rounding sets in before the bound does
        least = min(least, size)
        if basis.shape[1] + block > widest and basis.shape[1] + len(values) < d and basis.shape[1] > 2 * block:
            basis, image, theta = basis[:, :2 * block], image[:, :2 * block], theta[:2 * block]
        m = min(block, basis.shape[1])
        residual = image[:, :m] - basis[:, :m] * theta[:m]
        away = [np.concatenate([locked, basis[:, i:i + 1]], axis=1) for i in range(m)]
        t = corrections(product, theta[:m], away, residual, inner)
        new = orthonormal(t, locked, basis)
        if not new.shape[1]:  # corrections within the space: go on from elsewhere
            new = orthonormal(np.random.default_rng(len(values) + stalled).standard_normal((d, block)), locked, basis)
        basis, image = np.concatenate([basis, new], axis=1), np.concatenate([image, product(new)], axis=1)
    raise ArithmeticError(f"{len(values)} of {k} pairs converged")


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening of vectors with ``d`` dimensions."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def turn(self) -> np.ndarray:
        """The matrix that takes a centred vector to its whitened components; 0 for those without variance."""
        ok = self.values > self.values[:1] * 1e-13 if len(self.values) else np.zeros(0, bool)
        return np.where(ok, self.vectors / np.sqrt(np.where(ok, self.values, 1)), 0)


def fit(rows: DataFrame, vector: str, d: int, components: int = COMPONENTS) -> Whitening:
    """Fits on each distinct vector of ``rows``, all of ``d`` whole numbers, once."""
    distinct = rows.select(vector).distinct()
    blocks = store_blocks(distinct, d)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                x = np.frombuffer(data, np.float64).reshape(-1, d)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int64()), pa.array(x.astype(np.int64).sum(axis=0))], names=["i", "s"])

    n = blocks.agg(F.sum("rows")).first()[0]
    got = {r.i: int(r.s) for r in arrow_map(blocks.select("x"), totals, "i long, s long").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    sums = [got[i] for i in range(d)]
    products = Products(blocks, n, np.array([s / n for s in sums]))
    trace = products.trace()
    if not trace > 0:  # one distinct vector: no variance in any direction
        k = min(components, d)
        return Whitening(n, sums, np.zeros(k), np.eye(d)[:, :k], 0.0, 0.0)
    values, vectors = leading_pairs(products.covariance_times, d, components)
    values = np.maximum(values, 0)
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    made = Whitening(n, sums, values, vectors, trace, 0.0)
    some = made.turn[:, np.any(made.turn != 0, axis=0)]
    error = float(np.abs(products.projected_covariance(some) - np.eye(some.shape[1])).max()) if some.shape[1] else 0.0
    return Whitening(n, sums, values, vectors, trace, error)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of each row and leading component.

    Rows with a null vector, or null or non-finite entries, are left out, and
    so are empty vectors, which have no component.  Vectors of another length
    are another space: each length is fitted on its own.  Null and repeated
    keys are rows like any others; equal vectors count once in the fit.  A
    component without variance (fewer independent vectors than components) is
    whitened to 0 and explains 0.  Equal eigenvalues leave the choice of their
    directions open.  An empty table gives no rows.  A deviation beyond 64 bits
    raises.
    """
    spark = df.sparkSession
    workers_import(spark)
    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = stash(df.select(F.col(key).alias("key"), floors(vector, scale).alias("x")).where("x is not null and size(x) > 0"), "floors")
    out = None
    for d in sorted(r.d for r in rows.groupBy(F.size("x").alias("d")).count().collect()):  # one row for each length
        mine = rows.where(F.size("x") == d)
        made = fit(mine, "x", d, components)
        part = apply(mine, made, schema)
        out = part if out is None else out.unionByName(part)
    return (out if out is not None else spark.createDataFrame([], schema)).withColumnRenamed("key", key)


def apply(rows: DataFrame, made: Whitening, schema: str) -> DataFrame:
    """The components of each of ``rows`` (key, x)."""
    n, sums = made.n, made.sums
    mean, turn, share = made.mean, made.turn, np.where(made.turn.any(axis=0), made.values / (made.trace or 1), 0)
    d, k, error = len(sums), len(made.values), made.identity_error
    off = F.zip_with("x", F.array(*[F.lit(s) for s in sums]).cast("array<bigint>"), lambda x, s: F.lit(n).cast("long") * x - s)
    exact = rows.select("key", "x", F.aggregate(off, F.lit(0).cast("long"), lambda t, y: t + y * y).alias("deviation"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            white = (matrix(batch.column(1), d) - mean) @ turn
            at = pa.array(np.repeat(np.arange(batch.num_rows), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                 pa.array(np.full(len(at), n, dtype=np.int64)), batch.column(2).take(at), pa.array(white.reshape(-1)),
                 pa.array(np.tile(share, batch.num_rows)), pa.array(np.full(len(at), error))],
                names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return arrow_map(exact, run, schema)
