"""Helpers for tables of vectors: which rows take part, and a small k-means on a bounded sample."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """True for vectors without null or non-finite components that aren't zero or empty."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0), F.lit(False))


def lengths(df: DataFrame, vector: str) -> list[int]:
    """The numbers of components that occur; vectors of different lengths have no inner product and never meet."""
    return sorted(r.d for r in df.select(F.size(vector).alias("d")).distinct().collect())  # one row for each length


def sample(df: DataFrame, key: str, vector: str, rows: int, total: int) -> np.ndarray:
    """About ``rows`` of ``total`` vectors at most, chosen by a hash of the key, for fitting an index."""
    share = min(1.0, rows / max(1, total))
    draw = F.xxhash64(F.col(key), F.lit("fit")).bitwiseAND(F.lit((1 << 30) - 1)) / float(1 << 30)
    got = df.where(draw < share).select(key, vector).limit(2 * rows).collect()
    return np.array([r[1] for r in sorted(got, key=lambda r: r[0])], dtype=np.float64)


def k_means(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Up to ``k`` centroids of the rows of ``x``."""
    x = np.unique(x, axis=0)
    k = min(k, len(x))
    centroids = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.argmin((centroids**2).sum(axis=1) - 2 * x @ centroids.T, axis=1)
        for c in range(k):
            if (near == c).any():
                centroids[c] = x[near == c].mean(axis=0)
    return centroids


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """A list column without nulls, each of ``d`` components, as float64 rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), d)
