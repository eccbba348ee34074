"""Approximate nearest neighbours by randomly rotated one-bit codes.

Every vector's offset from the centroid of its cell is rotated by a random
orthogonal matrix and kept as one sign bit a dimension, packed, with two
correction scalars: the offset's length and its inner product with the code.
The inner product of a query with a vector is estimated from the bits, with a
bound of the error that holds with high probability.  Only vectors whose upper
bound reaches the k-th best lower bound are reranked on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, stash, workers_import
from .vectors import k_means, lengths, matrix, sample, usable

K, EVERY = 20, 20
CELLS, FIT_ROWS = 16, 8192
BLOCK, QUERY_BLOCK = 4096, 1024
#: The error bound in standard deviations; few estimates in a hundred thousand lie outside.
EPSILON = 4.5


@dataclass(frozen=True)
class Codes:
    """The fitted part of the index: cell centroids and the rotation, whatever the number of rows."""

    centroids: np.ndarray
    rotation: np.ndarray

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(cell, packed bits, offset length, inner product of code and unit offset) of each row."""
        c = self.centroids
        cell = np.argmin((c**2).sum(axis=1) - 2 * x @ c.T, axis=1)
        offset = (x - c[cell]) @ self.rotation.T
        length = np.linalg.norm(offset, axis=1)
        unit = offset / np.maximum(length, 1e-300)[:, None]
        align = np.abs(unit).sum(axis=1) / np.sqrt(x.shape[1])
        return cell, np.packbits(offset > 0, axis=1), length, align

    def estimate(self, q: np.ndarray, cell: int, bits: np.ndarray, length: np.ndarray, align: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products (queries, vectors) with vectors of one cell, and their error bounds."""
        d = q.shape[1]
        signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1
        turned = q @ self.rotation.T
        safe = np.maximum(align, 1e-9)
        part = (turned.astype(np.float32) @ signs.T) / np.sqrt(d) * (length / safe)
        spread = length * np.sqrt(np.maximum(1 - safe**2, 0)) / safe / np.sqrt(max(d - 1, 1))
        size = np.linalg.norm(q, axis=1)
        return part + (q @ self.centroids[cell])[:, None], EPSILON * size[:, None] * spread[None, :] + 1e-5 * size[:, None] * (length + 1)


def fit(x: np.ndarray, cells: int = CELLS, seed: int = 11) -> Codes:
    d = x.shape[1]
    rotation, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return Codes(k_means(x, cells), rotation * np.sign(np.diag(r)))


def usable_rows(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): the rows that take part."""
    return df.select(F.col(key).alias("id"), F.col(vector).alias("v")).where(usable("v") & F.col("id").isNotNull())


def build_index(rows: DataFrame, d: int, cells: int = CELLS, fit_rows: int = FIT_ROWS) -> tuple[Codes, DataFrame]:
    """The fitted codes and (id, x, cell, bits, length, align) of every row (id, v) with ``d`` components.

    Fits on about ``fit_rows`` rows; indexes all.
    """
    rows = rows.where(F.size("v") == d)
    codes = fit(sample(rows, "id", "v", fit_rows, rows.count()), cells)
    shipped = rows.sparkSession.sparkContext.broadcast(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), d)
            cell, bits, length, align = shipped.value.encode(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(cell.astype(np.int32)),
                 pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(length), pa.array(align)],
                names=["id", "x", "cell", "bits", "length", "align"])

    kind = rows.schema["id"].dataType.simpleString()
    return codes, stash(arrow_map(rows, run, f"id {kind}, x binary, cell int, bits binary, length double, align double"), "codes")


def nearest(codes: Codes, q: np.ndarray, q_id: np.ndarray, block: pd.DataFrame, k: int) -> pd.DataFrame:
    """(query_id, vec_id, score): each query's k best of a block of vectors of one cell, itself left out."""
    d = q.shape[1]
    bits = np.frombuffer(b"".join(block["bits"]), np.uint8).reshape(len(block), -1)
    est, err = codes.estimate(q, int(block["cell"].iloc[0]), bits, block["length"].to_numpy(), block["align"].to_numpy())
    ids = block["id"].to_numpy()
    x = np.frombuffer(b"".join(block["x"]), np.float64).reshape(len(block), d)
    own = q_id[:, None] == ids[None, :]
    low = np.where(own, -np.inf, est - err)
    high = np.where(own, -np.inf, est + err)
    n = low.shape[1]
    least = np.partition(low, n - k, axis=1)[:, n - k] if n > k else np.full(len(q), -np.inf)
    out = []
    for i in range(len(q)):
        near = np.flatnonzero((high[i] >= least[i]) & ~own[i])
        score = (x[near] * q[i]).sum(axis=1)
        best = np.lexsort((ids[near], -score))[:k]
        out.append((np.full(len(best), q_id[i]), ids[near][best], score[best]))
    return pd.DataFrame({"query_id": np.concatenate([o[0] for o in out]), "vec_id": np.concatenate([o[1] for o in out]),
                         "score": np.concatenate([o[2] for o in out])})


def search(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, every: int = EVERY, cells: int = CELLS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by inner product of each row whose key is divisible by ``every``.

    Queries and cells are cut into blocks, and every block of queries meets
    every block of every cell in a task of its own; a task gives at most k rows
    a query.  Null keys and unusable vectors take no part; repeated keys are
    one vector's own rows and never neighbours of each other.  Ties go to the
    smaller key.  Each length of vectors has an index of its own, since only
    vectors of one length have an inner product.  Without usable rows the
    result is empty.
    """
    rows = usable_rows(df, key, vector)
    found = [_search(rows, d, k, every, cells) for d in lengths(rows, "v")]
    if not found:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found)


def _search(rows: DataFrame, d: int, k: int, every: int, cells: int) -> DataFrame:
    """``search`` among the rows with ``d`` components."""
    spark = rows.sparkSession
    codes, index = build_index(rows, d, cells)
    sizes = {r["cell"]: r["count"] for r in index.groupBy("cell").count().collect()}  # one row for each cell
    asked = index.where(F.col("id") % every == 0)
    parts = max(1, -(-asked.count() // QUERY_BLOCK))
    blocks = {c: -(-n // BLOCK) for c, n in sizes.items()}
    every_block = F.array(*[F.struct(F.lit(c).alias("cell"), F.lit(n).alias("n")) for c, n in sorted(blocks.items())])
    queries = (asked.select(F.col("id").alias("q_id"), F.col("x").alias("q"), F.explode(every_block).alias("c"))
               .select(F.col("c.cell").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("c.n") - 1)).alias("i"),
                       F.pmod(F.xxhash64("q_id", F.lit("q")), F.lit(parts)).cast("int").alias("j"), "q_id", "q"))
    count = F.create_map(*[F.lit(x) for c, n in sorted(blocks.items()) for x in (c, n)])[F.col("cell")]
    vectors = (index.withColumn("i", F.pmod(F.xxhash64("id", F.lit("v")), count).cast("int"))
               .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    shipped = spark.sparkContext.broadcast(codes)

    def block(asking: pd.DataFrame, to: pd.DataFrame) -> pd.DataFrame:
        if asking.empty or to.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        q = np.frombuffer(b"".join(asking["q"]), np.float64).reshape(len(asking), -1)
        return nearest(shipped.value, q, asking["q_id"].to_numpy(), to, k)

    workers_import(spark)
    found = (queries.groupBy("cell", "i", "j").cogroup(vectors.groupBy("cell", "i", "j"))
             .applyInPandas(block, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
