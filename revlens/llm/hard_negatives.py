"""Hard-negative mining over Hilbert-ordered candidate blocks with zone maps.

Candidates are ordered along a Hilbert curve through the leading axes of a
bounded sample and stored as Parquet rows of one block each, with the block's
labels and, for every dimension, its least and largest component.  The inner
product of an anchor with anything in a block lies between two sums that
interval arithmetic takes from the zone map alone.  A block is read for an
anchor's score window only if its interval meets the window and its labels
allow a hit.

A window asks for its first k rows.  The anchor's own block, full of its
neighbours on the curve, is searched first: k hits there raise the window's
lower end for every other block.  Blocks that are chosen are searched exactly,
in whole numbers, and each gives at most k rows a window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from .common import arrow_map, stash, workers_import
from .vectors import matrix, sample
from .whitening import floors

EVERY, POSITIVES, NEGATIVES = 50, 5, 3
#: A negative scores between these hundredths of its positive's score.
LOW, HIGH = 50, 95
#: Rows of a block, anchors that are searched together, and zone maps that are looked through together.
BLOCK, CHUNK, ZONES = 512, 512, 1024
#: The curve's axes and bits an axis, and the rows of the sample that they are fitted on.
AXES, BITS, FIT_ROWS = 6, 10, 8192
LEAST, MOST = -(1 << 63), (1 << 63) - 1


# -------------------------------------------------------------- Hilbert order

def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of whole numbers in [0, 2**bits).

    Turns each level's sub-cube back into the curve's frame, from the largest
    to the smallest, then reads the bits of all axes level by level as a Gray code.
    """
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for i in range(axes):
            up = (x[i] >> level) & 1 == 1
            swap = np.where(up, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(up, below, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn
    out = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            out = out << 1 | (x[i] >> level) & 1
    return out


@dataclass(frozen=True)
class Curve:
    """Leading axes of a sample and the range of its projections on them."""

    axes: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def place(self, x: np.ndarray) -> np.ndarray:
        share = (x @ self.axes - self.low) / np.maximum(self.high - self.low, 1e-9)
        return hilbert_index(np.clip(share * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64), BITS)


def fit_curve(x: np.ndarray) -> Curve:
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], -1))
    axes = vectors[:, ::-1][:, :AXES]
    at = x @ axes
    return Curve(axes, at.min(axis=0), at.max(axis=0))


# ------------------------------------------------------------ whole-number rows

def pack(x: np.ndarray) -> bytes:
    """Rows of whole numbers in the narrowest of 2, 4 and 8 bytes that holds them."""
    top = int(np.abs(x).max()) if x.size else 0
    return x.astype("<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8").tobytes()


def unpack(data: bytes, rows: int, d: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // (rows * d)}").reshape(rows, d)


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact inner products of whole-number rows; raises where they have no place in 64 bits."""
    largest = (int(np.abs(a.astype(np.float64)).max(initial=0)) + 1) * (int(np.abs(b.astype(np.float64)).max(initial=0)) + 1) * a.shape[1]
    if largest < 1 << 53:  # every sum is a whole number that doubles hold
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if largest < 1 << 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    raise OverflowError("an inner product may not fit in 64 bits")


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest inner product of each row of ``a`` with a vector of each box."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return dot(up, low) + dot(down, high), dot(up, high) + dot(down, low)


# ------------------------------------------------------------ blocks and anchors

def store_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(block, d, ids, labels, x, low, high, kinds): candidates (id, label, x) in Hilbert order, a block a row.

    ``low`` and ``high`` are the zone map, ``kinds`` the block's labels; a block
    has vectors of one length.  Rows that share a place on the curve are dealt
    by id, so copies of one vector fill several blocks and tasks.
    """
    spark, kind = rows.sparkSession, rows.schema["label"].dataType
    rows = stash(rows, "candidates")
    curves = {}
    for r in rows.groupBy(F.size("x").alias("d")).count().collect():  # one row for each length
        curves[r.d] = fit_curve(sample(rows.where(F.size("x") == r.d), "id", "x", FIT_ROWS, r["count"]))
    shipped = spark.sparkContext.broadcast(curves)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).value_lengths().to_numpy()
            for d in np.unique(sizes).tolist():
                mine = batch.filter(pa.array(sizes == d))
                x = matrix(mine.column(2), d).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), d, dtype=np.int32)), pa.array(shipped.value[d].place(x.astype(np.float64))), mine.column(0), mine.column(1),
                     pa.array([pack(v) for v in x], pa.binary())], names=["d", "h", "id", "label", "x"])

    placed = StructType([*spark.createDataFrame([], "d int, h long, id long").schema, StructField("label", kind),
                         *spark.createDataFrame([], "x binary").schema])
    keyed = arrow_map(rows.select("id", "label", "x"), place, placed).withColumn("r", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange("d", "h", "id", "r").sortWithinPartitions("d", "h", "id", "r").drop("h", "r")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = TaskContext.get().partitionId() << 32, None

        def made(part: pa.Table) -> pa.RecordBatch:
            nonlocal name
            d, n = part.column("d")[0].as_py(), part.num_rows
            x = np.stack([unpack(v, 1, d)[0].astype(np.int64) for v in part.column("x").to_pylist()])
            ids, labels = (part.column(c).combine_chunks() for c in ("id", "label"))
            one = pa.array([0, n], pa.int32())
            kinds = labels.unique()
            name += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([name - 1], pa.int64()), pa.array([d], pa.int32()), pa.ListArray.from_arrays(one, ids), pa.ListArray.from_arrays(one, labels),
                 pa.array([pack(x)], pa.binary()), pa.array([x.min(axis=0).astype("<i8").tobytes()], pa.binary()),
                 pa.array([x.max(axis=0).astype("<i8").tobytes()], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(kinds)], pa.int32()), kinds)],
                names=["block", "d", "ids", "labels", "x", "low", "high", "kinds"])

        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            while held.num_rows:
                d = held.column("d").to_numpy()
                same = int(np.searchsorted(d, d[0], side="right"))
                if same < block and same == held.num_rows:
                    break
                yield made(held.slice(0, min(same, block)))
                held = held.slice(min(same, block))
        if held is not None and held.num_rows:
            yield made(held)

    schema = StructType([*spark.createDataFrame([], "block long, d int, ids array<long>").schema, StructField("labels", ArrayType(kind)),
                         *spark.createDataFrame([], "x binary, low binary, high binary").schema, StructField("kinds", ArrayType(kind))])
    return stash(arrow_map(ordered, cut, schema), "blocks")


def store_anchors(blocks: DataFrame, every: int = EVERY, chunk: int = CHUNK) -> DataFrame:
    """(chunk, d, ids, labels, x, blocks, places): anchors of consecutive blocks together, and where each has its own row."""
    kind = blocks.schema["labels"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, size = TaskContext.get().partitionId() << 32, [], 0

        def made() -> pa.RecordBatch:
            nonlocal name
            ids, labels, x, own, at = zip(*held)
            n, d = sum(map(len, ids)), x[0].shape[1]
            one = pa.array([0, n], pa.int32())
            name += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([name - 1], pa.int64()), pa.array([d], pa.int32()), pa.ListArray.from_arrays(one, pa.array(np.concatenate(ids))),
                 pa.ListArray.from_arrays(one, pa.concat_arrays(labels)), pa.array([pack(np.concatenate(x))], pa.binary()),
                 pa.ListArray.from_arrays(one, pa.array(np.repeat(own, list(map(len, ids))), pa.int64())),
                 pa.ListArray.from_arrays(one, pa.array(np.concatenate(at), pa.int32()))],
                names=["chunk", "d", "ids", "labels", "x", "blocks", "places"])

        for batch in batches:
            for i in range(batch.num_rows):
                block, d = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                ids, labels = batch.column(2)[i].values.to_numpy(), batch.column(3)[i].values
                at = np.flatnonzero(ids % every == 0)
                if not len(at):
                    continue
                if held and (size + len(at) > chunk or held[0][2].shape[1] != d):
                    yield made()
                    held, size = [], 0
                held.append((ids[at], labels.take(pa.array(at)), unpack(batch.column(4)[i].as_py(), len(ids), d)[at].astype(np.int64), block, at))
                size += len(at)
        if held:
            yield made()

    spark = blocks.sparkSession
    schema = StructType([*spark.createDataFrame([], "chunk long, d int, ids array<long>").schema, StructField("labels", kind),
                         *spark.createDataFrame([], "x binary, blocks array<long>, places array<int>").schema])
    return stash(arrow_map(blocks.select("block", "d", "ids", "labels", "x"), run, schema), "anchors")


# --------------------------------------------------------------------- windows

_WINDOWS = "array<struct<a:int,w:int,low:long,high:long>>"


def _windows(batch: pa.RecordBatch, name: str, i: int) -> np.ndarray:
    """The windows of a row as whole numbers: anchor, window, low, high."""
    cells = batch.column(name)[i].values
    return np.stack([cells.field(f).to_numpy().astype(np.int64) for f in ("a", "w", "low", "high")], axis=1)


def choose_blocks(asked: DataFrame, blocks: DataFrame, same: bool, zones: int = ZONES) -> DataFrame:
    """(chunk, block, picks): the windows (their numbers in ``windows``) that must read each block.

    ``asked`` are anchors with ``windows``; only zone maps are looked at.  Runs
    of ``zones`` of them meet every chunk of anchors.
    """
    few = blocks.select("block", "d", "low", "high", "kinds")
    runs = max(1, -(-few.count() // zones))
    dealt = few.groupBy(F.pmod(F.xxhash64("block"), F.lit(runs)).cast("int").alias("run")).agg(F.collect_list(F.struct(*few.columns)).alias("zones"))
    met = (asked.select("chunk", F.col("d").alias("of"), "labels", "x", F.size("ids").alias("n"), "windows",
                        F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")).join(dealt, "run"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                d, n = batch.column("of")[i].as_py(), batch.column("n")[i].as_py()
                a, labels, window = unpack(batch.column("x")[i].as_py(), n, d), batch.column("labels")[i].as_py(), _windows(batch, "windows", i)
                zone = [z for z in batch.column("zones")[i].as_py() if z["d"] == d]
                if not zone or not len(window):
                    continue
                low, high = (np.frombuffer(b"".join(z[c] for z in zone), "<i8").reshape(-1, d) for c in ("low", "high"))
                least, most = bounds(a, low, high)
                if same:
                    fits = {k: np.array([k in z["kinds"] for z in zone]) for k in set(labels)}
                else:
                    fits = {k: np.array([z["kinds"] != [k] for z in zone]) for k in set(labels)}
                ok = np.stack([fits[k] for k in labels])
                at = window[:, 0]
                need = ok[at] & (most[at] >= window[:, 2:3]) & (least[at] <= window[:, 3:4])
                some = np.flatnonzero(need.any(axis=0))
                if len(some):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), batch.column("chunk")[i].as_py())), pa.array([zone[z]["block"] for z in some], pa.int64()),
                         pa.array([np.flatnonzero(need[:, z]).astype(np.int32) for z in some], pa.list_(pa.int32()))], names=["chunk", "block", "picks"])

    return arrow_map(met, run, "chunk long, block long, picks array<int>")


def read_blocks(picks: DataFrame, asked: DataFrame, blocks: DataFrame, same: bool, k: int) -> DataFrame:
    """(chunk, a, w, rank, id, score): the first k rows of each window in the blocks that were picked for it."""
    mine = asked.select("chunk", F.col("d").alias("of"), "labels", "x", F.size("ids").alias("n"), "blocks", "places", "windows")
    theirs = blocks.select("block", F.col("ids").alias("b_ids"), F.col("labels").alias("b_labels"), F.col("x").alias("b_x"))
    met = picks.join(theirs, "block").join(mine, "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in ("chunk", "block", "of", "n", "x", "b_x")}
                row = {c: v.as_py() for c, v in row.items()}
                picked = batch.column("picks")[i].values.to_numpy()
                window = _windows(batch, "windows", i)[picked]
                ids = batch.column("b_ids")[i].values.to_numpy()
                code = pd.factorize(np.concatenate([batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("labels", "b_labels")]))[0]
                order = np.argsort(ids, kind="stable")
                anchors, at = np.unique(window[:, 0], return_inverse=True)
                score = dot(unpack(row["x"], row["n"], row["of"])[anchors], unpack(row["b_x"], len(ids), row["of"])[order])
                ok = (code[anchors][:, None] == code[row["n"]:][order][None, :]) == same
                own = np.flatnonzero(batch.column("blocks")[i].values.to_numpy()[anchors] == row["block"])
                ok[own, np.argsort(order)[batch.column("places")[i].values.to_numpy()[anchors[own]]]] = False
                score, ok = score[at], ok[at]
                ok &= (score >= window[:, 2:3]) & (score <= window[:, 3:4])
                score = np.where(ok, score, LEAST)
                if score.shape[1] > k:
                    ok &= score >= np.partition(score, score.shape[1] - k, axis=1)[:, -k][:, None]
                which, place = np.nonzero(ok)
                got = score[which, place]
                best = np.lexsort((place, -got, which))  # a block's rows are in the order of their ids
                which, place, got = which[best], place[best], got[best]
                first = np.searchsorted(which, which)
                keep = np.arange(len(which)) - first < k
                which, place, got = which[keep], place[keep], got[keep]
                if len(which):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(which), row["chunk"])), pa.array(window[which, 0].astype(np.int32)), pa.array(window[which, 1].astype(np.int32)),
                         pa.array(ids[order][place]), pa.array(got)], names=["chunk", "a", "w", "id", "score"])

    found = arrow_map(met, run, "chunk long, a int, w int, id long, score long")
    by = Window.partitionBy("chunk", "a", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def first_in_windows(anchors: DataFrame, windows: DataFrame, blocks: DataFrame, same: bool, k: int) -> DataFrame:
    """(chunk, a, w, rank, id, score): the first k rows, of the anchor's label or of others, within each window.

    ``windows`` has (chunk, a, w, low, high); an anchor may have several.
    """
    def asked(rows: DataFrame) -> DataFrame:  # a chunk has a bounded number of anchors, and these few windows each
        lists = rows.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("a", "w", "low", "high"))).cast(_WINDOWS).alias("windows"))
        return stash(anchors.join(lists, "chunk"), "windows")

    before = asked(windows)
    own = (before.select("chunk", F.posexplode("windows").alias("p", "win"), "blocks")
           .groupBy("chunk", F.get("blocks", F.col("win.a")).alias("block")).agg(F.sort_array(F.collect_list("p")).alias("picks")))
    near = read_blocks(own, before, blocks, same, k).where(F.col("rank") == k).select("chunk", "a", "w", F.col("score").alias("enough"))
    raised = asked(windows.join(near, ["chunk", "a", "w"], "left").withColumn("low", F.greatest("low", "enough")))
    picks = stash(choose_blocks(raised, blocks, same), "picks")
    return read_blocks(picks, raised, blocks, same, k)


def mine(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256, every: int = EVERY,
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of each anchor and positive.

    Scores are inner products of floor(scale * component), in whole numbers.
    Anchors are rows whose key is divisible by ``every``; an anchor's positives
    are its first ``positives`` other rows of the same label, higher scores
    first, ties by smaller key; for each, the first ``negatives`` rows of other
    labels whose score is within ``low`` to ``high`` hundredths of the
    positive's.  Rows with a null key or label, a null or empty vector, or null
    or non-finite components take no part.  Rows of a repeated key are rows of
    their own, each an anchor if the key is one.  Vectors of different lengths
    have no inner product and never meet.  An empty table, or anchors without
    positives or negatives, give no rows.
    """
    spark = df.sparkSession
    workers_import(spark)
    rows = (df.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), floors(vector, scale).alias("x"))
            .where("id is not null and label is not null and x is not null and size(x) > 0"))
    blocks = store_blocks(rows, block)
    anchors = store_anchors(blocks, every)
    each = anchors.select("chunk", F.explode(F.sequence(F.lit(0), F.size("ids") - 1)).alias("a"))
    whole = each.select("chunk", "a", F.lit(0).alias("w"), F.lit(LEAST).cast("long").alias("low"), F.lit(MOST).cast("long").alias("high"))
    near = stash(first_in_windows(anchors, whole, blocks, True, positives).select("chunk", "a", F.col("rank").alias("w"), F.col("id").alias("positive_id"),
                                                                                 F.col("score").alias("positive_score")), "positives")
    rounded_up = F.expr(f"(positive_score * {low} + pmod(-positive_score * {low}, 100)) div 100")
    rounded_down = F.expr(f"(positive_score * {high} - pmod(positive_score * {high}, 100)) div 100")
    windows = near.select("chunk", "a", "w", rounded_up.alias("low"), rounded_down.alias("high")).where("low <= high")
    hard = first_in_windows(anchors, windows, blocks, False, negatives)
    named = anchors.select("chunk", F.posexplode("ids").alias("a", "anchor_id"))
    return (hard.join(near, ["chunk", "a", "w"]).join(named, ["chunk", "a"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
