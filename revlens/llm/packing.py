"""Best-fit packing of tokenised documents into sequences, improved by swaps.

Documents are tokenised where they are read, and each piece keeps its ids.
The task that tokenises packs every full group of pieces on the spot, so their
ids never move; only a task's last pieces, too few for a group, are dealt to
groups of that size with those of other tasks.  Each group is packed on its
own: best fit by falling length, then a local search that takes the least
filled bins one by one and moves their pieces out: a piece into a gap, a piece
for a smaller one, a piece for two smaller ones of one bin, or two pieces for
one.  Each step raises the sum of squared fills, so it ends; a bin that comes
out empty is a sequence saved.  The search looks at pairs of pieces up to three
places apart in their bin, and gives away two of its own only out of the first
eight: more pairs gain little, and no piece is left out of the packing.  A group wastes at most about one bin more than
one packing of everything would, so with some thousand pieces a group the loss
is a fraction of a percent, whatever the size of the corpus.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stash, workers_import
from .token_cache import encoded_rows, encoder

CAPACITY, END_ID = 1024, 2
GROUP = 4096


def token_pieces(df: DataFrame, key: str, text: str, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 group: int = GROUP) -> DataFrame:
    """(key, piece, start, length, ids, turn, sequence_id, offset): each document's ids and the end id, cut into pieces of at most ``capacity``.

    ``ids`` are little-endian unsigned 32-bit integers.  Only the first piece of a longer document may be shorter.  A null text
    reads as '': its one piece is the end id.  ``turn`` counts a task's pieces.  Full groups have their places; a task's last
    pieces, fewer than ``group``, have none.
    """
    kind = df.schema[key].dataType
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, name = [], 0, (TaskContext.get().partitionId() + 1) << 40
        for batch in cut(batches):
            held.append(batch)
            rows += batch.num_rows
            while rows >= group:
                whole = pa.Table.from_batches(held).combine_chunks()
                first = whole.slice(0, group)
                bins, offset = pack(first.column("length").to_numpy(), capacity)
                yield placed(first, pa.array(bins + name), pa.array(offset))
                name, rows = name + group, rows - group
                held = whole.slice(group).to_batches()
        for batch in held:
            none = pa.nulls(batch.num_rows, pa.int64())
            yield placed(pa.Table.from_batches([batch]), none, none)

    def placed(pieces: pa.Table, sequence: pa.Array, offset: pa.Array) -> pa.RecordBatch:
        pieces = pieces.append_column("sequence_id", sequence).append_column("offset", offset)
        return pieces.combine_chunks().to_batches()[0]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId() * 7919
        for keys, coded in encoded_rows(batches, encoder(tokenizer)):
            who, cols = [], []
            for i, ids in enumerate(coded):
                ids += end
                n = len(ids) // 4
                at, piece = 0, 0
                while at < n:
                    size = (n - 1) % capacity + 1 if piece == 0 else capacity
                    who.append(i)
                    cols.append((piece, at, size, ids[4 * at:4 * (at + size)], turn))
                    at, piece, turn = at + size, piece + 1, turn + 1
            if cols:
                piece, start, size, part_ids, turns = zip(*cols)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(who, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(part_ids, pa.binary()), pa.array(turns, pa.int64())],
                    names=["key", "piece", "start", "length", "ids", "turn"])

    return arrow_map(df.select(F.col(key).alias("key"), F.col(text).alias("text")), run,
                     f"key {kind.simpleString()}, piece int, start long, length long, ids binary, turn long, sequence_id long, offset long")


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each piece: pieces by falling length, each into the fullest bin that has room."""
    out = np.zeros(len(lengths), dtype=np.int64)
    gaps: list[tuple[int, int]] = []  # (room, bin), sorted
    bins = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        at = bisect_left(gaps, (size, -1))
        if at < len(gaps):
            room, b = gaps.pop(at)
        else:
            room, b, bins = capacity, bins, bins + 1
        out[i] = b
        if room > size:
            insort(gaps, (room - size, b))
    return out


def swap_search(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Improves a packing by steps that raise the sum of squared fills until no underfull bin can be emptied.

    Every step moves length from the bin being emptied to one at least as full.
    """
    bins = bins.copy()
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    least = -(-int(lengths.sum()) // capacity)
    for source in np.argsort(fill, kind="stable").tolist():
        if np.count_nonzero(fill) <= least:
            break
        while 0 < fill[source] < capacity:
            step = _step(lengths, bins, fill, source, capacity)
            if step is None:
                break
            for i, to in step:
                fill[bins[i]] -= lengths[i]
                fill[to] += lengths[i]
                bins[i] = to
    return np.unique(bins, return_inverse=True)[1].reshape(-1)


def _step(lengths, bins, fill, source, capacity):
    """The moves [(piece, bin)] of the step that fills another underfull bin best, or None."""
    mine = np.flatnonzero(bins == source)
    room = capacity - fill
    room[source] = 0
    room[fill < fill[source]] = 0
    room[fill == 0] = 0
    open_ = np.flatnonzero(room > 0)
    if not len(open_):
        return None
    best, moves = None, None

    def offer(gain, left, found):
        nonlocal best, moves
        score = (left, -gain)  # closest to full, then the most moved
        if best is None or score < best:
            best, moves = score, found

    for i in mine.tolist():  # a piece into a gap
        fits = open_[room[open_] >= lengths[i]]
        if len(fits):
            to = fits[np.argmin(room[fits])]
            offer(int(lengths[i]), int(room[to] - lengths[i]), [(i, int(to))])
    if best is not None:
        return moves
    others = np.flatnonzero(room[bins] > 0)
    theirs, left = lengths[others], room[bins[others]]
    for i in mine.tolist():  # a piece for a smaller one
        gain = lengths[i] - theirs
        ok = np.flatnonzero((gain > 0) & (gain <= left))
        if len(ok):
            at = ok[np.argmin(left[ok] - gain[ok])]
            offer(int(gain[at]), int(left[at] - gain[at]), [(i, int(bins[others[at]])), (int(others[at]), source)])
    order = others[np.argsort(bins[others], kind="stable")]
    for apart in (1, 2, 3):  # a piece for two smaller ones of one bin
        a, b = order[:-apart], order[apart:]
        same = bins[a] == bins[b]
        a, b = a[same], b[same]
        if not len(a):
            break
        pair, free = lengths[a] + lengths[b], room[bins[a]]
        for i in mine.tolist():
            gain = lengths[i] - pair
            ok = np.flatnonzero((gain > 0) & (gain <= free))
            if len(ok):
                at = ok[np.argmin(free[ok] - gain[ok])]
                offer(int(gain[at]), int(free[at] - gain[at]), [(i, int(bins[a[at]])), (int(a[at]), source), (int(b[at]), source)])
    for x in range(min(len(mine), 8)):  # two pieces for one
        for y in range(x + 1, min(len(mine), 8)):
            i, j = int(mine[x]), int(mine[y])
            gain = lengths[i] + lengths[j] - theirs
            ok = np.flatnonzero((gain > 0) & (gain <= left))
            if len(ok):
                at = ok[np.argmin(left[ok] - gain[ok])]
                to = int(bins[others[at]])
                offer(int(gain[at]), int(left[at] - gain[at]), [(i, to), (j, to), (int(others[at]), source)])
    return moves


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; full pieces take a bin each."""
    bins = np.full(len(lengths), -1, dtype=np.int64)
    some = np.flatnonzero(lengths < capacity)
    used = 0
    if len(some):
        got = swap_search(lengths[some], best_fit(lengths[some], capacity), capacity)
        bins[some], used = got, int(got.max()) + 1
    full = bins < 0
    bins[full] = used + np.arange(np.count_nonzero(full))
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    first = np.ones(len(order), dtype=bool)
    first[1:] = bins[order][1:] != bins[order][:-1]
    before = (ends - lengths[order])
    offset = np.zeros(len(lengths), dtype=np.int64)
    offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
    return bins, offset


def pack_documents(df: DataFrame, key: str, text: str, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   group: int = GROUP) -> DataFrame:
    """(key, piece, start, length, ids, ids_crc32, sequence_id, offset): every piece's ids and their place in a sequence of at most ``capacity``.

    ``ids`` are little-endian unsigned 32-bit integers; those of a sequence's
    pieces, laid end to end by ``offset``, are the sequence.
    Null and repeated keys are documents like any others; an empty table gives no rows.
    """
    pieces = stash(token_pieces(df, key, text, tokenizer, capacity, end_id, group), "pieces")
    rest = pieces.where("sequence_id is null")
    groups = max(1, -(-rest.count() // group))
    kind = df.schema[key].dataType.simpleString()

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        bins, offset = pack(pdf["length"].to_numpy(np.int64), capacity)
        out = pdf.drop(columns=["turn"])
        out["sequence_id"] = -1 - (pdf["grp"].to_numpy(np.int64) * (1 << 32) + bins)
        out["offset"] = offset
        return out.drop(columns=["grp"])

    workers_import(df.sparkSession)
    dealt = rest.drop("sequence_id", "offset").withColumn("grp", F.pmod("turn", F.lit(groups)))
    late = dealt.groupBy("grp").applyInPandas(place, f"key {kind}, piece int, start long, length long, ids binary, sequence_id long, offset long")
    return (pieces.where("sequence_id is not null").drop("turn").unionByName(late)
            .select(F.col("key").alias(key), "piece", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"))
