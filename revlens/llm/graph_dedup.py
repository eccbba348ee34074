"""Near-duplicate vectors by range search on a robust-pruned flat graph.

Vectors go to the shards of their two nearest centroids, so shards overlap.
In each shard every vector's neighbour candidates are pruned robustly: after
the few nearest, each one taken drops the candidates that it is clearly closer
to than the vector is.  The adjacency lists of all shards are united.  Then each shard
searches the united graph: greedily from the medoid, and from the vector's own
node on, expanding every node within the range, and a margin around it, until
no new one turns up.  What is found is verified in double precision.

The search never leaves a shard.  Vectors of a label without a common cell are
compared directly: every pair of large blocks of a label is a task that
multiplies tile by tile and verifies what comes near the range.  An exact cover
by cells would do no less: among vectors of 64 components, nearly every cell
comes within the range of every vector.  Up to ``2 * OVERLAP - 1`` cells any two
vectors have a common one, and there is no such pass.

Only vectors of one label can link, so shards lie within labels.  Equal
vectors are one node with a count.  A shard beyond ``BLOCK`` members is cut
into blocks, and every pair of blocks is a shard of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stash, workers_import
from .components import connected_components
from .vectors import k_means, lengths, matrix, sample, usable

LEAST, MARGIN = 0.93, 0.08
OVERLAP, BLOCK, PER_CELL, MOST_CELLS, FIT_ROWS = 2, 1024, 4000, 256, 8192
POOL, DEGREE, ALPHA, RANDOM = 48, 24, 1.2, 8
#: So many nearest candidates stay unpruned: around a centre of copies pruning alone leaves a star.
NEAREST = 12
#: Vectors of a block of the direct comparison, and rows multiplied at a time.
WIDE_BLOCK, TILE = 16384, 256
#: Single precision is off by less than this.
SLACK = 1e-4


def robust_prune(near: np.ndarray, pool: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, nearest: int = NEAREST) -> list[np.ndarray]:
    """The kept neighbours of each node; ``near``: all cosines, ``pool``: candidates of each node, nearest first, -1 for none."""
    m = len(pool)
    rows = np.arange(m)
    far = np.where(pool >= 0, 2 - 2 * near[rows[:, None], pool], np.inf)
    alive = (pool >= 0) & (pool != rows[:, None])
    kept = np.full((m, degree), -1)
    for r in range(degree):
        at = np.argmax(alive, axis=1)
        has = alive[rows, at]
        if not has.any():
            break
        pick = pool[rows, at]
        kept[has, r] = pick[has]
        if r >= nearest:
            alive &= alpha * (2 - 2 * near[pick[:, None], pool]) > far
        alive[rows, at] = False
    return [k[k >= 0] for k in kept]


def build_graph(unit: np.ndarray) -> list[np.ndarray]:
    """Adjacency lists of a shard: pruned candidates, their reverse, and a way from the medoid to every node."""
    m = len(unit)
    near = unit @ unit.T
    size = min(POOL, m)
    pool = np.argpartition(-near, size - 1, axis=1)[:, :size]
    extra = np.random.default_rng(m).integers(0, m, (m, min(RANDOM, m)))
    pool = np.sort(np.concatenate([pool, extra], axis=1), axis=1)
    pool[:, 1:][pool[:, 1:] == pool[:, :-1]] = -1
    order = np.argsort(np.where(pool >= 0, -near[np.arange(m)[:, None], pool], np.inf), axis=1, kind="stable")
    kept = robust_prune(near, np.take_along_axis(pool, order, axis=1))
    back: list[list[int]] = [[] for _ in range(m)]
    for i, to in enumerate(kept):
        for t in to.tolist():
            back[t].append(i)
    out = []
    for i in range(m):
        more = np.setdiff1d(np.array(back[i], dtype=np.int64), kept[i])
        more = more[np.argsort(-near[i, more], kind="stable")][:DEGREE]
        out.append(np.concatenate([kept[i].astype(np.int64), more]))
    reached, todo = np.zeros(m, dtype=bool), [medoid(unit)]
    reached[todo] = True
    while True:
        while todo:
            new = out[todo.pop()]
            new = new[~reached[new]]
            reached[new] = True
            todo += new.tolist()
        lost = np.flatnonzero(~reached)
        if not len(lost):
            return out
        inside = np.flatnonzero(reached)
        best = near[np.ix_(lost, inside)]
        a, b = np.unravel_index(np.argmax(best), best.shape)
        out[inside[b]] = np.append(out[inside[b]], lost[a])
        reached[lost[a]] = True
        todo = [int(lost[a])]


def medoid(unit: np.ndarray) -> int:
    return int(np.argmax(unit @ unit.mean(axis=0)))


def range_search(unit: np.ndarray, graph: list[np.ndarray], least: float = LEAST, margin: float = MARGIN) -> list[np.ndarray]:
    """For each node of a shard, the others found within the range."""
    m = len(unit)
    width = max(1, max(len(g) for g in graph))
    padded = np.tile(np.arange(m)[:, None], (1, width))
    for i, g in enumerate(graph):
        padded[i, :len(g)] = g
    now = np.full(m, medoid(unit))
    best = unit @ unit[now[0]]
    moving = np.arange(m)
    while len(moving):  # greedy: each step is nearer, so it ends
        to = padded[now[moving]]
        score = np.einsum("md,mrd->mr", unit[moving], unit[to])
        at = np.argmax(score, axis=1)
        top = score[np.arange(len(moving)), at]
        better = top > best[moving]
        moving, at, top, to = moving[better], at[better], top[better], to[better]
        now[moving] = to[np.arange(len(moving)), at]
        best[moving] = top
    first = np.einsum("md,mrd->mr", unit, unit[padded])
    first[padded == np.arange(m)[:, None]] = -1
    edge = least - margin
    found: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * m
    for i in np.flatnonzero((first.max(axis=1) >= edge) | ((best >= edge) & (now != np.arange(m)))).tolist():
        seen = np.zeros(m, dtype=bool)
        seen[i] = True
        hits, front = [], np.array(sorted({i, int(now[i])}))
        seen[front] = True
        if now[i] != i and best[i] >= least:
            hits.append(now[i:i + 1])
        while len(front):
            new = np.unique(padded[front])
            new = new[~seen[new]]
            seen[new] = True
            score = unit[new] @ unit[i]
            hits.append(new[score >= least])
            front = new[score >= edge]
        found[i] = np.concatenate(hits)
    return found


def join(root: np.ndarray, a: int, near: np.ndarray) -> None:
    """Gives the groups of node ``a`` and of its neighbours the smallest of their names."""
    names = np.unique(root[np.append(near, a)])
    if len(names) > 1:
        root[np.isin(root, names[1:])] = names[0]


def _shards(points: DataFrame) -> DataFrame:
    """Each point in each of its shards: columns c (cell), sub (its block there), and the blocks i <= j that meet."""
    each = points.select("*", F.explode("cells").alias("c"))
    sizes = each.groupBy("label", "c").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("s"))
    cut = each.join(sizes, ["label", "c"]).withColumn("sub", F.pmod(F.xxhash64("id"), F.col("s")).cast("int"))
    return (cut.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
            .withColumn("i", F.least("sub", "t")).withColumn("j", F.greatest("sub", "t")).drop("s", "t"))


def apart(unit: np.ndarray, cells: np.ndarray, side: np.ndarray, least: float = LEAST) -> Iterator[tuple[int, np.ndarray]]:
    """(a, those within the range of it) for links of vectors without a common cell, each once.

    With two sides (``side`` 0 and 1, in this order) only from one to the other.
    """
    m, split = len(unit), int(np.searchsorted(side, 1))
    small = unit.astype(np.float32)
    two = 0 < split < m
    for first in range(0, split if two else m, TILE):
        last = min(first + TILE, split if two else m)
        start = split if two else first
        row, column = np.nonzero(small[first:last] @ small[start:].T >= least - SLACK)
        row, column = row + first, column + start
        ahead = row < column
        row, column = row[ahead], column[ahead]
        cut = np.searchsorted(row, np.arange(first, last + 1))
        for a, x, y in zip(range(first, last), cut, cut[1:]):
            near = column[x:y]
            if len(near):
                near = near[~(cells[near][:, :, None] == cells[a][None, None, :]).any(axis=(1, 2))]
                near = near[unit[near] @ unit[a] >= least]
                if len(near):
                    yield a, near


def _strangers(points: DataFrame, least: float) -> DataFrame:
    """(id, links, near) of the links between vectors of a label without a common cell; links counts copies."""
    kind = points.schema["id"].dataType.simpleString()
    # stored, so that its size is known: broadcast only if it is small
    sizes = stash(points.groupBy("label").agg(F.ceil(F.count("*") / WIDE_BLOCK).cast("int").alias("s")), "sizes")
    cut = points.join(sizes, "label").withColumn("sub", F.pmod(F.xxhash64("id"), F.col("s")).cast("int"))
    met = (cut.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
           .select("label", F.least("sub", "t").alias("i"), F.greatest("sub", "t").alias("j"), "id", "u", "copies", "cells", "sub"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i = int(pdf["i"].iloc[0])
        two = i != int(pdf["j"].iloc[0])
        side = (pdf["sub"].to_numpy() != i).astype(np.int8) if two else np.zeros(len(pdf), np.int8)
        pdf = pdf.assign(side=side).sort_values(["side", "id"])
        side, ids, unit, copies = pdf["side"].to_numpy(), pdf["id"].to_numpy(), _unit(pdf), pdf["copies"].to_numpy()
        if two and not 0 < side.sum() < len(ids):  # the other block is empty
            return pd.DataFrame({"id": ids[:0], "links": copies[:0], "near": ids[:0]})
        cells = np.stack(pdf["cells"].to_numpy())
        links, root = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        for a, near in apart(unit, cells, side, least):
            join(root, a, near)
            links[a] += copies[near].sum()
            links[near] += copies[a]
        some = links > 0
        return pd.DataFrame({"id": ids[some], "links": links[some], "near": ids[root[some]]})

    return met.groupBy("label", "i", "j").applyInPandas(run, f"id {kind}, links long, near {kind}")


def _points(rows: DataFrame, d: int) -> DataFrame:
    """(id, label, copies, u, cells) of each distinct vector of ``d`` components: the unit vector and its nearest centroids."""
    same = stash(rows.where(F.size("v") == d).groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "vectors")
    n = same.count()
    x = sample(same, "id", "v", FIT_ROWS, n)
    cells = min(MOST_CELLS, max(1, -(-n // PER_CELL)))
    centroids = rows.sparkSession.sparkContext.broadcast(k_means(x / np.linalg.norm(x, axis=1)[:, None], cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centroids.value
        for batch in batches:
            x = matrix(batch.column(1), d)
            x = x / np.abs(x).max(axis=1)[:, None]
            u = x / np.linalg.norm(x, axis=1)[:, None]
            near = np.sort(np.argsort((c**2).sum(axis=1) - 2 * u @ c.T, axis=1, kind="stable")[:, :OVERLAP], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array([r.tobytes() for r in u], pa.binary()),
                                              pa.array(near.astype(np.int32).tolist(), pa.list_(pa.int32()))], names=["label", "id", "copies", "u", "cells"])

    kinds = {c: same.schema[c].dataType.simpleString() for c in ("label", "id")}
    return stash(arrow_map(same.select("label", "v", "id", "copies"), run,
                           f"label {kinds['label']}, id {kinds['id']}, copies long, u binary, cells array<int>"), "points")


def _unit(pdf: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(pdf["u"]), np.float64).reshape(len(pdf), -1)


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = LEAST) -> DataFrame:
    """(key, n_links, component_id, kept) for every row.

    Rows link when their labels are equal and not null and the cosine found is
    at least ``least``; a component is named by its smallest key.  Null labels
    and unusable vectors link with nothing, and vectors of different lengths
    never link with each other: each length has a graph of its own.  Equal
    vectors of a label link with each other.  A null key has a null component
    and isn't kept; an empty table gives no rows.
    """
    workers_import(df.sparkSession)
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("v"), F.col(label).alias("label"))
    ok = usable("v") & F.col("label").isNotNull()
    named = rows.where(ok & F.col("id").isNotNull())
    found = [_nodes(named, d, least) for d in lengths(named, "v")]
    if not found:
        return rows.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                           F.coalesce(F.col("id") == F.col("id"), F.lit(False)).alias("kept"))
    # a key with several vectors is one node: the most links of one of them, the smallest component
    nodes = reduce(DataFrame.unionByName, found).groupBy("rep").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    classes = rows.where(ok).groupBy("label", "v").agg(F.min("id").alias("rep"))
    mine = rows.where(ok).join(classes, ["label", "v"]).join(nodes, "rep", "left").select("id", "n_links", "component_id")
    every = mine.unionByName(rows.where(~ok).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return every.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
                        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"))


def _nodes(rows: DataFrame, d: int, least: float) -> DataFrame:
    """(rep, n_links, component_id) of each distinct vector of ``d`` components, named by its smallest id."""
    points = _points(rows, d)
    kind = points.schema["id"].dataType.simpleString()

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids = pdf["id"].to_numpy()
        return pd.DataFrame({"id": ids, "next": [ids[g].tolist() for g in build_graph(_unit(pdf))]})

    lists = (_shards(points).select("label", "c", "i", "j", "id", "u").groupBy("label", "c", "i", "j")
             .applyInPandas(build, f"id {kind}, next array<{kind}>"))
    graph = stash(lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("next"))).alias("next")), "graph")

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id").reset_index(drop=True)
        ids, unit = pdf["id"].to_numpy(), _unit(pdf)
        c, i, j = (int(pdf[x].iloc[0]) for x in ("c", "i", "j"))
        sub, copies = pdf["sub"].to_numpy(), pdf["copies"].to_numpy()
        cells = np.stack(pdf["cells"].to_numpy())
        graph = []
        for to in pdf["next"]:
            at = np.searchsorted(ids, to)
            at = at[at < len(ids)] if len(at) else at
            to = np.asarray(to)[np.searchsorted(ids, to) < len(ids)] if len(to) else np.asarray(to)
            graph.append(at[ids[at] == to].astype(np.int64))
        links, root = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        for a, near in enumerate(range_search(unit, graph, least)):
            if not len(near):
                continue
            join(root, a, near)
            # a pair is counted in its first common cell, in the shard of its two blocks there
            both = (cells[near][:, :, None] == cells[a][None, None, :]).any(axis=2)
            lowest = np.where(both, cells[near], np.iinfo(np.int32).max).min(axis=1)
            mine = (lowest == c) & (np.minimum(sub[near], sub[a]) == i) & (np.maximum(sub[near], sub[a]) == j)
            links[a] = copies[near[mine]].sum()
        return pd.DataFrame({"id": ids, "links": links, "near": ids[root]})

    found = stash(_shards(points).join(graph, "id").select("label", "c", "i", "j", "id", "u", "sub", "copies", "cells", "next")
                  .groupBy("label", "c", "i", "j").applyInPandas(search, f"id {kind}, links long, near {kind}"), "found")
    if points.select(F.explode("cells").alias("c")).agg(F.max("c")).first()[0] >= 2 * OVERLAP - 1:
        found = found.unionByName(stash(_strangers(points, least), "strangers"))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("id <> near").select(F.col("id").alias("a"), F.col("near").alias("b")))
    return (points.select("id", "copies").join(counts, "id").join(roots, "id", "left")
             .select(F.col("id").alias("rep"), (F.col("links") + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))


def audit_recall(df: DataFrame, result: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 least: float = LEAST, queries: int = 200) -> float:
    """The share of the true links of at most ``queries`` rows, chosen by a hash, that ``result`` counts."""
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("v"), F.col(label).alias("label")).where(usable("v") & F.col("label").isNotNull())
    asked = rows.orderBy(F.xxhash64("id", F.lit("audit")), "id").limit(queries).select(F.col("id").alias("q"), F.col("v").alias("qv"), "label")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    cosine = dot("v", "qv") / F.sqrt(dot("v", "v") * dot("qv", "qv"))
    true = (rows.join(F.broadcast(asked), "label").where((F.col("id") != F.col("q")) & (F.size("v") == F.size("qv")) & (cosine >= least))
            .groupBy(F.col("q").alias(key)).agg(F.count("*").alias("true")))
    got = true.join(result, key).agg(F.sum(F.least("true", "n_links")), F.sum("true")).first()
    return 1.0 if not got[1] else got[0] / got[1]
