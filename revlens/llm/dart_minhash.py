"""Near-duplicate texts by DartMinHash signatures, banded joining and an exact check.

Signatures.  Each element of a document throws an endless sequence of hashed
darts into its region: a plane of weight by time, cut into strips of weight
[0, 1), [1, 2), [2, 4), ... with one dart a unit of area.  A dart has a time, a
weight and a coordinate of the signature, all set by the element alone.  It
hits a document if its weight lies below the element's weight there, and each
coordinate keeps its earliest hit.  Two documents then agree on a coordinate
with a probability equal to their weighted Jaccard similarity.  Darts are drawn
only up to a time at which a document of total weight W expects ``darts`` hits,
so the work follows the number of darts instead of elements times coordinates;
documents with an empty coordinate go on to twice that time.

Joining.  Documents with equal shingles are one class before anything is
joined.  Classes with an equal band of ``rows`` coordinates meet in a bucket;
in each bucket every member is first paired with the bucket's smallest id, so
the pairs grow with the members; a bucket's members are dealt to ``PARTS`` parts
that are counted, and meet that id, apart.  Pairs are checked exactly on their
shingles.
Members that don't link to it are compared with everyone in the bucket, in
blocks that are tasks of their own.  Links give components; none is dropped
for the size of its bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import arrow_map, stash, text_slices
from .components import connected_components
from .shingles import draw, mix, shingle_sets

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 4
BLOCK = 256
#: Parts that a bucket's members are dealt to, so that a very common band isn't one task.
PARTS = 256


def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int, k: int) -> np.ndarray:
    """Signatures (docs, k) of weighted sets given as (document, element hash, weight > 0); all zero for an empty set."""
    out = np.zeros((docs, k), dtype=np.uint64)
    total = np.bincount(doc, weights=weight, minlength=docs)
    live = total > 0
    until = np.zeros(docs)
    until[live] = k * (np.log(k) + 1) / total[live]
    while live.any():
        mine = live[doc]
        sig, full = _throw(doc[mine], element[mine], weight[mine], until, docs, k)
        done = live & full
        out[done] = sig[done]
        live &= ~full
        until *= 2
    return out


def _throw(doc, element, weight, until, docs, k):
    """The earliest dart of each coordinate up to the time ``until`` of its document, and which documents have all."""
    place, when, which = [], [], []
    low, high, strip = 0.0, 1.0, 0
    d, w = doc, weight
    base = mix(element)
    while len(d):
        seed = draw(base, 1000 + strip)
        now, limit, dd, ww = np.zeros(len(d)), until[d], d, w
        n = 0
        while len(dd):
            n += 1
            dart = draw(seed, n)
            now = now - np.log1p((dart >> np.uint64(11)) * -(2.0**-53)) / (high - low)
            on = now < limit
            if not on.all():
                dart, now, seed, dd, ww, limit = dart[on], now[on], seed[on], dd[on], ww[on], limit[on]
            more = mix(dart ^ np.uint64(0x5851F42D4C957F2D))
            hit = low + (high - low) * ((more >> np.uint64(32)) * 2.0**-32) < ww
            coordinate = ((more & np.uint64(0xFFFFFFFF)) * np.uint64(k)) >> np.uint64(32)
            place.append((dd * k + coordinate.astype(np.int64))[hit])
            when.append(now[hit])
            which.append(dart[hit])
        above = w > high
        d, w, base = d[above], w[above], base[above]
        low, high, strip = high, high * 2, strip + 1
    place, when, which = (np.concatenate(x) if x else np.zeros(0) for x in (place, when, which))
    first = np.full(docs * k, np.inf)
    place = place.astype(np.int64)
    np.minimum.at(first, place, when)
    sig = np.zeros(docs * k, dtype=np.uint64)
    best = when == first[place]
    sig[place[best]] = which[best]
    return sig.reshape(docs, k), np.isfinite(first).reshape(docs, k).all(axis=1)


def _sets(texts, by_count, words):
    doc, h, n = shingle_sets(texts, words)
    return doc, h, n if by_count else np.ones(len(n))


def signatures(df: DataFrame, key: str, text: str, bands: int, rows: int, words: int, by_count: bool) -> DataFrame:
    """(id, f1, f2, bands): a 128-bit digest of the weighted set and a hash of each band; texts without words are left out."""
    kind = df.schema[key].dataType.simpleString()
    salt = draw(np.arange(bands, dtype=np.uint64), 77)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, part in text_slices(texts):
                doc, h, w = _sets(part, by_count, words)
                sig = dart_signatures(doc, h, w, len(part), bands * rows)
                band = np.zeros((len(part), bands), dtype=np.uint64)
                for r in range(rows):
                    band = mix(band + sig[:, r::rows])
                digest = [np.zeros(len(part), dtype=np.uint64) for _ in range(2)]
                for i, x in enumerate(digest):
                    np.add.at(x, doc, draw(h ^ mix(w.astype(np.uint64)), 5 + i))
                has = np.bincount(doc, minlength=len(part)) > 0
                flat = mix(band[has] ^ salt).view(np.int64).reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)).filter(pa.array(has)), *(pa.array(mix(x[has]).view(np.int64)) for x in digest),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32)), pa.array(flat))],
                    names=["id", "f1", "f2", "bands"])

    return arrow_map(df.select(F.col(key).alias("id"), F.col(text).alias("text")), run,
                     f"id {kind}, f1 long, f2 long, bands array<long>")


#: Bits of the filter that tells which texts to read again: 8 MB, whatever the corpus.
FILTER_BITS = 1 << 26


def _position(key: str):
    return F.xxhash64(key).bitwiseAND(F.lit(FILTER_BITS - 1))


def _filter(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with a bit for the hash of each id."""
    at = ids.select(_position("id").alias("p"))
    parts = (at.groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")))
    rows = parts.collect()  # at most FILTER_BITS / 32768 rows of 4 KB
    out = np.zeros((FILTER_BITS // 32768 + 2, 4096), dtype=np.uint8)
    for r in rows:
        out[r.bucket] = np.frombuffer(bytes(r.bits), np.uint8)
    return out if rows else out[:0]


def _shingles_of(df: DataFrame, ids: DataFrame, words: int, by_count: bool) -> DataFrame:
    """(id, hashes, counts): the sorted shingle hashes of a text as bytes, and their counts.

    Only for texts (id, text) of ``df`` whose id may be among ``ids``: a filter
    of fixed size is sent to the scan, so no text is shuffled.
    """
    kind = df.schema["id"].dataType.simpleString()
    wanted = df.sparkSession.sparkContext.broadcast(_filter(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        if not len(bits):
            return
        for batch in batches:
            # bucket and bit of Spark's bitmaps
            bucket, bit = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            batch = batch.filter(pa.array((bits[bucket, bit >> 3] >> (bit & 7)).astype(np.uint8) & 1 == 1))
            for first, part in text_slices(batch.column(1).to_pylist()):
                doc, h, n = shingle_sets(part, words)
                at = np.searchsorted(doc, np.arange(len(part) + 1))
                n = n.astype(np.uint32)
                cut = lambda x: [x[a:b].tobytes() for a, b in zip(at, at[1:])]  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), pa.array(cut(h), pa.binary()),
                     pa.array(cut(n) if by_count else [b""] * len(part), pa.binary())], names=["id", "hashes", "counts"])

    p = _position("id")
    return arrow_map(df.select("id", "text", F.bitmap_bucket_number(p).alias("bucket"), F.bitmap_bit_position(p).alias("bit")), run,
                     f"id {kind}, hashes binary, counts binary")


def similarity(a: bytes, na: bytes, b: bytes, nb: bytes) -> float:
    """Weighted Jaccard similarity of two sorted sets of hashes; without counts every weight is 1."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    common, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not na:
        union = len(x) + len(y) - len(common)
        return len(common) / union if union else 0.0
    p, q = np.frombuffer(na, np.uint32).astype(np.int64), np.frombuffer(nb, np.uint32).astype(np.int64)
    low = int(np.minimum(p[i], q[j]).sum())
    return low / (int(p.sum()) + int(q.sum()) - low)


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those (a, b) of ``pairs`` whose sets reach the similarity ``least``."""
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(2, 6)]
            keep = pa.array([similarity(*x) >= least for x in zip(*cols)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    of = lambda c: sets.select(F.col("id").alias(c), F.col("hashes").alias(f"h{c}"), F.col("counts").alias(f"n{c}"))
    return arrow_map(pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "ha", "na", "hb", "nb"), run,
                     f"a {kind}, b {kind}")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", *, words: int = WORDS,
                    least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, by_count: bool = False) -> DataFrame:
    """(key, class_id): each text's near-duplicate class, named by its smallest key.

    Texts are linked when the Jaccard similarity of their distinct runs of
    ``words`` words (weighted by how often a run occurs, if ``by_count``) is at
    least ``least``; classes are the connected components.  A pair at 0.8 shares
    none of 20 bands of 4 with a probability of 3e-5.  One row comes out for
    each row in.  A null key has a null class.  A null text, or one without any
    word, is a class of its own; rows with the same key are one document, in
    one class, which links by each of its texts.  An empty table gives none.
    """
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    known = docs.where("id is not null")
    signed = stash(signatures(known, "id", "text", bands, rows, words, by_count), "signatures")
    same = signed.groupBy("f1", "f2").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
    same = stash(same, "classes")
    copies = signed.join(same.select("f1", "f2", "rep"), ["f1", "f2"]).where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))

    members = same.select(F.col("rep").alias("id"), F.explode(F.array_distinct("bands")).alias("bucket"))
    members = stash(_with_heads(members), "members")
    pairs = stash(members.where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct(), "pairs")
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))
    sets = _shingles_of(known, ends, words, by_count)
    sets = stash(sets.distinct(), "sets")  # a document with several texts has several sets, and links by any of them
    links = stash(_similar(pairs, sets, least).distinct(), "links")
    rest = stash(_within_buckets(members, links, sets, least), "links")
    roots = connected_components(copies.unionByName(links).unionByName(rest))
    return (docs.select("id").join(roots, "id", "left")
            .select(F.col("id").alias(key), F.coalesce("component", "id").alias("class_id")))


def _with_heads(members: DataFrame) -> DataFrame:
    """Members (id, bucket) of buckets of two and more, each with its bucket's smallest id ``pivot`` and size ``n``.

    Only a bucket's parts, ``PARTS`` at most, come together by bucket; members meet the result by bucket and part.
    """
    dealt = members.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int"))
    parts = dealt.groupBy("bucket", "part").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("bucket")
    heads = (parts.select("bucket", "part", F.min("first").over(whole).alias("pivot"), F.sum("n").over(whole).alias("n"))
             .where("n > 1"))
    return dealt.join(heads, ["bucket", "part"]).drop("part")


def _within_buckets(members: DataFrame, links: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (a, b) of members who don't link to their bucket's pivot, with anyone in the bucket.

    A bucket is cut into blocks of about ``BLOCK`` members, and each block of
    such members meets each block of all members in a task of its own, so a
    large bucket is many small tasks.  Members learn the number of blocks that
    they meet by bucket and block.  A task gives a spanning set of the links
    that it finds, at most one for each member.
    """
    kind = members.schema["id"].dataType.simpleString()
    alone = (members.where("id <> pivot and n > 2")
             .join(links.select(F.col("a").alias("id"), F.col("b").alias("pivot")), ["id", "pivot"], "left_anti")
             .select("bucket", "id", "n"))
    alone = stash(alone, "alone")
    cut = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    k = F.ceil(F.col("n") / BLOCK).cast("int")
    # m: blocks of a bucket's members that ask, k: of all its members; a row for each of the k
    blocks = (alone.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("m"), F.max(k).alias("k"))
              .select("bucket", "m", upto("k").alias("j")))
    asking = (alone.withColumn("k", k).withColumn("j", cut("k")).join(blocks, ["bucket", "j"])
              .select("bucket", "id", F.lit(True).alias("asks"), cut("m").alias("i"), upto("k").alias("j")))
    asked = (members.withColumn("j", cut(k)).join(blocks, ["bucket", "j"])
             .select("bucket", "id", F.lit(False).alias("asks"), upto("m").alias("i"), "j"))
    rows = (asking.unionByName(asked).join(sets, "id")
            .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
            .select("bucket", "i", "j", "id", "asks", "hashes", "counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, []
        for batch in batches:
            out = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if row[:3] != task:
                    out += _spanning(held, least)
                    task, held = row[:3], []
                held.append(row[3:])
            yield _pairs_batch(out, id_type)
        yield _pairs_batch(_spanning(held, least), id_type)

    id_type = to_arrow_type(members.schema["id"].dataType)
    return arrow_map(rows, run, f"a {kind}, b {kind}")


def _pairs_batch(pairs: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], kind), pa.array([p[1] for p in pairs], kind)], names=["a", "b"])


def _spanning(rows: list[tuple], least: float) -> list[tuple]:
    """Of (id, asks, hashes, counts): links from those that ask to the others that join what isn't joined yet."""
    ask, to = [r for r in rows if r[1]], [r for r in rows if not r[1]]
    if not ask or not to:
        return []
    if ask[0][3]:
        near = [[similarity(*x[2:], *y[2:]) >= least for y in to] for x in ask]
    else:
        parts = [np.frombuffer(r[2], np.uint64) for r in ask + to]
        sizes = np.array([len(x) for x in parts])
        _, seen, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(parts)), sizes)
        mine = row < len(ask)
        kept = np.zeros(len(times), dtype=np.int8)  # shingles that both sides have
        kept[seen[mine]] = 1
        kept[seen[~mine]] |= 2
        shared = np.cumsum(kept == 3) - 1
        use = kept[seen] == 3
        row, column = row[use], shared[seen[use]]
        common = np.zeros((len(ask), len(to)), dtype=np.float32)
        for first in range(0, int(shared[-1]) + 1, 8192):
            at = (column >= first) & (column < first + 8192)
            has = np.zeros((len(parts), min(8192, int(shared[-1]) + 1 - first)), dtype=np.float32)
            has[row[at], column[at] - first] = 1
            common += has[:len(ask)] @ has[len(ask):].T
        union = sizes[:len(ask), None] + sizes[None, len(ask):] - common
        near = common / np.maximum(union, 1) >= least
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for x, y in zip(*np.nonzero(near)):
        a, b = find(ask[x][0]), find(to[y][0])
        if a != b:
            root[a] = b
            out.append((ask[x][0], to[y][0]))
    return out
