"""Byte-level BPE by a global shuffle of distinct words, and decoding by a join with the token-byte table.

Texts are split into pre-tokens where they are read.  A slice of documents
keeps its pre-tokens as positions in a list of its distinct words, so only
distinct words are exploded and shuffled: by word, with the slice and the
word's number there.  Rows of one word then meet in one sorted partition, where
it is encoded once; its ids go back to every slice that has it, and each slice
lays them end to end by position.

A word has at most one row a slice, however often it occurs, so the commonest
word holds no more rows than there are slices.  The slices' table is bucketed
by slice: their positions are never shuffled, the ids come to them.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import arrow_map, shared_path, text_slices, workers_import
from .runs import runs

#: Characters of a slice; a longer text is a slice of its own.  Rows encoded, and tokens laid out, at a time.
SLICE_CHARS = 32_000_000
ROWS, TOKENS = 1 << 16, 1 << 19

#: What the pattern of the rank files comes to in texts of ASCII characters.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Every match of ``pattern``, where white space is Unicode's, as the rank files' library has it."""
    whole = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
    if pattern != public_tokenizers.PATTERN:
        return whole
    plain = re.compile(ASCII_PATTERN, re.ASCII).findall
    return lambda text: plain(text) if text.isascii() else whole(text)


class Ranks:
    """A rank file: encodes single words, and has the bytes of every token."""

    def __init__(self, file: str):
        with open(file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # a word is never split again: the pattern takes all of it
        self.encode = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.dtype = np.dtype("<u2" if max(ranks.values()) < 1 << 16 else "<u4")
        tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.binary())


_RANKS: dict[str, Ranks] = {}


def ranks_of(file: str) -> Ranks:
    """One for each process and file."""
    if file not in _RANKS:
        _RANKS[file] = Ranks(file)
    return _RANKS[file]


def pack_order(order: np.ndarray) -> bytes:
    """Positions byte plane by byte plane: words are numbered by falling count, so the upper planes are nearly empty."""
    return zstandard.ZstdCompressor(level=3).compress(order.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack_order(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").reshape(-1)


class Slice:
    """Documents whose words are numbered together."""

    def __init__(self):
        self.number: dict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.keys: list[pa.Array] = []
        self.orders: list[np.ndarray] = []
        self.chars = 0

    def add(self, keys: pa.Array, texts: list[str], cut: Callable[[str], list[str]]) -> None:
        self.keys.append(keys)
        for text in texts:
            words = cut(text)
            self.orders.append(np.fromiter(map(self.number.__getitem__, words), np.uint32, len(words)))
            self.chars += len(text)

    def batch(self, name: int) -> pa.RecordBatch:
        order = np.concatenate(self.orders)
        rank = np.argsort(-np.bincount(order, minlength=len(self.number)), kind="stable")
        place = np.empty(len(rank), dtype=np.uint32)
        place[rank] = np.arange(len(rank), dtype=np.uint32)
        keys = pa.concat_arrays(self.keys)
        words = pa.array(list(self.number), pa.string()).take(pa.array(rank))
        ends = np.cumsum([len(o) for o in self.orders])
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (keys, pa.array(ends, pa.int64()), words)]
        return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), *lists, pa.array([pack_order(place[order])], pa.binary())],
                                          names=["slice", "keys", "ends", "words", "order"])


def slice_words(df: DataFrame, key: str, text: str, pattern: str, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """(slice, keys, ends, words, order): documents by slices, stored bucketed by slice under the shared folder.

    ``words`` are a slice's distinct words, ``order`` the packed number of the
    word at each position, ``ends`` where each document's positions end.
    """
    spark, kind = df.sparkSession, df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, now, name = splitter(pattern), Slice(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, part in text_slices(batch.column(1).to_pylist()):
                now.add(batch.column(0).slice(first, len(part)), part, cut)
                if now.chars >= slice_chars:
                    yield now.batch(name)
                    now, name = Slice(), name + 1
        if now.orders:
            yield now.batch(name)

    cut = arrow_map(df.select(F.col(key).alias("key"), F.col(text).alias("text")), run,
                    f"slice long, keys array<{kind}>, ends array<long>, words array<string>, order binary")
    name = f"slices_{uuid.uuid4().hex}"
    (cut.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "slice")
     .option("path", shared_path(spark, "slices")).option("compression", "zstd").saveAsTable(name))
    return spark.table(name)


def encode_words(pieces: DataFrame, ranks: str) -> DataFrame:
    """(slice, n, size, ids) from (word, slice, n): each distinct word is encoded once, its ids go with all its rows.

    A row of the result holds many words of one slice: their numbers, how many
    ids each has, and those ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, last = ranks_of(ranks), ("", [])

        def coded(part: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal last
            t = pa.Table.from_batches(part).combine_chunks()
            words = t.column(0).combine_chunks().dictionary_encode()
            ids = [last[1] if w == last[0] else table.encode(w) for w in words.dictionary.to_pylist()]
            last = (words.dictionary[-1].as_py(), ids[-1])  # rows are sorted: only this word may go on in the next part
            size = np.array([len(x) for x in ids])
            flat = np.array([i for x in ids for i in x], dtype=table.dtype)
            first = np.cumsum(size) - size
            code, of, n = words.indices.to_numpy(), t.column(1).to_numpy(), t.column(2).to_numpy()
            order = np.argsort(of, kind="stable")
            starts = np.flatnonzero(np.diff(of[order], prepend=of[order[0]] - 1))
            rows = [(int(of[at[0]]), n[at].astype("<u4").tobytes(), size[code[at]].astype("<u4").tobytes(),
                     flat[runs(first[code[at]], size[code[at]])].tobytes()) for at in np.split(order, starts[1:])]
            name, *packed = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(name, pa.int64()), *(pa.array(x, pa.binary()) for x in packed)],
                                              names=["slice", "n", "size", "ids"])

        part, rows = [], 0
        for batch in batches:
            part.append(batch)
            rows += batch.num_rows
            if rows >= ROWS:
                yield coded(part)
                part, rows = [], 0
        if rows:
            yield coded(part)

    sorted_words = pieces.select("word", "slice", "n").repartition("word").sortWithinPartitions("word")
    return arrow_map(sorted_words, run, "slice long, n binary, size binary, ids binary")


def encode(df: DataFrame, key: str, text: str, ranks: str, pattern: str = public_tokenizers.PATTERN, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """(key, ids): the ids of every whole text as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded separately, without special tokens.  A
    null or empty text has no ids.  Null and repeated keys are documents like
    any others, other columns are not looked at, and an empty table gives no
    rows.  A word of any length is one row; a text's ids are one row, too.
    """
    kind = df.schema[key].dataType.simpleString()
    cut = slice_words(df, key, text, pattern, slice_chars)
    coded = encode_words(cut.select("slice", F.posexplode("words").alias("n", "word")), ranks)

    def lay(documents: pa.Table, words: pa.Table) -> pa.Table:
        keys, data = [], []
        dtype = ranks_of(ranks).dtype
        n, size = (np.frombuffer(b"".join(words.column(c).to_pylist()), "<u4").astype(np.int64) for c in ("n", "size"))
        flat = np.frombuffer(b"".join(words.column("ids").to_pylist()), dtype)
        size_of, first_of = np.zeros((2, len(n)), dtype=np.int64)
        size_of[n], first_of[n] = size, np.cumsum(size) - size
        for row in range(documents.num_rows):  # one, since a slice is one row
            order = unpack_order(documents.column("order")[row].as_py())
            ends = documents.column("ends").combine_chunks()[row].values.to_numpy()
            keys.append(documents.column("keys").combine_chunks()[row].values)
            first = 0
            while first < len(ends):  # documents with some number of tokens at a time
                base = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, base + TOKENS, side="right")))
                part = order[base:int(ends[last - 1])]
                ids = flat[runs(first_of[part], size_of[part])].astype("<u4")
                upto = np.concatenate([[0], np.cumsum(size_of[part])])[np.concatenate([[base], ends[first:last]]) - base] * 4
                raw = pa.py_buffer(ids.tobytes())
                data.append(pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(upto.astype(np.int32).tobytes()), raw]))
                first = last
        return pa.Table.from_arrays([pa.chunked_array(keys), pa.chunked_array(data, pa.binary())], names=["key", "ids"]).combine_chunks()

    workers_import(df.sparkSession)
    documents = cut.select("slice", "keys", "ends", "order")
    return (documents.groupBy("slice").cogroup(coded.groupBy("slice")).applyInArrow(lay, f"key {kind}, ids binary")
            .withColumnRenamed("key", key))


def decode(df: DataFrame, ids: str, ranks: str) -> DataFrame:
    """``df`` with ``decoded``, the bytes of its ``ids`` column laid end to end; null ids stay null.

    A map-side join on the token id: the token-byte table has one row a token,
    so the vocabulary bounds it, and every worker has all of it.  An id without
    a token raises.
    """
    if "decoded" in df.columns:
        raise ValueError("the table already has a column decoded")
    at, names = df.columns.index(ids), [*df.columns, "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ranks_of(ranks).tokens
        for batch in batches:
            column, first = batch.column(at).to_pylist(), 0
            while first < len(column):
                last, n = first, 0
                while last < len(column) and (last == first or n < 4 * TOKENS):
                    n += len(column[last] or b"")
                    last += 1
                part = column[first:last]
                numbers = np.frombuffer(b"".join(x or b"" for x in part), "<u4")
                found = tokens.take(pa.array(numbers)) if numbers.max(initial=0) < len(tokens) else None
                if found is None or found.null_count:
                    raise ValueError("an id has no token")
                ends = np.cumsum([0, *(len(x or b"") // 4 for x in part)])
                upto = np.frombuffer(found.buffers()[1], np.int32, len(found) + 1)[ends] if len(found) else np.zeros(len(ends), np.int32)
                nulls = pa.array([x is not None for x in part]).buffers()[1] if None in part else None
                whole = pa.Array.from_buffers(pa.binary(), len(part), [nulls, pa.py_buffer(upto.tobytes()), found.buffers()[2] or pa.py_buffer(b"")])
                yield pa.RecordBatch.from_arrays([*(c.slice(first, last - first) for c in batch.columns), whole], names=names)
                first = last

    return arrow_map(df, run, StructType([*df.schema, StructField("decoded", BinaryType())]))
