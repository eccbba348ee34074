"""Token ids as binary files of independent zstandard frames with a trailing seek table.

A file holds documents in ascending key order.  Each frame is a zstandard
frame of its own with whole documents: their number (u32), keys (i64), flags
that tell null keys (u8), lengths (u32), then the ids (u16 if the vocabulary
allows it, else u32), all little-endian.  A skippable frame follows with the
id width and the first and last key of each frame, then the seek table of the
public zstandard seekable format: sizes and a checksum (low half of XXH64) for
each frame.  A reader fetches the table from the file's end and decompresses
only the frames it needs.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, shared_path, stash
from .token_cache import encoded_rows, encoder

#: Fixed values of the seekable format, and of the skippable frame with the keys.
SEEK_MAGIC, SEEK_FRAME, KEY_FRAME = 0x8F92EAB1, 0x184D2A5E, 0x184D2A50
FRAME_BYTES = 1 << 18
END_ID = 2


class FrameWriter:
    """Writes documents, given in ascending key order, to an open binary file."""

    def __init__(self, out, wide: bool, level: int = 3, frame_bytes: int = FRAME_BYTES):
        self.out, self.dtype, self.limit = out, np.dtype("<u4" if wide else "<u2"), frame_bytes
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.table: list[tuple[int, int, int]] = []
        self.spans: list[tuple[int, int]] = []
        self.keys, self.ids, self.size = [], [], 0

    def add(self, key: int | None, ids: np.ndarray) -> None:
        """A document goes whole into the frame that is being filled."""
        self.keys.append(key)
        self.ids.append(ids.astype(self.dtype))
        self.size += len(ids) * self.dtype.itemsize
        if self.size >= self.limit:
            self._flush()

    def _flush(self) -> None:
        if not self.keys:
            return
        key = np.array([k or 0 for k in self.keys], dtype="<i8")
        data = b"".join([struct.pack("<I", len(key)), key.tobytes(), bytes(k is not None for k in self.keys),
                         np.array([len(x) for x in self.ids], dtype="<u4").tobytes(), *(x.tobytes() for x in self.ids)])
        packed = self.compress(data)
        self.out.write(packed)
        self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        known = [k for k in self.keys if k is not None]
        self.spans.append((known[0], known[-1]) if known else (1, 0))
        self.keys, self.ids, self.size = [], [], 0

    def close(self) -> None:
        self._flush()
        body = struct.pack("<BI", self.dtype.itemsize, len(self.spans)) + np.array(self.spans, dtype="<i8").tobytes()
        self.out.write(struct.pack("<II", KEY_FRAME, len(body)) + body)
        self.table.append((8 + len(body), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        body = b"".join(struct.pack("<III", *x) for x in self.table) + struct.pack("<IBI", len(self.table), 0x80, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SEEK_FRAME, len(body)) + body)


class FrameReader:
    """Reads from a seekable binary file; a wrong checksum raises ``ValueError``."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, 2) if not hasattr(file, "size") else file.size()
        file.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEK_MAGIC or not flags & 0x80:
            raise ValueError("not a file of seekable frames with checksums")
        file.seek(size - 9 - 12 * n)
        self.table = np.frombuffer(file.read(12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        file.seek(int(self.at[n - 1]) + 8)
        body = file.read(int(self.table[n - 1, 0]) - 8)
        width, self.frames = struct.unpack_from("<BI", body)
        self.dtype = np.dtype("<u2" if width == 2 else "<u4")
        self.spans = np.frombuffer(body, dtype="<i8", offset=5).reshape(self.frames, 2)
        self.decompress = zstandard.ZstdDecompressor().decompress

    def frame(self, i: int) -> Iterator[tuple[int | None, np.ndarray]]:
        """The (key, ids) of one frame's documents."""
        packed, size, check = self.table[i].tolist()
        self.file.seek(int(self.at[i]))
        data = self.decompress(self.file.read(packed), max_output_size=size)
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {i} doesn't have its checksum")
        n, = struct.unpack_from("<I", data)
        keys = np.frombuffer(data, "<i8", n, 4).tolist()
        has = data[4 + 8 * n:4 + 9 * n]
        sizes = np.frombuffer(data, "<u4", n, 4 + 9 * n).astype(np.int64)
        ids = np.frombuffer(data, self.dtype, offset=4 + 13 * n)
        ends = np.cumsum(sizes)
        for k, h, a, b in zip(keys, has, (ends - sizes).tolist(), ends.tolist()):
            yield k if h else None, ids[a:b]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for i in range(self.frames):
            yield from self.frame(i)

    def find(self, keys: list[int]) -> Iterator[tuple[int, np.ndarray]]:
        """The documents with these keys; only frames whose key range holds one are decompressed."""
        wanted = np.unique(np.array(keys, dtype=np.int64))
        for i, (low, high) in enumerate(self.spans.tolist()):
            a, b = np.searchsorted(wanted, low), np.searchsorted(wanted, high, side="right")
            if a < b:
                mine = set(wanted[a:b].tolist())
                yield from ((k, ids) for k, ids in self.frame(i) if k in mine)


def write_tokens(df: DataFrame, key: str, text: str, tokenizer: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Writes every whole text's ids and the end id under ``folder``; (file, path, documents, tokens) of each file, in key order.

    Texts are range-partitioned by key, ties by hashes of the row, so that a key
    or null held by very many rows doesn't fill one task; each task writes one
    file under a name of its own, so an attempt that is lost or runs twice
    leaves at most a file that no row names.  ``folder`` is a place that every
    executor can write to.  A null text reads as ''; null keys come first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        wide = max(encode.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id) > 0xFFFF
        end = int(end_id).to_bytes(4, "little")
        fs, root = pafs.FileSystem.from_uri(folder)
        number, docs, tokens, out = TaskContext.get().partitionId(), 0, 0, None
        path = f"{root}/part-{number:06d}-{uuid.uuid4().hex}.tokens"
        for keys, coded in encoded_rows(batches, encode):
            if out is None:
                fs.create_dir(root, recursive=True)
                stream = fs.open_output_stream(path)
                out = FrameWriter(stream, wide)
            for key, ids in zip(keys.to_pylist(), coded):
                ids = np.frombuffer(ids + end, dtype="<u4")
                out.add(key, ids)
                docs, tokens = docs + 1, tokens + len(ids)
        if out is not None:
            out.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({"file": pa.array([number], pa.int64()), "path": [path], "documents": pa.array([docs], pa.int64()),
                                              "tokens": pa.array([tokens], pa.int64())})

    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    ties = [F.xxhash64("text"), F.monotonically_increasing_id()]
    ranged = rows.withColumn("h", ties[0]).withColumn("r", ties[1]).repartitionByRange("key", "h", "r").sortWithinPartitions("key", "h", "r")
    return stash(arrow_map(ranged.select("key", "text"), run, "file long, path string, documents long, tokens long"), "manifest")


def read_tokens(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of each document, read back frame by frame; ``start`` counts all ids before it."""
    start, known = 0, []
    for f in files.orderBy("file").collect():  # one short row for each file
        known.append((f.path, start))
        start += f.tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(path) as file:
                    reader = FrameReader(file)
                    for i in range(reader.frames):
                        out = []
                        for k, ids in reader.frame(i):
                            out.append((k, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                            at += len(ids)
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["key", "start", "n_tokens", "ids_crc32"])

    listed = spark.createDataFrame(known, "path string, start long").repartition(max(1, len(known)))
    return arrow_map(listed, run, "key long, start long, n_tokens long, ids_crc32 long")


def store_and_read(df: DataFrame, key: str, text: str, tokenizer: str) -> DataFrame:
    """Writes the texts' ids in the file format under the shared folder and reads them back; an empty table gives no rows."""
    folder = shared_path(df.sparkSession, "tokens")
    files = write_tokens(df, key, text, tokenizer, folder)
    return read_tokens(df.sparkSession, files, folder).withColumnRenamed("key", key)
