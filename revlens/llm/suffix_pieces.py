"""SentencePiece encoding by suffix-array matching, and decoding.

A text is cut where no piece can cross: before a run of word marks.  Segments
that haven't been seen are laid end to end, and a suffix array of that text is
built.  Two binary searches for each piece of the vocabulary give the range of
suffixes that start with it, so all its occurrences, each an edge from where it
starts to where it ends.  Edges are sorted by position and relaxed segment by
segment: for a BPE model the best-scored edge that joins two neighbouring
symbols goes first, leftmost among equals; for a unigram model edges are
relaxed from left to right towards the best total score.  Bytes stand in for
characters without a piece.

A long segment is indexed in windows that overlap by the longest piece, and cut
wherever no occurrence of a piece crosses: no join can cross there either.
Parts that stay long are relaxed over flat arrays.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, text_slices

MARK = "▁"
_SEGMENT = re.compile("▁*[^▁]+|▁+")
CACHE_SEGMENTS = 200_000
#: Segments of at most so many characters are relaxed many at a time.
SHORT = 48
#: Segments beyond so many characters aren't kept for later texts.
KEPT = 1000
#: Bytes that one suffix array covers.
WINDOW = 1 << 18


@dataclass
class Pieces:
    """A model's vocabulary: ordinary pieces with their scores, and the ids of the byte pieces."""

    text: list[str]
    score: list[float]
    ids: list[int]
    bytes_: list[int]
    all_pieces: list[str]
    bpe: bool = True
    _cache: dict[str, bytes] = field(default_factory=dict)
    _old: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self):
        data = [t.replace(MARK, " ").encode() for t in self.text]
        self.width = max(map(len, data))
        order = np.argsort(np.array(data, dtype=f"S{self.width}"), kind="stable")
        self.low = np.array(data, dtype=f"S{self.width}")[order]
        self.high = np.array([d + b"\xff" * (self.width - len(d)) for d in data], dtype=f"S{self.width}")[order]
        self.sizes = np.array([len(d) for d in data], dtype=np.int64)[order]
        self.rank = order  # number of the piece in ``text``
        self.order = np.unique(-np.array(self.score), return_inverse=True)[1].reshape(-1).astype(np.int64)
        self._id_array, self._byte_array = np.array(self.ids), np.array(self.bytes_)
        self.byte_of = {i: b for b, i in enumerate(self.bytes_)}

    @classmethod
    def load(cls, file: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=file)
        n = model.vocab_size()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        names = [model.id_to_piece(i) for i in range(n)]
        scores = [model.get_score(i) for i in plain]
        # scores of BPE models are falling ranks: whole numbers
        return cls([names[i] for i in plain], scores, plain, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], names,
                   all(s == int(s) for s in scores))

    def edges(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of every occurrence of a piece, sorted by position, and where each segment starts; in bytes."""
        data = self._bytes(segments)
        raw = b"\x00".join([*data, b""])
        padded = np.frombuffer(raw + b"\x00" * self.width, dtype=np.uint8)
        start, size, piece = self._occurrences(padded, len(raw))
        at = np.cumsum([0, *(len(d) + 1 for d in data)])
        return start, start + size, piece, at

    def _occurrences(self, padded: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, piece) of every piece that starts in the first ``n`` bytes, by position and size; ``width`` more bytes follow them."""
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.width)[:n]
        suffixes = np.ascontiguousarray(windows).view(f"S{self.width}").reshape(-1)
        places = np.argsort(suffixes, kind="stable")
        ordered = suffixes[places]
        first = np.searchsorted(ordered, self.low, side="left")
        last = np.searchsorted(ordered, self.high, side="right")
        count = last - first
        piece = np.repeat(np.arange(len(count)), count)
        within = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
        start = places[np.repeat(first, count) + within]
        by_place = np.lexsort((self.sizes[piece], start))
        start, piece = start[by_place], piece[by_place]
        return start, self.sizes[piece], self.rank[piece]

    def _windows(self, raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``_occurrences`` over ``raw``, one window of ``WINDOW`` starts after another."""
        for w in range(0, len(raw), WINDOW):
            n = min(WINDOW, len(raw) - w)
            part = raw[w:w + n + self.width]
            start, size, piece = self._occurrences(np.pad(part, (0, n + self.width - len(part))), n)
            yield start + w, size, piece

    def _cuts(self, segment: str) -> array:
        """Where ``segment`` can be cut: the characters that no occurrence of a piece crosses, and the end."""
        raw = np.frombuffer(self._bytes([segment])[0], dtype=np.uint8)
        change = np.zeros(len(raw) + 1, dtype=np.int32)
        for start, size, _ in self._windows(raw):
            np.add.at(change, start + 1, 1)
            np.add.at(change, start + size, -1)
        crossed = np.cumsum(change, out=change)[:-1] > 0
        free = np.flatnonzero(~crossed[(raw & 0xC0) != 0x80])
        return array("q", np.append(free, len(segment)).astype(np.int64).tobytes())

    @staticmethod
    def _bytes(segments: list[str]) -> list[bytes]:
        """UTF-8 with a mark as a space, and NUL as a byte that no text has: NUL stands between segments."""
        return [s.replace(MARK, " ").encode("utf-8", "surrogatepass").replace(b"\x00", b"\xfe") for s in segments]

    def _relax_short(self, segments: list[str]) -> list[bytes]:
        """``_relax_bpe`` for many segments at once: each round joins the best pair of every segment that has one."""
        start, end, piece, at = self.edges(segments)
        raw = np.frombuffer(b"\x00".join([*self._bytes(segments), b""]), dtype=np.uint8)
        table = np.full((len(raw), self.width + 1), -1, dtype=np.int32)
        table[start, end - start] = piece
        a = np.flatnonzero(((raw & 0xC0) != 0x80) & (raw != 0))
        seg = np.searchsorted(at, a, side="right") - 1
        b = np.append(a[1:], 0)
        last = np.append(seg[1:] != seg[:-1], True)
        b[last] = at[seg[last] + 1] - 1
        none = np.iinfo(np.int64).max
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(a):
            key = np.full(len(a), none)
            pair = np.flatnonzero(seg[:-1] == seg[1:])
            size = b[pair + 1] - a[pair]
            fits = size <= self.width
            pair, size = pair[fits], size[fits]
            p = table[a[pair], size]
            pair, p = pair[p >= 0], p[p >= 0]
            key[pair] = (self.order[p] << 32) | pair
            runs = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
            best = np.minimum.reduceat(key, runs)
            over = np.repeat(best == none, np.diff(np.append(runs, len(a))))
            if over.any():
                done.append((a[over], b[over], seg[over]))
            left = best[best != none] & 0xFFFFFFFF
            b[left] = b[left + 1]
            keep = ~over
            keep[left + 1] = False
            a, b, seg = a[keep], b[keep], seg[keep]
        a, b, seg = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(a)
        a, b, seg = a[order], b[order], seg[order]
        p = np.full(len(a), -1)
        short = b - a <= self.width
        p[short] = table[a[short], (b - a)[short]]
        count = np.where(p >= 0, 1, b - a)
        symbol = np.repeat(np.arange(len(a)), count)
        byte = raw[a[symbol] + np.arange(len(symbol)) - np.repeat(np.cumsum(count) - count, count)].astype(np.int64)
        byte[byte == 0xFE] = 0
        ids = np.where(p[symbol] >= 0, self._id_array[p[symbol]], self._byte_array[byte]).astype("<u4").tobytes()
        cut = (4 * np.searchsorted(seg[symbol], np.arange(len(segments) + 1))).tolist()
        return [ids[x:y] for x, y in zip(cut, cut[1:])]

    def encode_segments(self, segments: list[str]) -> list[list[int]]:
        start, end, piece, at = self.edges(segments)
        cut = np.searchsorted(start, at)
        s, e, p = start.tolist(), end.tolist(), piece.tolist()
        relax = self._relax_bpe if self.bpe else self._relax_unigram
        out = []
        for i, segment in enumerate(segments):
            a, b, base = int(cut[i]), int(cut[i + 1]), int(at[i])
            out.append(relax(segment, [(x - base, y - base, z) for x, y, z in zip(s[a:b], e[a:b], p[a:b])]))
        return out

    def _places(self, segment: str) -> list[int]:
        """Byte offsets of the characters, with a mark as one byte, and the end."""
        places, at = [], 0
        for c in segment:
            places.append(at)
            at += 1 if c == MARK or c < "\x80" else len(c.encode("utf-8", "surrogatepass"))
        return [*places, at]

    def _ids(self, segment: str, places: list[int], joins: list[tuple[int, int, int | None]]) -> list[int]:
        index = {p: i for i, p in enumerate(places)}
        out = []
        for a, b, piece in joins:
            if piece is None:
                out += [self.bytes_[x] for x in segment[index[a]:index[b]].encode("utf-8", "surrogatepass")]
            else:
                out.append(self.ids[piece])
        return out

    def _relax_long(self, segment: str) -> bytes:
        """``_relax_bpe`` over flat arrays, for segments of any length.

        The pairs of neighbouring characters are sorted once; a heap holds only
        pairs that joins have made.  A pair is its order, start and size in one number.
        """
        data = self._bytes([segment])[0]
        raw = np.frombuffer(data, dtype=np.uint8)
        n = len(raw)
        places = np.flatnonzero((raw & 0xC0) != 0x80)
        ends = np.append(places[1:], n)
        count, sizes, pieces_, pairs = np.zeros(n + 1, dtype=np.int32), array("H"), array("i"), []
        for start, size, piece in self._windows(raw):
            np.add.at(count, start + 1, 1)
            sizes.frombytes(size.astype(np.uint16).tobytes())
            pieces_.frombytes(piece.astype(np.int32).tobytes())
            pairs.append(self._pair_numbers(start, size, piece, places, ends))
        ready = np.concatenate(pairs)
        ready.sort()
        first = array("i", np.cumsum(count, out=count).tobytes())
        after, before = np.full(n, -1, dtype=np.int32), np.full(n + 1, -1, dtype=np.int32)
        after[places], before[ends] = ends, places
        after, before = array("i", after.tobytes()), array("i", before.tobytes())
        del count, pairs, places, ends

        def known(a, b):
            for i in range(first[a], first[a + 1]):
                if sizes[i] == b - a:
                    return pieces_[i]
            return -1

        made: list[int] = []
        order = self.order

        def offer(a, m):
            if m < n:
                p = known(a, after[m])
                if p >= 0:
                    heapq.heappush(made, int(order[p]) << 42 | a << 10 | after[m] - a)

        at = 0
        while made or at < len(ready):
            if made and (at == len(ready) or made[0] < ready[at]):
                number = heapq.heappop(made)
            else:
                number = int(ready[at])
                at += 1
            a = number >> 10 & 0xFFFFFFFF
            b = a + (number & 0x3FF)
            m = after[a]
            if m < 0 or m >= n or after[m] != b:
                continue
            after[a], before[b] = b, a
            after[m] = -1
            if a:
                offer(before[a], a)
            offer(a, b)
        out = array("I")
        a = 0
        while a < n:
            b = after[a]
            p = known(a, b)
            if p >= 0:
                out.append(self.ids[p])
            else:
                out.extend(self.bytes_[0 if x == 0xFE else x] for x in data[a:b])
            a = b
        return np.array(out, dtype="<u4").tobytes()

    def _pair_numbers(self, start, size, piece, places, ends) -> np.ndarray:
        """The numbers of those occurrences that are two neighbouring characters."""
        i = np.searchsorted(places, start)
        i[i == len(places)] = 0
        two = (places[i] == start) & (i + 1 < len(places))
        start, size, piece, i = start[two], size[two], piece[two], i[two]
        two = ends[i + 1] == start + size
        return self.order[piece[two]] << 42 | start[two] << 10 | size[two]

    def _relax_bpe(self, segment: str, edges: list[tuple[int, int, int]]) -> list[int]:
        places = self._places(segment)
        known = {(a, b): p for a, b, p in edges}
        whole = known.get((0, places[-1]))
        if len(places) == 2:
            return self._ids(segment, places, [(0, places[-1], whole)])
        after = dict(zip(places, places[1:]))  # each symbol: where it starts, where it ends
        before = dict(zip(places[1:], places))
        queue = []

        def offer(a, m):
            b = after.get(m)
            piece = None if b is None else known.get((a, b))
            if piece is not None:
                heapq.heappush(queue, (-self.score[piece], a, m, b))

        for a in places[:-2]:
            offer(a, after[a])
        while queue:
            _, a, m, b = heapq.heappop(queue)
            if after.get(a) != m or after.get(m) != b:
                continue
            after[a], before[b] = b, a
            del after[m], before[m]
            if a in before:
                offer(before[a], a)
            offer(a, b)
        return self._ids(segment, places, [(a, after[a], known.get((a, after[a]))) for a in sorted(after)])

    def _relax_unigram(self, segment: str, edges: list[tuple[int, int, int]]) -> list[int]:
        places = self._places(segment)
        unknown = min(self.score) - 10
        best = {0: (0.0, None, None)}
        more = sorted([*edges, *((a, b, None) for a, b in zip(places, places[1:]))], key=lambda x: x[0])
        for a, b, piece in more:
            if a in best:
                total = best[a][0] + (unknown if piece is None else self.score[piece])
                if b not in best or total > best[b][0]:
                    best[b] = (total, a, piece)
        joins, at = [], places[-1]
        while at:
            _, a, piece = best[at]
            joins.append((a, at, piece))
            at = a
        return self._ids(segment, places, joins[::-1])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; '' has none."""
        cut = [_SEGMENT.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self._cache) > CACHE_SEGMENTS:
            self._cache, self._old = {}, self._cache
        cache = self._cache
        new = []
        for s in set().union(*cut).difference(cache) if cut else ():
            if s in self._old:
                cache[s] = self._old[s]
            else:
                new.append(s)
        long = {x: self._encode_long(x) for x in new if len(x) > KEPT}
        cache.update(self._encode_new([x for x in new if x not in long]))
        return [b"".join(map((cache | long if long else cache).__getitem__, c)) for c in cut]

    def _encode_long(self, segment: str) -> bytes:
        """The ids of a long segment, part by part."""
        cuts = self._cuts(segment)
        known = self._encode_new(list(dict.fromkeys(segment[a:b] for a, b in zip(cuts, cuts[1:]))))
        return b"".join(known[segment[a:b]] for a, b in zip(cuts, cuts[1:]))

    def _encode_new(self, segments: list[str]) -> dict[str, bytes]:
        """The ids of each of these distinct segments; one suffix array covers at most some ``WINDOW`` bytes of them."""
        out: dict[str, bytes] = {}

        def plain(part):
            return [np.array(i, dtype="<u4").tobytes() for i in self.encode_segments(part)]

        short = [x for x in segments if len(x) <= SHORT] if self.bpe else []
        some = [x for x in segments if not self.bpe or SHORT < len(x) <= KEPT]
        for encode, mine, most in ((self._relax_short, short, WINDOW), (plain, some, WINDOW // 2)):
            for part in _batches(mine, most):
                out.update(zip(part, encode(part)))
        if self.bpe:
            out.update((x, self._relax_long(x)) for x in segments if len(x) > KEPT)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids; runs of byte pieces are read as UTF-8, broken ones as U+FFFD."""
        if not hasattr(self, "_raw"):
            self._raw = [bytes([self.byte_of[i]]) if i in self.byte_of else p.replace(MARK, " ").encode() for i, p in enumerate(self.all_pieces)]
        slices = (ids[i:i + WINDOW].tolist() for i in range(0, len(ids), WINDOW))
        text = b"".join(b"".join(map(self._raw.__getitem__, x)) for x in slices).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _batches(segments: list[str], most: int) -> Iterator[list[str]]:
    """Consecutive batches of at most ``most`` bytes, or of one longer segment."""
    size, part = 0, []
    for x in segments:
        n = len(x) if x.isascii() else 3 * len(x)
        if part and size + n > most:
            yield part
            size, part = 0, []
        part.append(x)
        size += n + 1
    if part:
        yield part


_MODELS: dict[str, Pieces] = {}


def pieces(file: str) -> Pieces:
    """One model for each process and file."""
    if file not in _MODELS:
        _MODELS[file] = Pieces.load(file)
    return _MODELS[file]


def encode_and_decode(df: DataFrame, key: str, text: str, file: str) -> DataFrame:
    """(key, ids, decoded, round_trip) of every whole text.

    ``ids`` are little-endian unsigned 32-bit integers, ``decoded`` is the text
    that they decode to, and ``round_trip`` says that it is the
    text, where a word mark in a text reads as a space.  A null text reads as ''
    and has no ids; a text of any length is encoded whole, its memory in
    proportion to it.  Each row, with a null or repeated key too, gives one row;
    an empty table gives none.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(file)
        for batch in batches:
            for first, part in text_slices(batch.column(1).to_pylist()):
                ids = model.encode(part)
                back = [model.decode(np.frombuffer(x, "<u4")) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), pa.array(ids, pa.binary()), pa.array(back, pa.string()),
                     pa.array([b == t.replace(MARK, " ") for b, t in zip(back, part)])],
                    names=["key", "ids", "decoded", "round_trip"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return arrow_map(rows, run, f"key {kind}, ids binary, decoded string, round_trip boolean").withColumnRenamed("key", key)
