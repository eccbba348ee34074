"""Whole-text encoding with the ``tokenizers`` library, one call for each distinct chunk.

Both byte-level and word-end BPE split a text before any merge, never across
the places used here: a space or newline between two visible characters.
Texts are cut there and their chunks numbered by Arrow, some megabytes of texts
at a time; chunks seen before come from a bounded cache, only new ones go
through the library, and the ids of all texts are then laid out in one step.
The cache is two Arrow arrays, chunks and their ids: some tens of bytes a chunk.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import KEPT, text_slices
from .runs import runs

_WHITE = r"\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: What needs the slower cut: white space next to white space, or of another kind.
_ODD = r"[ \n][ \n]|[\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Chunks without white space at an end, but for one space before them.
_TIGHT = rf"^ ?[^{_WHITE}](?s:.*[^{_WHITE}])?$"
#: Letters that lower case or NFC make a letter and a mark of, which belongs to what follows.
_TWO = (r"\x{130}\x{958}-\x{95f}\x{9dc}\x{9dd}\x{9df}\x{a33}\x{a36}\x{a59}-\x{a5b}\x{a5e}\x{b5c}\x{b5d}\x{f43}\x{f4d}\x{f52}\x{f57}\x{f5c}\x{f69}"
        r"\x{fb1d}\x{fb1f}\x{fb2a}-\x{fb36}\x{fb38}-\x{fb3c}\x{fb3e}\x{fb40}\x{fb41}\x{fb43}\x{fb44}\x{fb46}-\x{fb4e}")
#: Other letters, after a space or not.
_WORD = rf"^ ?[^\P{{L}}{_TWO}]+"
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=\S\n)(?=\S)")
#: The mark between chunks; a text that holds it is not cut.
_MARK = "\x00"
#: Bytes of chunks and ids that the cache may hold between calls.
CACHE_BYTES = 16 << 20
#: Characters encoded in one call: the more, the fewer chunks are looked up again.
CALL_CHARS = 2_000_000
#: Chunks joined to one text for the library, and handed over at a time.
_GROUP, _CALL = 128, 1 << 14
_IDS = pa.list_(pa.uint32())


class CachedEncoder:
    """Encodes texts to ids as ``Tokenizer.encode(text, add_special_tokens=False)`` does.

    The strings of the file's added tokens are those tokens wherever they stand
    in a text, as in the library; with ``added_as_text`` they are ordinary text.
    """

    def __init__(self, file: str, added_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = added_as_text
        self.added = [] if added_as_text else [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._reset()

    def _reset(self) -> None:
        self.chunks, self.ids = pa.array([""], pa.string()), pa.array([[]], _IDS)
        self.again = np.zeros(1, dtype=bool)  # what later calls met again

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        ids, ends = self.encode_flat(texts)
        data, ends = ids.astype("<u4", copy=False).tobytes(), (4 * ends).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's end."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        marked, whole = self._marked(texts)
        lists = pc.split_pattern(marked, _MARK)
        ends = lists.offsets.to_numpy().astype(np.int64)
        first, ends = ends[:-1] - ends[0], ends[1:] - ends[0]
        coded = lists.flatten().dictionary_encode()
        at, ids = self._numbers(coded.dictionary)[coded.indices.to_numpy()], self.ids
        if whole:  # one chunk each, encoded by itself and not kept
            at[first[list(whole)]] = len(ids) + np.arange(len(whole))
            own = self.tokenizer.encode_batch(list(whole.values()), add_special_tokens=False)
            ids = pa.concat_arrays([ids, pa.array([e.ids for e in own], _IDS)])
        got = ids.take(pa.array(at))
        return got.values.to_numpy(), got.offsets.to_numpy().astype(np.int64)[ends]

    def _uncut(self, text: str) -> bool:
        if _MARK in text:
            return True
        if not self.added or "<" not in text and all("<" in t for t in self.added):
            return False
        text = text.lower()
        return any(t in text for t in self.added)

    def _marked(self, texts: list[str]) -> tuple[pa.Array, dict[int, str]]:
        """The texts with a mark at each cut; '' for those that aren't cut, which come by their place."""
        rows = pa.array(texts, pa.string())
        odd = pc.match_substring_regex(rows, _ODD).to_numpy(zero_copy_only=False)
        whole = {i: t for i, t in enumerate(texts) if self._uncut(t)}
        rows = pc.replace_substring(pc.replace_substring(rows, "\n", "\x00\n\x00"), " ", "\x00 ")
        odd[list(whole)] = True
        if odd.any():
            slow = ["" if i in whole else _MARK.join(_CUT.split(texts[i])) for i in np.flatnonzero(odd).tolist()]
            rows = pc.replace_with_mask(rows, pa.array(odd), pa.array(slow, pa.string()))
        return rows, whole

    def _numbers(self, chunks: pa.Array) -> np.ndarray:
        """The cache's numbers of distinct chunks; new ones are encoded."""
        if self.chunks.nbytes + self.ids.nbytes > CACHE_BYTES:  # numbers of earlier calls aren't used again
            self._forget()
        at = self._held(chunks)
        new = at < 0
        self.again[at[~new]] = True
        if new.any():
            at[new] = self._learn(chunks.filter(pa.array(new)))
        return at

    def _held(self, chunks: pa.Array) -> np.ndarray:
        """The cache's number of each of distinct chunks, or -1."""
        which = pc.index_in(self.chunks, value_set=chunks)  # hashes the call's chunks, not all that are held
        at = np.full(len(chunks), -1, dtype=np.int64)
        at[which.drop_null().to_numpy()] = np.flatnonzero(which.is_valid().to_numpy(zero_copy_only=False))
        return at

    def _forget(self) -> None:
        """Drops what no later call met again, or all if the rest is more than half."""
        self.again[0] = True  # '' stays
        keep = pa.array(self.again)
        self.chunks, self.ids = self.chunks.filter(keep), self.ids.filter(keep)
        self.again = np.zeros(len(self.chunks), dtype=bool)
        if self.chunks.nbytes + self.ids.nbytes > CACHE_BYTES // 2:
            self._reset()

    def _learn(self, chunks: pa.Array) -> np.ndarray:
        """Encodes and keeps new chunks; their numbers."""
        # ASCII punctuation after letters is a chunk of its own to the tokenizers
        word = pc.ascii_rtrim(chunks, characters=string.punctuation)
        ended = pc.and_(pc.less(pc.binary_length(word), pc.binary_length(chunks)), pc.match_substring_regex(word, _WORD + "$"))
        at = np.empty(len(chunks), dtype=np.int64)
        two = ended.to_numpy(zero_copy_only=False)
        plain = chunks.filter(pc.invert(ended))
        at[~two] = self._keep(plain, self._encoded(plain))
        if two.any():
            whole = chunks.filter(ended)
            parts = pa.concat_arrays([word.filter(ended), pc.replace_substring_regex(whole, _WORD, "", max_replacements=1)]).dictionary_encode()
            number = self._held(parts.dictionary)
            fresh = parts.dictionary.filter(pa.array(number < 0))
            number[number < 0] = self._keep(fresh, self._encoded(fresh))
            both = self.ids.take(pa.array(number[parts.indices.to_numpy()].reshape(2, -1).T.reshape(-1)))
            at[two] = self._keep(whole, pa.ListArray.from_arrays(pa.array(both.offsets.to_numpy()[::2]), both.values))
        return at

    def _keep(self, chunks: pa.Array, ids: pa.Array) -> np.ndarray:
        n = len(self.chunks)
        self.chunks, self.ids = pa.concat_arrays([self.chunks, chunks]), pa.concat_arrays([self.ids, ids])
        self.again = np.concatenate([self.again, np.zeros(len(chunks), dtype=bool)])
        return np.arange(n, n + len(chunks))

    def _encoded(self, chunks: pa.Array) -> pa.Array:
        """The ids of each chunk.

        Many go into one call of the library, with a cut between any two of
        them, and get those ids back that stand for their characters; chunks
        with white space at an end go by themselves.
        """
        tight = pc.match_substring_regex(chunks, _TIGHT)
        spaced = pc.and_(tight, pc.starts_with(chunks, " "))
        kinds = [np.flatnonzero(k.to_numpy(zero_copy_only=False)) for k in (pc.invert(tight), spaced, pc.and_not(tight, spaced))]
        alone = self.tokenizer.encode_batch_fast(chunks.take(pa.array(kinds[0])).to_pylist(), add_special_tokens=False)
        ids, sizes = [np.array(e.ids, dtype=np.uint32) for e in alone], [np.array([len(e.ids) for e in alone], dtype=np.int64)]
        for kind, between in zip(kinds[1:], ("", "\n")):
            words = chunks.take(pa.array(kind))
            length = pc.utf8_length(words).to_numpy().astype(np.int64)
            for i in range(0, len(words), _CALL):
                joined = pc.binary_join(pa.ListArray.from_arrays(_fences(len(words[i:i + _CALL])), words[i:i + _CALL]), between).to_pylist()
                for k, e in zip(range(i, i + _CALL, _GROUP), self.tokenizer.encode_batch(joined, add_special_tokens=False)):
                    size = length[k:k + _GROUP]
                    start = np.fromiter(chain.from_iterable(e.offsets), np.int64, 2 * len(e))[::2]
                    begin = np.cumsum(size + len(between)) - size - len(between)
                    first = np.searchsorted(start, begin)
                    sizes.append(np.searchsorted(start, begin + size) - first)
                    ids.append(np.array(e.ids, dtype=np.uint32)[runs(first, sizes[-1])])
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        in_turn = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.uint32()))
        return in_turn.take(pa.array(np.argsort(np.concatenate(kinds))))


def _fences(n: int) -> pa.Array:
    return pa.array([*range(0, n, _GROUP), n], pa.int32())


def encoder(file: str) -> CachedEncoder:
    """One encoder for each file, kept in a worker while it runs tasks of the same operator."""
    name = f"encoder {file}"
    if name not in KEPT:
        KEPT[name] = CachedEncoder(file)
    return KEPT[name]


def encoded_rows(batches: Iterator[pa.RecordBatch], encode: CachedEncoder) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """(keys, ids) of batches (key, text): each row's key and its text's ids, some megabytes of texts at a time; null reads as ''."""
    held: list[pa.RecordBatch] = []
    size = 0

    def part() -> Iterator[tuple[pa.Array, list[bytes]]]:
        keys = pa.concat_arrays([b.column(0) for b in held])
        for first, texts in text_slices([t for b in held for t in b.column(1).to_pylist()], CALL_CHARS):
            yield keys.slice(first, len(texts)), encode.encode(texts)

    for batch in batches:
        held.append(batch)
        size += batch.column(1).nbytes
        if size >= CALL_CHARS:
            yield from part()
            held, size = [], 0
    if held:
        yield from part()
