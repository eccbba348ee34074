"""Word shingles of many texts at once, as 64-bit hashes (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draw(seed: np.ndarray, n: int) -> np.ndarray:
    """The n-th random 64-bit integer of each seed."""
    return mix(seed + np.uint64(int(_GOLD) * n % (1 << 64)))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)  # a random number for each byte
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[128:] = True
for _c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _IN_WORD[_c] = True
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for up to the longest batch seen."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        size = 1 << (n - 1).bit_length()
        _POWERS[0] = tuple(np.cumprod(np.append(np.uint64(1), np.full(size - 1, b, dtype=np.uint64)), dtype=np.uint64)
                           for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    return _POWERS[0]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document number, hash) of each word, in order.

    A word is a run of ASCII letters and digits and characters beyond ASCII,
    in lower case.
    """
    data = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b" ".join([b"", *data, b""]), dtype=np.uint8)
    inside = _IN_WORD[raw]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = change[::2], change[1::2]
    power, inverse = _powers(len(raw))
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * power[:len(raw)], out=total[1:])
    words = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * _GOLD)
    ends = np.cumsum([len(d) + 1 for d in data])
    return np.searchsorted(ends, start, side="right"), words


def shingle_sets(texts: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, shingle hash, count) of each document's distinct runs of ``width`` words, sorted.

    A text of fewer words has one shingle, of all its words; one without words has none.
    """
    doc, words = word_hashes(texts)
    sizes = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(sizes) - sizes
    salt = [np.uint64((2 * i + 1) * int(_GOLD) % (1 << 64)) for i in range(width)]
    n = len(words) - width + 1
    parts = []
    if n > 0:
        at = np.flatnonzero(doc[:n] == doc[width - 1:])
        h = np.zeros(len(at), dtype=np.uint64)
        for i in range(width):
            h += mix(words[at + i] ^ salt[i])
        parts.append((doc[at], mix(h)))
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    if len(short):
        h = np.zeros(len(short), dtype=np.uint64)
        for i in range(width - 1):
            has = sizes[short] > i
            h[has] += mix(words[first[short[has]] + i] ^ salt[i])
        parts.append((short, mix(h + _GOLD)))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    doc = np.concatenate([p[0] for p in parts])
    h = np.concatenate([p[1] for p in parts])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(h)))
