"""Texts cut into the pieces that byte-level BPE merges within, on whole arrays.

The pieces are the matches of the pattern that public byte-level tokenizers
share: contractions, runs of letters, of numbers and of other characters, each
with one space before it, and runs of white space. ``encode`` has every
distinct piece of a slice encoded once and puts the texts' ids together.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np

LETTER, NUMBER, SPACE = 1, 2, 3  # other characters: 0
#: What may follow an apostrophe as a piece of its own.
SHORT, LONG = "stmd", ("re", "ve", "ll")
#: Distinct pieces that a Python worker remembers; it starts anew beyond that.
REMEMBERED = 2_000_000


@lru_cache(1)
def _classes() -> np.ndarray:
    import regex

    every = "".join(map(chr, range(0x110000)))
    out = np.zeros(0x110000, np.uint8)
    for pattern, k in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, every):
            out[m.start():m.end()] = k
    return out


@lru_cache(1)
def _weights() -> np.ndarray:
    return np.random.default_rng(2).integers(0, 2**64, 0x110000, np.uint64)


@lru_cache(4)
def _places(n: int) -> np.ndarray:
    return np.random.default_rng(3).integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def hashes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run values[starts[i]:starts[i + 1]]; values are weights."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = np.diff(starts, append=len(values))
    place = np.arange(len(values), dtype=np.int32) - np.repeat(starts.astype(np.int32), lens)
    most = 1 << max(10, int(lens.max()).bit_length())
    h = np.add.reduceat(values * _places(most)[place], starts)
    h ^= lens.astype(np.uint64)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def pieces(raw: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """(all texts as one string, its code points, first code point of each piece, text of each piece)."""
    text = raw.tobytes().decode()
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = len(points)
    if not n:
        return text, points, np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n == len(raw):
        first = offsets
    else:
        first = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offsets]
    kind = _classes()[points]
    edge = np.zeros(n + 1, bool)
    edge[first] = True  # texts begin here, or all end
    mark = edge[:n].copy()
    mark[1:] |= kind[1:] != kind[:-1]
    begin = np.flatnonzero(mark)
    end = np.append(begin[1:], n)
    inside = ~edge[end]  # something follows in the same text
    joined = np.zeros(n + 1, bool)  # runs that take the space before them

    blank = (kind[begin] == SPACE) & inside
    last = end[blank] - 1
    plain = points[last] == 32
    mark[last] = True
    mark[last[plain] + 1] = False
    joined[last[plain] + 1] = True

    quote = begin[(points[begin] == 39) & (end - begin == 1) & inside & ~joined[begin]]
    quote = quote[kind[quote + 1] == LETTER]
    a = points[quote + 1]
    b = np.where((quote + 2 < n) & ~edge[np.minimum(quote + 2, n)], points[np.minimum(quote + 2, n - 1)], 0)
    two = np.zeros(len(quote), bool)
    for x in LONG:
        two |= (a == ord(x[0])) & (b == ord(x[1]))
    one = np.isin(a, [ord(x) for x in SHORT])
    for chosen, k in ((one, 1), (two, 2)):
        at = quote[chosen]
        mark[at + 1] = False
        after = at + 1 + k
        mark[after[after < n]] = True

    starts = np.flatnonzero(mark)
    return text, points, starts, np.searchsorted(first, starts, "right") - 1


class Known:
    """Ids of the pieces a worker has met, by the pieces' hashes."""

    def __init__(self, most: int = REMEMBERED):
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.keys, self.at, self.size, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def missing(self, keys: np.ndarray) -> np.ndarray:
        """Positions in ``keys`` (sorted) that are not known; forgets all if they don't fit."""
        if len(self.keys) + len(keys) > self.most:
            self._clear()
        if not len(self.keys):
            return np.arange(len(keys))
        return np.flatnonzero(self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] != keys)

    def add(self, keys: np.ndarray, ids: list[bytes]) -> None:
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        at = np.cumsum(size) - size + len(self.flat)
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), "<u4")])
        place = np.searchsorted(self.keys, keys)
        self.at, self.size = np.insert(self.at, place, at), np.insert(self.size, place, size)
        self.keys = np.insert(self.keys, place, keys)

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.keys, keys)
        return self.at[k], self.size[k]


def encode(raw: np.ndarray, offsets: np.ndarray, known: Known,
           encode_words: Callable[[list[str]], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts as uint32, number of ids of each text). ``encode_words``
    gives a piece's ids as little-endian uint32."""
    n = len(offsets) - 1
    text, points, starts, owner = pieces(raw, offsets)
    if not len(starts):
        return np.zeros(0, np.uint32), np.zeros(n, np.int64)
    keys, first, which = np.unique(hashes(_weights()[points], starts), return_index=True, return_inverse=True)
    fresh = known.missing(keys)
    if len(fresh):
        a = starts[first[fresh]]
        b = np.append(starts[1:], len(points))[first[fresh]]
        known.add(keys[fresh], encode_words([text[i:j] for i, j in zip(a.tolist(), b.tolist())]))
    at, sizes = known.lookup(keys)
    size = sizes[which]
    ids = known.flat[np.repeat(at[which] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
    return ids, np.bincount(owner, size, n).astype(np.int64)
