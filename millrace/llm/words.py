"""Words of whole texts as 64-bit hashes, computed for a batch of texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_random = np.random.default_rng(20240607)
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_PLACES = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTES[_BLANK] = 0
_BYTES[ord("A"):ord("Z") + 1] = _BYTES[ord("a"):ord("z") + 1]  # the case of A-Z doesn't count
#: Bytes of text that are worked on at once.
AT_ONCE = 4 << 20


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit value for each, with all bits depending on all bits."""
    x = x + np.uint64((seed * _BASE + _BASE) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some texts: hashes, bytes where they begin and end, and each text's first word."""

    hashes: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one more than texts
    origin: np.ndarray  # byte at which each text begins

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of n words, and each text's first; shorter texts have none."""
        counts = np.diff(self.first)
        number = np.maximum(counts - n + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(number)])
        at = np.arange(bounds[-1]) + np.repeat(self.first[:-1] - bounds[:-1], number)
        total = np.zeros(len(at), np.uint64)
        for k in range(n):
            total += self.hashes[at + k] * _PLACES[k]
        return mixed(total, n), bounds


def words_of(texts: pa.Array) -> Words:
    """Maximal runs of characters other than blanks and ASCII controls 9 to 13; null is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
    bounds = bounds - bounds[0]
    inside = ~_BLANK[data]
    begin, end = inside.copy(), inside.copy()
    edges = bounds[1:-1][bounds[1:-1] < len(data)]
    begin[1:] &= ~inside[:-1]
    begin[edges] = inside[edges]
    end[:-1] &= ~inside[1:]
    edges = edges[edges > 0]
    end[edges - 1] = inside[edges - 1]
    begins, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    if not len(begins):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(bounds), np.int64), bounds[:-1])
    sizes = ends - begins
    powers = np.full(int(np.diff(np.append(begins, len(data))).max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    place = np.arange(begins[0], len(data)) - np.repeat(begins, np.diff(np.append(begins, len(data))))
    sums = np.add.reduceat(_BYTES[data[begins[0]:]] * powers[place], begins - begins[0])
    return Words(mixed(sums + sizes.astype(np.uint64)), begins, ends, np.searchsorted(begins, bounds), bounds[:-1])


def in_slices(texts: pa.Array, size: int = AT_ONCE):
    """(first row, slice) of a batch, by bytes of text."""
    import pyarrow.compute as pc

    if not len(texts):
        return
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    cuts = np.searchsorted(sizes, np.arange(size, sizes[-1], size)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
        if lo < hi:
            yield lo, texts.slice(lo, hi - lo)


def shingle_sets(words: Words, n: int):
    """Sorted distinct shingles of each text; fewer than n words are one shingle, none are empty."""
    runs, bounds = words.runs(n)
    bounds = bounds.tolist()
    first = words.first.tolist()
    for i in range(len(first) - 1):
        if bounds[i] < bounds[i + 1]:
            yield np.unique(runs[bounds[i]:bounds[i + 1]])
        else:
            own = words.hashes[first[i]:first[i + 1]]
            m = len(own)
            yield mixed((own * _PLACES[:m]).sum(dtype=np.uint64)[None], 1000 + m) if m else own
