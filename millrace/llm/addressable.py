"""Directly addressable codes: variable-length integers with random access.

An integer is split into bytes, lowest first. Level k holds the k-th byte of every integer
that has one, a bitmap that says which of them go on at the next level, and a directory of
the ones before each block of the bitmap. The byte at position i of one level goes on at
position rank(i) of the next, so one integer costs a few look-ups, whatever stands before it.
"""

from __future__ import annotations

import numpy as np

BLOCK_BITS = 512
_MAGIC = 0x44414331


def pack(values: np.ndarray) -> bytes:
    """Code of unsigned 32-bit integers."""
    rest, levels = np.asarray(values, "<u4"), []
    while True:
        later = rest >> 8
        more = later > 0
        levels.append((rest.astype(np.uint8), more))
        if not more.any():
            break
        rest = later[more]
    out = [np.array([_MAGIC, len(levels), *(len(low) for low, _ in levels)], "<u4").tobytes()]
    for k, (low, more) in enumerate(levels):
        out.append(low.tobytes())
        if k + 1 < len(levels):
            bits = np.packbits(more, bitorder="little")
            ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK_BITS), dtype="<u4")
            out += [bits.tobytes(), (np.cumsum(ones, dtype="<u4") - ones).astype("<u4").tobytes()]
    return b"".join(out)


class Addressable:
    """A packed sequence, read in place."""

    def __init__(self, code: bytes):
        magic, depth = np.frombuffer(code, "<u4", 2)
        if magic != _MAGIC:
            raise ValueError("not a directly addressable code")
        sizes = np.frombuffer(code, "<u4", int(depth), 8).tolist()
        at, self.levels = 8 + 4 * int(depth), []
        for k, n in enumerate(sizes):
            low, bits, ranks = np.frombuffer(code, np.uint8, n, at), None, None
            at += n
            if k + 1 < depth:
                bits = np.frombuffer(code, np.uint8, -(-n // 8), at)
                at += len(bits)
                ranks = np.frombuffer(code, "<u4", -(-n // BLOCK_BITS), at)
                at += 4 * len(ranks)
            self.levels.append((low, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def at(self, positions: np.ndarray) -> np.ndarray:
        """Integers at the given positions; no block is decoded."""
        where = np.asarray(positions, np.int64)
        out, active = np.zeros(len(where), np.uint32), np.arange(len(where))
        for k, (low, bits, ranks) in enumerate(self.levels):
            out[active] |= low[where].astype(np.uint32) << np.uint32(8 * k)
            if bits is None:
                break
            goes_on = (bits[where >> 3] >> (where & 7).astype(np.uint8)) & 1 == 1
            active, where = active[goes_on], self._rank(bits, ranks, where[goes_on])
        return out

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Ones before each position: those before its block, and those in it."""
        block = where // BLOCK_BITS
        width = BLOCK_BITS // 8
        at = block[:, None] * width + np.arange(width)
        inside = bits[np.minimum(at, len(bits) - 1)]
        full = at < (where >> 3)[:, None]
        last = bits[where >> 3] & ((1 << (where & 7)) - 1).astype(np.uint8)
        return (ranks[block].astype(np.int64) + (np.bitwise_count(inside) * full).sum(1, dtype=np.int64)
                + np.bitwise_count(last))

    def all(self) -> np.ndarray:
        """The whole sequence."""
        later = None
        for low, bits, _ in reversed(self.levels):
            values = low.astype("<u4")
            if bits is not None:
                more = np.unpackbits(bits, count=len(low), bitorder="little").astype(bool)
                values[more] |= later << np.uint32(8)
            later = values
        return later
