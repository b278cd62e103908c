"""Runs of repeated words: stretches of at least four periods, and texts with the repetition taken out.

A run of period q and at least 4q words holds a multiple of 3q that agrees with the word q further
on. So the grid of these multiples, for all q, has every run on it with n log n points in all. Where the
words agree, common extensions to both sides give the run's bounds. They come from direct
comparison for up to 30 words, and beyond from a sorted sample of the suffixes (see ``lce``), which is
built for just the texts where something agrees that far. Multiples of a run's period give the
same bounds, of which the least period stays.

A text is worked on as a whole, in memory of some hundred bytes a word; nothing is shuffled.

Defined cases: null and empty texts have no words and no runs; a null id never rewrites; repeated rows are
each worked on; other columns are not used; of runs with the same exponent the first, then the shortest period,
counts as greatest; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.lce import PERIOD, CommonExtensions, agreeing
from millrace.llm.words import in_slices

#: A run has at least so many words, and so many times its period.
MIN_WORDS, MIN_PERIODS = 6, 4
_POINTS = 1 << 21  # grid points that are looked at together

_SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string, starts array<long>, lengths array<long>, periods array<long>")


def words_of_text(text: str | None) -> list[bytes]:
    """Runs of bytes other than blanks and ASCII controls 9 to 13."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def made_periodic(words: list, doc_id: int | None) -> list:
    """Words of every tenth id, by its checksum, repeat themselves from some place on."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times, rest = divmod(n - a, p)
    return words[:a] + words[a:a + p] * times + words[a:a + rest]


def _grid(sizes: np.ndarray, origins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of all grid points, in blocks: multiples of 3q, for each period q that fits four times."""
    periods = np.where(sizes >= MIN_WORDS, sizes // MIN_PERIODS, 0)
    ends = np.cumsum(periods)
    done = 0
    while done < (ends[-1] if len(ends) else 0):
        upto = min(done + (_POINTS >> 3), int(ends[-1]))
        pair = np.arange(done, upto)
        text = np.searchsorted(ends, pair, side="right")
        q = pair - (ends[text] - periods[text]) + 1
        gap = (MIN_PERIODS - 1) * q
        points = (sizes[text] - q + gap - 1) // gap
        for lo, hi in _blocks(points):
            many = points[lo:hi]
            k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            of = np.repeat(np.arange(lo, hi), many)
            yield text[of], origins[text[of]] + k * gap[of], q[of]
        done = upto


def _blocks(points: np.ndarray) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(points)
    lo = 0
    while lo < len(points):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _POINTS, side="right")))
        yield lo, hi
        lo = hi


def runs_of(codes: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, by start, then period.

    ``codes`` are the texts' words as non-negative integers.
    """
    sizes = np.array([len(c) for c in codes], np.int64)
    if not sizes.size:
        return []
    origins = np.cumsum(sizes + 1) - sizes  # a code of its own before each text, and one after the last
    joined = np.empty(origins[-1] + sizes[-1] + 1, np.int64)
    borders = np.append(origins - 1, len(joined) - 1)
    for at, c in zip(origins, codes):
        joined[at:at + len(c)] = c
    joined[borders] = -2 - np.arange(len(borders))
    mirrored = joined[::-1].copy()
    last, near = len(joined) - 1, PERIOD - 1
    found, far = [], []
    for text, i, q in _grid(sizes, origins):
        keep = np.flatnonzero(joined[i] == joined[i + q])
        text, i, q = text[keep], i[keep], q[keep]
        enough = np.full(len(i), near)
        after = agreeing(joined, i, i + q, enough)
        before = agreeing(mirrored, last - i + 1, last - i - q + 1, enough)
        unknown = (after == near) | (before == near)
        far.append(np.stack([text[unknown], i[unknown], q[unknown]]))
        found.append(np.stack([text, i - before, before + after + q, q])[:, ~unknown])
    if far and (pairs := np.concatenate(far, axis=1)).size:
        found.append(_extended(joined, sizes, origins, *pairs))
    out: list[list] = [[] for _ in codes]
    if not found:
        return out
    text, start, length, q = np.concatenate(found, axis=1)
    ok = length >= np.maximum(MIN_WORDS, MIN_PERIODS * q)
    text, start, length, q = text[ok], start[ok] - origins[text[ok]], length[ok], q[ok]
    order = np.lexsort((q, length, start, text))
    text, start, length, q = text[order], start[order], length[order], q[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, q = text[new], start[new], length[new], q[new]
    order = np.lexsort((q, start, text))
    for t, *run in zip(*(x[order].tolist() for x in (text, start, length, q))):
        out[t].append(tuple(run))
    return out


def _extended(joined, sizes, origins, text, i, q) -> np.ndarray:
    """Bounds from common extensions over the texts that need them."""
    wanted, of = np.unique(text, return_inverse=True)
    parts, shift, at = [], np.empty(len(wanted), np.int64), 0
    for k, t in enumerate(wanted.tolist()):
        part = joined[origins[t] - 1:origins[t] + sizes[t]]
        shift[k] = at - (origins[t] - 1)
        parts.append(part)
        at += len(part)
    own = np.concatenate([*parts, [np.iinfo(np.int64).min]])
    a = i + shift[of]
    last = len(own) - 1
    after = CommonExtensions(own)(a, a + q)
    before = CommonExtensions(own[::-1].copy())(last - a + 1, last - a - q + 1)
    return np.stack([text, i - before, before + after + q, q])


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words left when every run keeps its first period, joined by one blank."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    start, length, period = np.array(runs).T
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
    return b" ".join([words[i] for i in kept])


def _reported(doc_id: int | None, words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    start, length, period = zip(*runs) if runs else ((), (), ())
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    milli = None if top[0] is None else 1000 * top[1] // top[2]
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
    return (doc_id, len(words), len(runs), *top, milli, _digest(listed), _digest(collapsed(words, runs)),
            list(start), list(length), list(period))


def _batches(batches: Iterator[pa.RecordBatch], rewrite: bool) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _SCHEMA.split(", ")]
    types = [pa.int64()] * 7 + [pa.string()] * 2 + [pa.list_(pa.int64())] * 3
    for batch in batches:
        keys = batch.column("doc_id").to_pylist()
        for lo, texts in in_slices(batch.column("text")):
            ids = keys[lo:lo + len(texts)]
            words = [words_of_text(t.as_py()) for t in texts]
            if rewrite:
                words = [made_periodic(w, k) for w, k in zip(words, ids)]
            known: dict[bytes, int] = {}
            codes = [np.fromiter((known.setdefault(w, len(known)) for w in ws), np.int64, len(ws)) for ws in words]
            rows = [_reported(*row) for row in zip(ids, words, runs_of(codes))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def word_runs(docs: DataFrame, rewrite: bool = False) -> DataFrame:
    """Per document its runs (starts, lengths, periods), the one of greatest exponent, and digests.

    ``rewrite`` first makes every tenth document periodic (see ``made_periodic``).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda batches: _batches(batches, rewrite), _SCHEMA)
