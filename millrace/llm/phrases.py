"""Document fingerprints from Lempel-Ziv phrases.

A text's bytes are parsed into phrases, each the shortest one not met before in the text
(LZ78). The set of phrases is what a compressor would learn from it. Their hashes' smallest
ones are the fingerprint, and the share of these that two texts have in common estimates the
Jaccard similarity of their phrase sets, which is high where one text compresses the other.

Defined cases: null and empty texts have the empty fingerprint, alike to itself (1) and to
no other (0); sets of fewer phrases than a fingerprint holds are compared exactly.
"""

from __future__ import annotations

import hashlib
from base64 import b64decode, b64encode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import mixed
from millrace.sources.staging import stage

#: Hashes in a fingerprint.
SIZE = 128
_random = np.random.default_rng(19780901)
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.cumprod(np.append(np.uint64(1), np.full(4095, _BASE)), dtype=np.uint64)


class Parse:
    """Phrases of bytes, where parsing can go on and be taken back."""

    def __init__(self):
        self.known: dict[int, int] = {}
        self.node = self.at = 0
        self.ends: list[int] = []

    def feed(self, data: bytes) -> list[int]:
        """Parse on; returns what ``undo`` needs."""
        known, ends, node, number = self.known, self.ends, self.node, len(self.known)
        get, added = known.get, []
        for i, b in enumerate(data, self.at + 1):
            key = node << 8 | b
            node = get(key)
            if node is None:
                number += 1
                known[key] = number
                added.append(key)
                ends.append(i)
                node = 0
        self.node, self.at = node, self.at + len(data)
        return added

    def undo(self, added: list[int], node: int, at: int) -> None:
        for key in added:
            del self.known[key]
        del self.ends[len(self.ends) - len(added):]
        self.node, self.at = node, at

    def signature(self, data: bytes) -> np.ndarray:
        """Smallest hashes of the phrases of ``data``, all of which was fed."""
        if not self.ends:
            return np.zeros(0, "<u4")
        ends = np.array(self.ends)
        begins = np.concatenate([[0], ends[:-1]])
        raw = np.frombuffer(data, np.uint8)[:ends[-1]]
        place = np.arange(len(raw)) - np.repeat(begins, ends - begins)
        powers = _powers if place.max() < len(_powers) else np.cumprod(
            np.append(np.uint64(1), np.full(int(place.max()), _BASE)), dtype=np.uint64)
        hashes = mixed(np.add.reduceat(_BYTES[raw] * powers[place], begins)) >> np.uint64(32)
        if len(hashes) > SIZE + 16:
            hashes = np.partition(hashes, SIZE + 15)[:SIZE + 16]
        return np.unique(hashes)[:SIZE].astype("<u4")


def fingerprint(text: str | None) -> np.ndarray:
    """Fingerprint of one text."""
    parse, data = Parse(), (text or "").encode()
    parse.feed(data)
    return parse.signature(data)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of two phrase sets, 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    every, counts = np.unique(np.concatenate([a, b]), return_counts=True)
    return float((counts[:SIZE] == 2).mean())


def as_text(signature: np.ndarray) -> str:
    return b64encode(signature.astype("<u4").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(b64decode(text), "<u4")


def with_fingerprints(frame: DataFrame, text: str = "text") -> DataFrame:
    """``frame`` with a column fingerprint (replaced, if it has one)."""
    one = F.arrow_udf(lambda texts: pa.array([as_text(fingerprint(t)) for t in texts.to_pylist()], pa.string()), "string")
    return frame.withColumn("fingerprint", one(text))


_EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _below(column: Column, bounds: list, first: int) -> Column:
    """Number of bounds above the value, counted on from ``first``; ``bounds`` descend."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(column >= bounds[middle], _below(column, bounds[:middle], first)).otherwise(
        _below(column, bounds[middle + 1:], first + middle + 1))


def edited_fingerprints(documents: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its text with its last third replaced by the
    beginning of the next document (in descending id, the first after the last), and how
    near they and the next one's are.

    Texts are dealt out once, by ranges of the id; the first document of each range is also
    sent to the range before it. Repeated ids follow in the order of their texts, null ids
    come last.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = rows.where("doc_id IS NOT NULL").approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts)
    bounds = sorted({int(b) for b in bounds}, reverse=True)
    part = F.coalesce(_below(F.col("doc_id"), bounds, 0), F.lit(len(bounds)))
    rows = rows.withColumn("part", part)
    firsts = sorted((r.part, r.first) for r in rows.groupBy("part").agg(F.max("doc_id").alias("first")).collect())
    if not firsts:
        return spark.createDataFrame([], _EDITED)
    next_of = [(p, firsts[(i + 1) % len(firsts)][1]) for i, (p, _) in enumerate(firsts)]
    heads = F.broadcast(spark.createDataFrame(next_of, "for int, id long"))  # one row for each range
    guests = (rows.join(heads, F.col("doc_id").eqNullSafe(F.col("id"))).groupBy(F.col("for").alias("part"))
              .agg(F.min(F.struct("text", "doc_id")).alias("one")))
    guests = stage(guests.select("part", F.col("one.doc_id").alias("doc_id"), F.col("one.text").alias("text")), "guests")
    every = rows.select("part", "doc_id", "text", F.lit(False).alias("guest")).union(
        guests.select("part", "doc_id", "text", F.lit(True)))
    dealt = every.repartition("part").sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            out = []
            for place, doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("part", "doc_id", "text")]):
                one = _Edited(place, doc_id, text)
                if before is not None and before.part == place:
                    out.append(before.row(one))
                before = one
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return dealt.mapInArrow(read, _EDITED)


_ARROW = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[t])
                    for n, t in (f.split() for f in _EDITED.split(", "))])


class _Edited:
    """A document that waits for the next one, parsed up to where the edit begins."""

    def __init__(self, part: int, doc_id: int | None, text: str):
        self.part, self.doc_id, self.text = part, doc_id, text
        self.kept = len(text) - len(text) // 3
        self.start = text[:self.kept].encode()
        self.parse = Parse()
        self.parse.feed(self.start)
        tail, node, at = text[self.kept:].encode(), self.parse.node, self.parse.at
        added = self.parse.feed(tail)
        self.signature = self.parse.signature(self.start + tail)
        self.parse.undo(added, node, at)

    def row(self, following: _Edited) -> dict:
        tail = following.text[:len(self.text) - self.kept].encode()
        self.parse.feed(tail)
        edited = self.start + tail
        signature = self.parse.signature(edited)
        return {"doc_id": self.doc_id, "n_chars": len(self.text), "edited_sha256": hashlib.sha256(edited).hexdigest(),
                "fingerprint": as_text(self.signature), "edited_fingerprint": as_text(signature),
                "near_edited": likeness(self.signature, signature),
                "near_next": likeness(self.signature, following.signature)}
