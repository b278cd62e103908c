"""Packing of token pieces into sequences by vector best fit.

Documents are cut into pieces of at most the capacity. A sequence has several residual
capacities: tokens, documents and attention cost (squared lengths in whole blocks). Longest pieces first,
each goes into the open sequence that is best under every constraint, by the least residual
norm or the largest weighted dot product of piece and residual; if none can take it, a new
one is opened.

What a piece needs depends on its length alone, and what a sequence can take on its residuals
alone, so pieces of one length and sequences in one state are placed together: the plan is
made from the number of pieces of each length, at most ``capacity`` numbers. By the residual norm it fills
sequences as if all pieces had been placed one by one; by the dot product single sequences may be filled
otherwise, as pieces of one length go into the best state together. Pieces then find their places by
their rank among the pieces of their length, counted per stored part.

Defined cases: null text is an empty document (its end id only); repeated rows and ids are
packed each by itself; other columns are not used; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tokens import encoder, with_end
from millrace.sources.staging import stage


@dataclass(frozen=True)
class Capacity:
    """Limits of one sequence. Attention cost is the sum of squared piece lengths, each rounded up to whole blocks.

    With blocks of one token the attention limit is as good as that of tokens; kernels that work in
    blocks of, say, 128 make many short pieces dearer than a long one.
    """

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    block: int = 1
    rule: str = "norm"  # or "dot"
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)

    def __post_init__(self):
        if self.documents < 1 or self.attention < self.cost(self.tokens):
            raise ValueError("a sequence must be able to take a piece of full length")

    def cost(self, length: int) -> int:
        """Attention cost of one piece."""
        return (-(-length // self.block) * self.block) ** 2


#: One step of a plan: ``count`` pieces of a length, from a rank on, ``each`` to a sequence, from sequence ``first`` on.
STEP = np.dtype([("length", "<i8"), ("rank", "<i8"), ("each", "<i8"), ("first", "<i8"), ("offset", "<i8")])


def plan(counts: dict[int, int], limits: Capacity) -> np.ndarray:
    """Steps for all pieces, ordered by length and rank."""
    size = np.array([limits.tokens, limits.documents, limits.attention], float)
    weights = np.array(limits.weights)
    opened = 0
    states: dict[tuple[int, int, int], list[tuple[int, int]]] = defaultdict(list)  # residuals: runs of sequences
    steps = []
    for length in sorted(counts, reverse=True):
        need, left, rank = (length, 1, limits.cost(length)), counts[length], 0
        while left:
            keys = list(states)
            best = None
            if keys:
                r = np.array(keys)
                fits = (r >= need).all(1)
                if fits.any():
                    if limits.rule == "dot":
                        score = -((r / size) * (np.array(need) / size) * weights).sum(1)
                    else:
                        score = ((((r - need) / size) ** 2) * weights).sum(1)
                    best = keys[int(np.argmin(np.where(fits, score, np.inf)))]
            if best is None:
                best = (limits.tokens, limits.documents, limits.attention)
                each = min(b // n for b, n in zip(best, need))
                run = (opened, max(1, left // each))
                opened += run[1]
                states[best].append(run)
                continue
            each = min(b // n for b, n in zip(best, need))
            first, n = states[best].pop()
            if left >= each:
                used, taken = min(n, left // each), each
            else:
                used, taken = 1, left
            steps.append((length, rank, taken, first, limits.tokens - best[0]))
            after = tuple(b - taken * x for b, x in zip(best, need))
            if after[0] and after[1]:
                states[after].append((first, used))
            if used < n:
                states[best].append((first + used, n - used))
            elif not states[best]:
                del states[best]
            rank, left = rank + used * taken, left - used * taken
    return np.sort(np.array(steps, STEP), order=["length", "rank"])


def places(steps: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces, given by length and rank among those of the length."""
    wide = np.int64(1) << 48
    at = np.searchsorted(steps["length"] * wide + steps["rank"], length * wide + rank, "right") - 1
    step = steps[at]
    inner = rank - step["rank"]
    return step["first"] + inner // step["each"], step["offset"] + (inner % step["each"]) * length


_PIECES = ("part int, doc_id long, piece int, start long, length long, rank long, ids binary")


def cut_pieces(documents: DataFrame, vocabulary_path: str, tokens: int) -> DataFrame:
    """Stored pieces; ``rank`` counts the pieces of the same length in the same part."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(vocabulary_path).encode, np.zeros(tokens + 1, np.int64)
        for batch in batches:
            ids, bounds = with_end(*encode(batch.column("text")))
            total = np.diff(bounds)
            number = -(-total // tokens)
            of = np.repeat(np.arange(len(total)), number)
            piece = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
            length = np.minimum(tokens, total[of] - piece * tokens)
            order = np.argsort(length, kind="stable")
            sorted_ = length[order]
            rank = np.empty(len(of), np.int64)
            rank[order] = np.arange(len(of)) - np.searchsorted(sorted_, sorted_) + seen[sorted_]
            seen += np.bincount(length, minlength=tokens + 1)
            raw = ids.tobytes()
            at = (bounds[of] + piece * tokens) * 4
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(of), batch.column("part")[0].as_py(), np.int32)),
                batch.column("doc_id").take(pa.array(of)), pa.array(piece.astype(np.int32)),
                pa.array(piece * tokens), pa.array(length), pa.array(rank),
                pa.array([raw[a:b] for a, b in zip(at.tolist(), (at + 4 * length).tolist())], pa.binary()),
            ], names=[f.split()[0] for f in _PIECES.split(", ")])

    rows = documents.select(F.col("doc_id").cast("long"), "text").withColumn("part", F.spark_partition_id())
    return rows.mapInArrow(cut, _PIECES)


def packed(documents: DataFrame, vocabulary_path: str, limits: Capacity = Capacity()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the ids, of every piece."""
    pieces = stage(cut_pieces(documents, vocabulary_path, limits.tokens), "pieces")
    counts = stage(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most one row a length
    steps = plan({r.length: r.n for r in totals}, limits)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("base"))

    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        sequence, offset = places(steps, length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], names=["sequence_id", "offset"])

    find = F.arrow_udf(place, "sequence_id long, offset long")
    return ranked.withColumn("_place", find("length", "rank")).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "_place.sequence_id", "_place.offset", "ids")
