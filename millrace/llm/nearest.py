"""Exact nearest neighbours by a block matrix join on eight-bit vectors.

Every vector is stored in blocks: its components as eight-bit integers with one scale, the
length of what the rounding left over, and the original. A tile is a block of queries and a
block of candidates. Its integer products give all distances of the tile with an error of at
most the two rounding remainders, so most pairs are ruled out against the k-th nearest so
far; the others are computed again from the original vectors and merged into the queries'
heaps. The result is exact: recall is 1.

Defined cases: null vectors, zero vectors and those with null or non-finite components take
no part; vectors of different lengths are never neighbours; equal distances go to the smaller
id; repeated rows count as often as they occur, as queries and as candidates, but rows with
the query's own id are never its neighbours;
a null id takes no part; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappush, heappushpop

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.staging import stage

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
#: Candidate blocks that one task meets with the same queries, keeping their heaps.
RUN = 64
#: Dimensions whose eight-bit products a 32-bit float sums exactly: 1024 * 127 * 127 < 2 ** 24.
_EXACT = 1024
_BLOCK = "block long, dimensions int, ids binary, vectors binary, small binary, scales binary, errors binary"


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id and vector of the rows that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(
        F.col(key).isNotNull() & F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    ).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))


def _blocks(rows: DataFrame, size: int, label: str) -> tuple[DataFrame, int]:
    """Stored blocks of about ``size`` vectors of one length, and their number."""
    number = max(1, -(-rows.count() // size))
    dealt = rows.repartition(number).withColumn("part", F.spark_partition_id())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows_, part = [], [], None
        for batch in batches:
            part = batch.column("part")[0].as_py()
            ids += batch.column("id").to_pylist()
            column = batch.column("vector")
            ends = np.asarray(column.offsets)
            flat = np.asarray(column.values)
            rows_ += [flat[a:b] for a, b in zip(ends, ends[1:])]
        lengths = np.array([len(r) for r in rows_])
        for d in np.unique(lengths).tolist():
            chosen = np.flatnonzero(lengths == d)
            x = np.stack([rows_[i] for i in chosen])
            scales = np.abs(x).max(1) / 127
            small = np.rint(x / scales[:, None]).astype(np.int8)
            errors = np.linalg.norm(x - small * scales[:, None], axis=1)
            columns = [[part], [d], *[[a.tobytes()] for a in (np.array(ids, "<i8")[chosen], x, small, scales, errors)]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), *[pa.binary()] * 5])],
                names=[f.split()[0] for f in _BLOCK.split(", ")])

    return stage(dealt.mapInArrow(pack, _BLOCK), label), number


class _Block:
    def __init__(self, row: dict, side: str):
        d = row["dimensions"]
        self.ids = np.frombuffer(row[f"{side}ids"], "<i8")
        self.vectors = np.frombuffer(row[f"{side}vectors"], "<f8").reshape(-1, d)
        self.small = np.frombuffer(row[f"{side}small"], np.int8).reshape(-1, d)
        self.scales = np.frombuffer(row[f"{side}scales"], "<f8")
        self.errors = np.frombuffer(row[f"{side}errors"], "<f8")
        whole = self.small.astype(np.int64)
        self.norms = (whole * whole).sum(1) * self.scales**2


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of eight-bit rows."""
    total = 0.0
    for lo in range(0, a.shape[1], _EXACT):
        part = a[:, lo:lo + _EXACT].astype(np.float32) @ b[:, lo:lo + _EXACT].astype(np.float32).T
        total = total + part.astype(np.float64)
    return total


def exact_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of row pairs in double precision, summed from the first component on."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        gap = a[:, k] - b[:, k]
        total += gap * gap
    return np.sqrt(total)


def _meet(q: _Block, c: _Block, heaps: list[list], k: int) -> None:
    """Merge a tile into the queries' heaps of (-distance, -id)."""
    squares = q.norms[:, None] + c.norms[None, :] - 2 * _products(q.small, c.small) * np.outer(q.scales, c.scales)
    about = np.sqrt(np.maximum(squares, 0))
    slack = q.errors[:, None] + c.errors[None, :] + 1e-9 * (np.sqrt(q.norms)[:, None] + np.sqrt(c.norms)[None, :] + 1)
    own = q.ids[:, None] == c.ids[None, :]
    upper = np.where(own, np.inf, about + slack)
    limit = np.partition(upper, min(k, upper.shape[1]) - 1, axis=1)[:, min(k, upper.shape[1]) - 1]
    if upper.shape[1] < k:
        limit = np.full(len(limit), np.inf)
    limit = np.minimum(limit, [-h[0][0] if len(h) == k else np.inf for h in heaps])
    left, right = np.nonzero((about - slack <= limit[:, None]) & ~own)
    for i, negative in zip(left.tolist(), zip((-exact_distances(q.vectors[left], c.vectors[right])).tolist(),
                                              (-c.ids[right]).tolist())):
        (heappush if len(heaps[i]) < k else heappushpop)(heaps[i], negative)


def nearest_neighbours(queries: DataFrame, candidates: DataFrame, key: str, vector: str, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), the neighbour's ``key`` and score, the Euclidean distance.

    Query blocks are repeated for runs of candidate blocks, not for single candidates; each
    task holds one query block's heaps and one tile.
    """
    q, n_q = _blocks(usable(queries, key, vector), QUERY_BLOCK, "query-blocks")
    c, n_c = _blocks(usable(candidates, key, vector), CANDIDATE_BLOCK, "candidate-blocks")
    names = ["ids", "vectors", "small", "scales", "errors"]
    left = q.select(F.col("block").alias("q"), "dimensions", *[F.col(n).alias(f"q_{n}") for n in names],
                    F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_c - 1).cast("long"))).alias("c"))
    right = c.select(F.col("block").alias("c"), "dimensions", *[F.col(n).alias(f"c_{n}") for n in names])
    run = F.floor(F.col("c") / RUN)
    tiles = (left.join(right, ["c", "dimensions"]).withColumn("run", run)
             .repartition("q", "run").sortWithinPartitions("q", "run", "dimensions", "c"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = block = heaps = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if (row["q"], row["run"], row["dimensions"]) != current:
                    if current:
                        yield _ranked(current[0], block, heaps)
                    current = (row["q"], row["run"], row["dimensions"])
                    block = _Block(row, "q_")
                    heaps = [[] for _ in block.ids]
                _meet(block, _Block(row, "c_"), heaps, k)
        if current:
            yield _ranked(current[0], block, heaps)

    found = tiles.mapInArrow(merge, "query_id long, of long, id long, score double")
    best = Window.partitionBy("query_id", "of").orderBy("score", "id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score"))


def _ranked(number: int, block: _Block, heaps: list[list]) -> pa.RecordBatch:
    rows = [(int(q), (number << 32) + n, -i, -d) for n, (q, heap) in enumerate(zip(block.ids, heaps)) for d, i in heap]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
    columns = zip(*rows) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      names=["query_id", "of", "id", "score"])
