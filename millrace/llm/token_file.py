"""Token ids as binary files with random access to every token.

The file format is a Parquet folder of segments. A segment holds whole documents, some 64
thousand tokens or one longer document, as one directly addressable code, with the ids and
token counts of its documents. Segments follow each other in ascending document id: ``part``
is the place of the file's range, ``first`` the tokens of the part before the segment.
Counts per part give every token its place in the whole sequence.

Defined cases: null text is an empty document (its end id only); a null id comes first;
documents with the same id follow each other, in ranges by a hash of their texts and within a range in
the order of these; other columns are not stored; an empty table gives a readable file without rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.addressable import Addressable, pack
from millrace.llm.tokens import encoder, with_end

SEGMENT_TOKENS = 1 << 16
SEGMENTS = "part int, segment long, first long, n_tokens long, doc_ids array<bigint>, lengths array<bigint>, code binary"
DOCUMENTS = "part int, doc_id long, local_start long, n_tokens long, ids binary"


def write_token_file(documents: DataFrame, path: str, vocabulary_path: str) -> None:
    """Encode (doc_id, text) with the tokenizers vocabulary at ``vocabulary_path``.

    Texts are dealt out by ranges of the id once and encoded where they arrive; each task
    writes its range, and a lost task is simply run again.
    """
    ordered = (
        documents.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
        .withColumn("part", F.spark_partition_id()))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = number = 0
        encode = encoder(vocabulary_path).encode
        for batch in batches:
            ids, bounds = with_end(*encode(batch.column("text")))
            doc_ids, part = batch.column("doc_id").to_pylist(), batch.column("part")[0].as_py()
            lo, rows = 0, []
            while lo < len(doc_ids):
                hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + SEGMENT_TOKENS, "right")) - 1)
                n = int(bounds[hi] - bounds[lo])
                rows.append((part, number, first, n, doc_ids[lo:hi], np.diff(bounds[lo:hi + 1]).tolist(),
                             pack(ids[bounds[lo]:bounds[hi]])))
                first, number, lo = first + n, number + 1, hi
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)

    ordered.mapInArrow(segments, SEGMENTS).write.parquet(path)


_ARROW = pa.schema([
    ("part", pa.int32()), ("segment", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("code", pa.binary())])


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """Tokens before each part: one row for each file's range, so the window is small."""
    counts = spark.read.schema(SEGMENTS).parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in DOCUMENTS.split(", ")]
        for batch in batches:
            for row in batch.to_pylist():
                ids = Addressable(row["code"]).all().tobytes()
                ends = np.cumsum([0, *row["lengths"]])
                n = len(row["doc_ids"])
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array(ends[:-1] + row["first"], pa.int64()), pa.array(row["lengths"], pa.int64()),
                    pa.array([ids[4 * a:4 * b] for a, b in zip(ends.tolist(), ends[1:].tolist())], pa.binary()),
                ], names=names)

    documents = spark.read.schema(SEGMENTS).parquet(path).mapInArrow(decode, DOCUMENTS)
    return documents.join(F.broadcast(part_starts(spark, path)), "part").select(
        "doc_id", (F.col("part_start") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """position, token for each distinct ``position`` in the whole sequence; others are dropped.

    Only the segments that hold a position are read with their codes, and within them only
    the bytes of the wanted tokens are looked at.
    """
    stored = spark.read.schema(SEGMENTS).parquet(path).join(F.broadcast(part_starts(spark, path)), "part")
    span = F.floor(F.lit(SEGMENT_TOKENS))
    start = F.col("part_start") + F.col("first")
    listed = stored.select("part", "segment", start.alias("start"), "n_tokens").select(
        "*", F.explode(F.sequence(F.floor(F.col("start") / span),
                                  F.floor((F.col("start") + F.col("n_tokens") - 1) / span))).alias("span"))
    wanted = positions.select(F.col("position").cast("long")).withColumn("span", F.floor(F.col("position") / span))
    inside = (F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_tokens"))
    hits = wanted.join(listed, "span").where(inside)
    located = hits.groupBy("part", "segment").agg(
        F.collect_set(F.struct("position", (F.col("position") - F.col("start")).alias("offset"))).alias("found"))
    codes = stored.select("part", "segment", "code")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = Addressable(row["code"]).at(np.array([x["offset"] for x in row["found"]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["position"] for x in row["found"]], pa.int64()), pa.array(tokens.astype(np.int64))],
                    names=["position", "token"])

    return located.join(codes, ["part", "segment"]).select("found", "code").mapInArrow(
        look_up, "position long, token long")
