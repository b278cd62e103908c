"""Merkle manifest of a table of documents: a root over all rows, and a proof for each.

A row's leaf is a digest of its fields. The leaves of a source ascend by document id, runs of
16 are digested into nodes until one is left, the sources' roots likewise into the root.

The place of a leaf is found without sorting leaves: the ids of a source are gathered in
compressed bitmaps, merged bucket by bucket, with directories of the bits before each piece and
of the rows before each bucket, so that a place is a rank query. Nodes are then keyed by place: a
level's slot arrays are the groups of place / 16, and proofs come down the same arrays, one path for
each run of leaves. No group holds more than 16 nodes or one bucket of ids, and copies of a row are one row
with a number up to their places.

Defined cases: rows of one id in one source are ordered by their leaves, equal rows take
places next to each other, null ids come first and are not tampered with; null fields are part of the
digest; an empty table gives no rows; other columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.codes import numbered
from millrace.operators.joins import lookup_join
from millrace.sources.staging import stage

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
FAN = 16
_BITS = 15  # ids per bucket, as a power of two: what one of Spark's bitmaps holds
_PIECE = 64  # bytes of a bitmap that are kept or left out together
_PIECES = (1 << _BITS) // 8 // _PIECE
_SUPER = 12  # buckets per entry of the upper directory, as a power of two
_NO_ID = -(1 << 50)  # bucket of null ids, before all others
_INDEX = ["m", "start", "extra", *[n + c for n in ("", "again_") for c in ("pieces", "before", "piece_at")]]
_COPIES = 1 << 16  # copies that one task numbers at once
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def leaf(changed: dict[str, Column] | None = None) -> Column:
    """Digest of a row's fields, each as its length in bytes and its value, or `-` where null."""
    def field(name: str) -> Column:
        value = (changed or {}).get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(F.concat(*[field(c) for c in FIELDS]))


def bitmaps(ids: DataFrame) -> DataFrame:
    """Compressed bitmaps of (grp, bucket, bit, rows), with directories.

    ``pieces`` are the pieces of the bitmap that have a bit set, ``piece_at`` tells where each one is and
    ``before`` how many ids come before it. Ids with several rows have a bitmap of
    their own, whose ranks lead into ``extra``, the sums of their further rows.
    """
    def directory(bits: str, name: str) -> list[Column]:
        piece = F.transform(F.sequence(F.lit(0), F.lit(_PIECES - 1)),
                            lambda i: F.substring(F.col(bits), i * _PIECE + 1, F.lit(_PIECE)))
        sums = F.aggregate(piece, F.array(F.lit(0)), lambda a, p: F.concat(a, F.array(
            F.element_at(a, -1) + F.bitmap_count(p).cast("int"))))
        at = F.aggregate(piece, F.array(F.lit(0)), lambda a, p: F.concat(a, F.array(
            F.element_at(a, -1) + (F.bitmap_count(p) > 0).cast("int"))))
        kept = F.filter(piece, lambda p: F.bitmap_count(p) > 0)
        return [kept.alias(f"{name}pieces"), sums.alias(f"{name}before"), at.alias(f"{name}piece_at")]

    repeated = F.col("rows") > 1
    merged = ids.groupBy("grp", "bucket").agg(
        F.sum("rows").alias("rows"), F.bitmap_construct_agg("bit").alias("bits"),
        F.bitmap_construct_agg(F.when(repeated, F.col("bit"))).alias("again"),
        F.array_sort(F.collect_list(F.when(repeated, F.struct("bit", (F.col("rows") - 1).alias("more"))))).alias("more"))
    extra = F.aggregate("more", F.array(F.lit(0).cast("long")), lambda a, m: F.concat(a, F.array(F.element_at(a, -1) + m["more"])))
    return merged.select("grp", "bucket", "rows", *directory("bits", ""), *directory("again", "again_"),
                         extra.alias("extra"))


def _rank(bit: Column, name: str = "") -> Column:
    """How many of a bitmap's bits come before a bit."""
    piece, inside = F.floor(bit / (8 * _PIECE)).cast("int"), (bit % (8 * _PIECE)).cast("int")
    pieces, before, at = (F.col(name + c) for c in ("pieces", "before", "piece_at"))
    there = F.coalesce(F.get(at, piece + 1) > F.get(at, piece), F.lit(False))  # a bit after the last has no piece
    data, byte = F.get(pieces, F.get(at, piece)), F.floor(inside / 8).cast("int")
    last = F.conv(F.hex(F.substring(data, byte + 1, F.lit(1))), 16, 10).cast("int")
    below = F.bit_count(last.bitwiseAND((F.pow(F.lit(2.0), inside % 8) - 1).cast("int")))
    return F.get(before, piece) + F.when(
        there, F.bitmap_count(F.substring(data, F.lit(1), byte)) + below).otherwise(F.lit(0))


def _with_starts(buckets: DataFrame) -> DataFrame:
    """``start``, the rows of the group before each bucket, and ``m``, those of the whole group.

    Two levels of sums, so that no window sees more than a few thousand of a group's buckets at once.
    """
    buckets = buckets.withColumn("upper", F.shiftright("bucket", _SUPER))
    uppers = buckets.groupBy("grp", "upper").agg(F.sum("rows").alias("n"))
    ordered = Window.partitionBy("grp").orderBy("upper")
    uppers = uppers.select("grp", "upper", F.sum("n").over(Window.partitionBy("grp")).alias("m"),
                           (F.sum("n").over(ordered) - F.col("n")).alias("upper_start"))
    inside = Window.partitionBy("grp", "upper").orderBy("bucket")
    buckets = buckets.withColumn("lower_start", F.sum("rows").over(inside) - F.col("rows"))
    return buckets.join(uppers, ["grp", "upper"]).withColumn("start", F.col("upper_start") + F.col("lower_start")).drop(
        "upper", "upper_start", "lower_start", "rows")


def _place_among_equals(rows: DataFrame) -> DataFrame:
    """``rows`` of repeated ids with ``place``, the rows of the same id before them, in the order of the leaves.

    A digest's first bytes deal the leaves of one id out evenly, however many there are.
    """
    rows = rows.withColumn("_part", F.conv(F.hex(F.substring("leaf", 1, 2)), 16, 10).cast("int"))
    parts = rows.groupBy("key", "bit", "_part").agg(F.sum("n").alias("_n"))
    before = Window.partitionBy("key", "bit").orderBy("_part")
    parts = parts.select("key", "bit", "_part", (F.sum("_n").over(before) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy("key", "bit", "_part").orderBy("leaf")
    rows = rows.withColumn("_inside", F.sum("n").over(inside) - F.col("n")).join(parts, ["key", "bit", "_part"])
    return rows.withColumn("place", F.col("_before") + F.col("_inside"))


def coordinates(docs: DataFrame) -> DataFrame:
    """grp (a source), index, m (rows of the source), leaf, doc_id and tampered for every row of ``docs``.

    ``tampered`` is the leaf of the row with its text in lower case where the id's checksum is
    divisible by five, else null.
    """
    doc_id = F.col("doc_id").cast("long")
    chosen = F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
    rows = docs.select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-")).alias("grp"), doc_id.alias("doc_id"),
        F.coalesce(F.shiftright(doc_id, _BITS), F.lit(_NO_ID)).alias("bucket"),
        F.coalesce(doc_id.bitwiseAND((1 << _BITS) - 1), F.lit(0)).alias("bit"), leaf().alias("leaf"),
        F.when(chosen, leaf({"text": F.translate("text", _UPPER, _LOWER)})).alias("tampered"))
    # Copies of a row become one, with their number, before anything moves.
    leaves = stage(rows.groupBy("grp", "bucket", "bit", "doc_id", "leaf").agg(
        F.first("tampered").alias("tampered"), F.count("*").alias("n")), "leaves")
    ids = leaves.groupBy("grp", "bucket", "bit").agg(F.sum("n").alias("rows"))
    key = F.concat_ws("/", "bucket", "grp").alias("key")
    index = stage(_with_starts(bitmaps(ids)).select(key, *_INDEX), "id-bitmaps")
    found = lookup_join(leaves.select("*", key), index, "key")
    first = F.col("start") + _rank(F.col("bit")) + F.get(F.col("extra"), _rank(F.col("bit"), "again_").cast("int"))
    again = _rank(F.col("bit") + 1, "again_") > _rank(F.col("bit"), "again_")
    placed = found.select("grp", "m", "doc_id", "leaf", "tampered", "n", "key", "bit", first.alias("index"), again.alias("again"))
    columns = ["grp", "m", "index", "leaf", "doc_id", "tampered"]
    if index.where(F.size("again_pieces") > 0).isEmpty():
        return placed.select(*columns)
    placed = stage(placed, "places")
    many = _place_among_equals(placed.where("again")).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _COPIES))))
    many = many.repartition("key", "bit", "leaf", "part").withColumn("copy", F.explode(F.sequence(
        F.col("part") * _COPIES, F.least((F.col("part") + 1) * _COPIES, "n") - 1)))
    many = many.withColumn("index", F.col("index") + F.col("place") + F.col("copy"))
    return placed.where("not again").select(*columns).unionByName(many.select(*columns))


def slot_arrays(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Stored levels of (grp, m, index, slots, hash): runs of up to 16 nodes and the digest of each.

    ``nodes`` have grp, m (nodes of the group), index, hash and row, which the first level's slots keep.
    A group's last level has one row; a lone node is its own digest. ``most`` is the largest m.
    """
    levels, height = [], 1
    while True:
        slot = F.struct((F.col("index") % FAN).alias("slot"), "hash", *[c for c in nodes.columns if c == "row"])
        runs = nodes.groupBy("grp", "m", F.floor(F.col("index") / FAN).alias("run")).agg(F.sort_array(F.collect_list(slot)).alias("slots"))
        joined = digest(F.array_join(F.transform("slots", lambda s: _hex(s["hash"])), ""))
        lone = F.col("m") == 1
        levels.append(stage(runs.select("grp", "m", F.col("run").alias("index"), "slots", F.when(
            lone, F.get("slots", F.lit(0))["hash"]).otherwise(joined).alias("hash")), "slots"))
        height *= FAN
        if height >= most:
            return levels
        nodes = levels[-1].where(F.col("m") > height).select("grp", "m", "index", "hash")


def roots(levels: list[DataFrame]) -> DataFrame:
    """grp, hash: the one node that every group ends with."""
    out = None
    for k, level in enumerate(levels):
        done = level.where((F.col("m") <= FAN ** (k + 1)) & ((F.col("m") > FAN**k) | (k == 0))).select("grp", "hash")
        out = done if out is None else out.unionByName(done)
    return out


def _steps(parent: Column) -> Column:
    """The hex digests left and right of a slot's own, then those of the levels above."""
    join = lambda part: F.array_join(F.transform(part, lambda s: _hex(s["hash"])), "")
    own = F.struct(join(F.slice("slots", F.lit(1), F.col("at"))).alias("left"),
                   join(F.slice("slots", F.col("at") + 2, F.lit(FAN))).alias("right"))
    return F.when(F.col("m") == 1, parent).otherwise(F.concat(F.array(own), parent))


def with_paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Every first-level slot's grp, hash, row and ``path``: (left, right) of each level up to the root.

    ``tops`` have grp, path and further columns of the groups' roots; these columns stay. Paths come down
    the levels, one for each run of 16, and meet the leaves last.
    """
    kept = [c for c in tops.columns if c not in ("grp", "path")]
    above = None
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        done = (F.col("m") <= FAN ** (k + 1)) & ((F.col("m") > FAN**k) | (k == 0))
        ended = level.where(done).join(tops, "grp").select("grp", "index", "m", "slots", "path", *kept)
        runs = ended if above is None else ended.unionByName(
            level.where(F.col("m") > FAN ** (k + 1)).join(above, ["grp", "index"]).select("grp", "index", "m", "slots", "path", *kept))
        slots = runs.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("slots") - 1)))
        own = F.get(F.col("slots"), F.col("at"))
        if k == 0:
            return slots.select("grp", own["hash"].alias("hash"), own["row"].alias("row"), _steps(F.col("path")).alias("path"), *kept)
        above = slots.select("grp", (F.col("index") * FAN + F.col("at")).alias("index"), _steps(F.col("path")).alias("path"), *kept)
        above = stage(above, "paths")


def fold(start: Column, path: str = "path") -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, _hex(start), lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def _most(rows: DataFrame) -> int:
    return rows.agg(F.max("m")).first()[0] or 1


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, path and tampered (a leaf or null) for every row."""
    placed = coordinates(docs).select("grp", "m", "index", F.col("leaf").alias("hash"), F.struct("doc_id", "tampered").alias("row"))
    levels = slot_arrays(placed, docs.count() or 1)
    subroots = numbered(roots(levels), ["grp"], "index")
    sources = subroots.count()
    top = slot_arrays(subroots.select(F.lit("").alias("grp"), F.lit(sources).cast("long").alias("m"), "index", "hash",
                                      F.struct(F.col("grp").alias("doc")).alias("row")), sources)
    root = roots(top).select("grp", F.array().cast("array<struct<left:string,right:string>>").alias("path"),
                             _hex("hash").alias("root"))
    tops = with_paths(top, root).select(F.col("row.doc").alias("grp"), "path", _hex("hash").alias("subroot"), "root")
    return with_paths(levels, stage(tops, "tops")).select(
        "row.doc_id", _hex("hash").alias("leaf"), "subroot", "root", "path", "row.tampered",
        F.col("hash").alias("_leaf"))


def proofs(docs: DataFrame) -> DataFrame:
    """The manifest with the digest of every proof, and whether the leaf, tampered with or not, still leads to the root."""
    rows = manifest(docs)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = fold(F.coalesce("tampered", "_leaf"))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                       folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
