"""Join to a table with one row per key, safe against hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
#: A lookup of so many bytes in each shuffle partition is hashed there, and the facts need no sort.
HASHED_BYTES = 128 * 1024 * 1024
HOT_SHARE = 1 / 1000
SALTS = 256
_VARIABLE = ("string", "binary")
_NESTED = ("array<", "map<", "struct<")
_SALT = "_salt"
_UNKNOWN = 1 << 62


def measured_bytes(frame: DataFrame) -> int:
    """Size of the rows as counted from the data, not as estimated.

    Nested values count eight times their length as JSON, which has two characters at least
    for each number. Types of unknown size, such as vectors, give a size too large for any broadcast.
    """
    if any("vector" in kind or "matrix" in kind or "variant" in kind for _, kind in frame.dtypes):
        return _UNKNOWN
    nested = [c for c, kind in frame.dtypes if kind.startswith(_NESTED)]
    texts = [c for c, kind in frame.dtypes if kind in _VARIABLE]
    row = F.lit(16 * (len(frame.columns) - len(nested) - len(texts))).cast("long")
    for c in texts:
        row = row + F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) + 24
    for c in nested:
        row = row + 8 * F.octet_length(F.to_json(F.struct(F.col(f"`{c}`").alias("v"))))
    total = frame.agg(F.sum(row.cast("long"))).first()[0]
    return total or 0


def hot_keys(frame: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold about ``share`` of the rows or more: at most 1/share of them.

    Found by mergeable frequent-item sketches in one scan of the key column, merged in two
    steps; counting every key would shuffle them all. The sketch only decides which way a
    row takes to its lookup row, so its error cannot change a result.
    """
    tracked = 8 * round(1 / share)
    present = frame.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"))
    sketches = present.groupBy((F.spark_partition_id() % 256).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(k, {tracked})").alias("sketch"), F.count("*").alias("rows"))
    merged = sketches.agg(
        F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("rows").alias("rows"))
    found = merged.select("rows", F.explode(F.expr(
        f"approx_top_k_estimate(sketch, {round(1 / share)})")).alias("top"))
    return [r.item for r in found.filter(F.col("top.count") >= F.greatest(F.col("rows") * share, F.lit(2.0)))
            .select("top.item").collect()]


def _hashed(lookup: DataFrame, size: int) -> DataFrame:
    """``lookup`` marked to be hashed partition by partition, if its parts are small enough to be held."""
    partitions = int(lookup.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lookup.hint("shuffle_hash") if size <= HASHED_BYTES * partitions else lookup


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str | Sequence[str],
    broadcast_bytes: int | None = None,
    size: int | None = None,
    hot_share: float = HOT_SHARE,
    hot_in: DataFrame | None = None,
    how: str = "inner",
) -> DataFrame:
    """``facts`` joined to ``lookup``, which has one row per key; ``how`` is "inner" or "left".

    A lookup table measured below ``broadcast_bytes`` (64 MB) is broadcast. A larger one is joined
    by one shuffle on the key and a salt. The salt is 0 but for frequent keys: their fact rows
    are dealt out by a hash of the row, and their lookup rows, at most 1/``hot_share``, are
    repeated for every salt. The facts are read once, so chained joins stay a chain. Complete
    copies of a fact row share a salt; a partition that these make large is split at run time.
    Rows without a key are dealt out like those of a frequent one. Each partition's part of the lookup is
    hashed while it stays below ``HASHED_BYTES``, so that the facts are neither sorted nor spilled; past
    that both sides are sorted and merged.

    ``key`` may give the two column names when they differ. ``size`` is the lookup's size
    in bytes where it is known, or any larger figure. ``hot_in`` names a cheaper table to
    find frequent keys in, such as the facts before other joins.
    """
    left, right = (key, key) if isinstance(key, str) else key
    if left != right:
        lookup = lookup.withColumnRenamed(right, left)
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    size = measured_bytes(lookup) if size is None else size
    if size <= limit:
        return facts.join(F.broadcast(lookup), left, how)
    hot = hot_keys(facts if hot_in is None else hot_in, left, hot_share)
    if not hot and how == "inner":
        return facts.join(_hashed(lookup, size), left)
    is_hot = F.col(left).isin(hot) if hot else F.lit(False)
    plain = [F.col(f"`{c}`") for c, kind in facts.dtypes if "map<" not in kind and "variant" not in kind]
    dealt = facts.withColumn(_SALT, F.when(is_hot | F.col(left).isNull(), F.pmod(
        F.xxhash64(*plain), F.lit(SALTS)).cast("int")).otherwise(0))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(_hashed(lookup.withColumn(_SALT, F.explode(salts)), size), [left, _SALT], how).drop(_SALT)
