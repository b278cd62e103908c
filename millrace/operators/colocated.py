"""Facts and a large lookup stored so that they join without a shuffle.

Both are written as tables bucketed by the key and a salt, with the same number of buckets, so that
equal keys lie in buckets of the same number and later joins read them side by side. The shuffle is paid
once, when the tables are written. Keys with more facts than a task should read are salted in
storage: their facts are dealt out over as many salts as that takes, and their lookup rows are repeated for
each of them. The number of buckets and what makes a key too large both follow from measured bytes.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.joins import hot_keys, measured_bytes
from millrace.sources.staging import new_location

BUCKET_BYTES = 128 * 1024 * 1024
MOST_BUCKETS = 100_000
_SALT = "_salt"
_TRACKED = 1 / 1000  # least share of the rows at which a key's size is looked at


@dataclass(frozen=True)
class Colocated:
    """Two stored tables with a common key; the facts keep rows whose key is null or unknown."""

    facts: DataFrame
    lookup: DataFrame
    key: str
    buckets: int

    def join(self, how: str = "inner") -> DataFrame:
        """The facts with their lookup rows, "inner" or "left", bucket by bucket."""
        return self.facts.hint("merge").join(self.lookup.hint("merge"), [self.key, _SALT], how).drop(_SALT)


def key_salts(facts: DataFrame, key: str, row_bytes: float, bucket_bytes: int) -> dict:
    """How many salts each key needs whose facts take more than a bucket; at most 1,000 keys can."""
    found = hot_keys(facts, key, _TRACKED)
    if not found:
        return {}
    counts = facts.where(F.col(key).isin(found)).groupBy(key).agg(F.count("*").alias("n")).collect()
    salts = {r[key]: math.ceil(r.n * row_bytes / bucket_bytes) for r in counts}
    return {k: n for k, n in salts.items() if n > 1}


def store_colocated(
    facts: DataFrame, lookup: DataFrame, key: str, database: str = "default", bucket_bytes: int = BUCKET_BYTES,
) -> Colocated:
    """Write both tables, bucketed, and return them. ``lookup`` has one row per key."""
    spark, bytes_ = facts.sparkSession, measured_bytes(facts)
    rows = facts.count()
    buckets = min(MOST_BUCKETS, max(1, math.ceil(max(bytes_, measured_bytes(lookup)) / bucket_bytes)))
    salts = key_salts(facts, key, bytes_ / max(1, rows), bucket_bytes)
    number: Column = F.lit(1)
    for n in sorted(set(salts.values())):
        number = F.when(F.col(key).isin([k for k, v in salts.items() if v == n]), n).otherwise(number)
    number = F.when(F.col(key).isNull(), F.lit(buckets)).otherwise(number)  # they meet nothing, so anywhere will do
    content = F.xxhash64(*[F.col(f"`{c}`") for c, kind in facts.dtypes if "map<" not in kind and "variant" not in kind])
    dealt = facts.withColumn(_SALT, F.pmod(content, number).cast("int"))
    repeated = lookup.where(F.col(key).isNotNull()).withColumn(_SALT, F.explode(F.sequence(F.lit(0), number - 1)))
    return Colocated(*[_bucketed(frame, f"{database}.{label}_{uuid.uuid4().hex[:12]}", key, buckets)
                       for label, frame in (("facts", dealt), ("lookup", repeated))], key, buckets)


def _bucketed(frame: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """One file for each bucket: rows are dealt by the buckets' own hash before they are written."""
    spark = frame.sparkSession
    (frame.repartition(buckets, key, _SALT).write.format("parquet").option("path", new_location(spark, "bucketed"))
     .bucketBy(buckets, key, _SALT).sortBy(key, _SALT).saveAsTable(name))
    return spark.table(name)
