"""Hold-out splits and folds of exact size that do not depend on partitioning.

A row's place follows from a seeded hash of its content, so the same row lands in the same
part however the table is stored. The cut points are order statistics of the hash (see
``selection``): the split itself is a filter on literals, with no sort and no shuffle.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.selection import order_statistics
from millrace.operators.strata import apportioned, cuts_after, fold_quotas, stratum_sizes, with_parts
from millrace.sources.staging import stage

_COPY = "_copy"


def holdout_size(n: int, share: float) -> int:
    """Rows held out: the share of ``n``, rounded up."""
    return math.ceil(share * n - 1e-9)


def fold_sizes(n: int, folds: int) -> list[int]:
    """Sizes of contiguous folds: the first ``n % folds`` are one larger."""
    return [n // folds + (1 if i < n % folds else 0) for i in range(folds)]


def _place(frame: DataFrame, seed: int, key: Sequence[str] | None) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in key or frame.columns])


def assign_parts(
    frame: DataFrame,
    part_sizes: Callable[[int], Sequence[int]],
    seed: int,
    key: Sequence[str] | None = None,
    part: str = "part",
) -> DataFrame:
    """Number the rows' parts 0, 1, ... with exactly the sizes asked for.

    ``part_sizes`` maps the number of rows to the sizes of the parts. ``key`` lists the columns that
    identify a row; by default all of them count, and only complete copies tie. Ties at a cut are broken by
    a row number stored beside the data.
    """
    place, name = _place(frame, seed, key), "all"
    cuts: list[int] = []

    def wanted(counts: dict[str, int]) -> dict[str, list[int]]:
        for n in counts.values():
            cuts.extend(list(itertools.accumulate(part_sizes(n)))[:-1])
        return {name: cuts} if counts else {}

    values = frame.select(F.lit(name).alias("series"), place.alias("value"))
    found, counts = order_statistics(values, wanted, counted=True)
    tied = {at: value for at, (value, upto) in found.items() if upto > at[1]}
    identified, last_copy = frame, {}
    if tied:
        identified = stage(frame.withColumn(_COPY, F.monotonically_increasing_id()), "split")
        last_copy = _break_ties(identified.select(F.lit(name).alias("series"), place.alias("value"), _COPY), tied)

    def beyond(k: int) -> Column:
        """Whether a row comes after the k-th."""
        if k <= 0 or k >= counts[name]:
            return F.lit(k <= 0)
        cut = F.lit(found[name, k][0])
        if (name, k) in last_copy:
            return (place > cut) | ((place == cut) & (F.col(_COPY) > last_copy[name, k]))
        return place > cut

    number = sum((beyond(k).cast("int") for k in cuts), F.lit(0))
    return identified.withColumn(part, number.cast("int")).drop(_COPY)


def assign_within(
    frame: DataFrame, quotas: Callable[[DataFrame], DataFrame], stratum: str, seed: int,
    key: Sequence[str] | None = None, part: str = "part",
) -> DataFrame:
    """As ``assign_parts`` within every stratum, of any number; null and the empty text are one stratum.

    ``quotas`` maps the strata (series, n) to the same with ``quotas``, the sizes of their parts.
    """
    series = F.coalesce(F.col(stratum).cast("string"), F.lit(""))
    strata = quotas(stratum_sizes(frame.select(series.alias("series"))))
    cuts = stage(cuts_after(strata, F.col("quotas")), "cuts")
    return with_parts(frame, cuts, series, _place(frame, seed, key), part)


def _break_ties(rows: DataFrame, tied: dict[tuple[str, int], int]) -> dict[tuple[str, int], int]:
    """The last row number before the cut, for cuts that fall inside equal hashes."""
    names = {(s, value): f"{s}/{value}" for (s, _k), value in tied.items()}
    name, before = F, []
    for (s, value), label in names.items():
        name = name.when((F.col("series") == s) & (F.col("value") == value), label)
        before.append(F.count_if((F.col("series") == s) & (F.col("value") < value)).alias(label))
    less = rows.agg(*before).first()
    copies = rows.select(name.alias("series"), F.col(_COPY).alias("value")).filter("series IS NOT NULL")
    ranks: dict[str, list[int]] = {}
    for (s, k), value in tied.items():
        ranks.setdefault(names[s, value], []).append(k - less[names[s, value]])
    found, _ = order_statistics(copies, lambda _sizes: ranks)
    return {(s, k): found[names[s, v], k - less[names[s, v]]][0] for (s, k), v in tied.items()}


def holdout_split(
    frame: DataFrame, share: float = 0.2, seed: int = 16, key: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(training rows, held-out rows); the held-out part has exactly ceil(share * n) rows."""
    def sizes(n: int) -> list[int]:
        return [holdout_size(n, share), n - holdout_size(n, share)]

    return _train_and_test(assign_parts(frame, sizes, seed, key))


def stratified_split(
    frame: DataFrame, label: str, share: float = 0.2, seed: int = 99,
    key: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Hold out exactly ceil(share * n) rows with the label's proportions kept, for any number of labels."""
    def sizes(strata: DataFrame) -> DataFrame:
        n = strata.agg(F.sum("n")).first()[0] or 0
        return apportioned(strata, holdout_size(n, share)).withColumn("quotas", F.array("quota", F.col("n") - F.col("quota")))

    return _train_and_test(assign_within(frame, sizes, label, seed, key))


def _train_and_test(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    return parts.filter("part = 1").drop("part"), parts.filter("part = 0").drop("part")


def with_folds(
    frame: DataFrame, folds: int = 5, seed: int = 16, key: Sequence[str] | None = None,
    label: str | None = None, column: str = "fold",
) -> DataFrame:
    """A fold number per row; with ``label`` every fold keeps the label's proportions."""
    if label is None:
        return assign_parts(frame, lambda n: fold_sizes(n, folds), seed, key, column)
    return assign_within(frame, lambda strata: fold_quotas(strata, folds), label, seed, key, column)


def vault_split(
    frame: DataFrame, label: str, share: float = 0.2, vault_seed: int = 99, test_seed: int = 42,
    key: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(training, test, vault): a stratified vault first, then a split of the history."""
    history, vault = stratified_split(frame, label, share, vault_seed, key)
    train, test = holdout_split(history, share, test_seed, key)
    return train, test, vault
