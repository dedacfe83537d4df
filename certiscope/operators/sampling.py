"""Repeatable exact samples, splits and folds.

Every draw orders the rows by a hash of a unique key (``keys``), so a sample is the same on every run,
on any partitioning, and in any engine that has md5. ``keys`` must identify a row; they also break
hash ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from certiscope import vocab
from certiscope.functions.columns import hash_rank
from certiscope.operators.ordering import attach_cuts, hash_bucket, order_cuts, take_first

HASH = "_hash"


def _hashed(df: DataFrame, keys: list[str], seed: int) -> DataFrame:
    return df.withColumn(HASH, hash_rank(seed, *keys))


def _take(df: DataFrame, keys: list[str], quota: Column, strata: list[str], seed: int) -> DataFrame:
    picked = take_first(_hashed(df, keys, seed), [HASH, *keys], hash_bucket(HASH), quota, strata)
    return picked.drop(HASH)


def uniform_sample(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows, or all of them when there are fewer."""
    return _take(df, keys, F.lit(n), [], seed)


def stratified_sample_quota(df: DataFrame, n: int, label: str, keys: list[str], seed: int = 42) -> DataFrame:
    """``n`` rows with int(n * positive share) positives and the rest negatives, class sizes permitting."""
    total, positives = df.agg(F.count(label), F.sum(label)).first()
    if total <= n:
        return df
    n_pos = int(n * (positives / total))
    quota = F.when(F.col(label) == 1, F.lit(n_pos)).otherwise(F.lit(n - n_pos))
    return _take(df, keys, quota, [label], seed)


def stratified_sample_fraction(df: DataFrame, n: int, label: str, keys: list[str], seed: int = 42) -> DataFrame:
    """The fraction n / rows of every class, rounded to whole rows (half to even)."""
    total = df.count()
    if total <= n:
        return df
    return _take(df, keys, F.bround(F.col("n") * F.lit(n / total), 0), [label], seed)


def equal_sample(df: DataFrame, total: int, stratum: str, strata_count: int, keys: list[str],
                 seed: int = 42) -> DataFrame:
    """total // strata_count rows of every stratum (for example every year), fewer where it is smaller."""
    return _take(df, keys, F.lit(total // strata_count), [stratum], seed)


def temporal_split(df: DataFrame, year: str, first_test_year: int, name: str = "split") -> DataFrame:
    return df.withColumn(name, F.when(F.col(year) >= first_test_year, "test").otherwise("train"))


def stratified_folds(df: DataFrame, k: int, label: str, keys: list[str], seed: int = 42,
                     name: str = "fold") -> DataFrame:
    """Fold number 0..k-1; within each class the fold sizes differ by at most one row.

    The folds of a class are consecutive stretches of its hash order, so a row's fold follows from
    comparing its hash with k - 1 cut points and no row has to move.
    """
    names = [f"_f{i}" for i in range(1, k)]
    quotas = {f"_f{i}": F.expr(f"(n * {i} + {k - 1}) div {k}") for i in range(1, k)}
    hashed = _hashed(df, keys, seed)
    order = [HASH, *keys]
    cut = attach_cuts(hashed, order_cuts(hashed, order, hash_bucket(HASH), quotas, [label]), names, [label])
    key = F.struct(*order)
    passed = [F.coalesce((key > F.col(c)).cast("int"), F.lit(0)) for c in names]
    return cut.withColumn(name, sum(passed, F.lit(0))).drop(HASH, *names)


def half_split(df: DataFrame, keys: list[str], seed: int = 42, name: str = "half") -> DataFrame:
    """'tune' for the first n // 2 rows of the hash order, 'hold' for the others."""
    hashed = _hashed(df, keys, seed)
    order = [HASH, *keys]
    cuts = order_cuts(hashed, order, hash_bucket(HASH), {"_cut": F.expr("n div 2")})
    cut = attach_cuts(hashed, cuts, ["_cut"])
    first = F.coalesce(F.struct(*order) <= F.col("_cut"), F.lit(False))
    return cut.withColumn(name, F.when(first, "tune").otherwise("hold")).drop(HASH, "_cut")


def outcome(label: str, pred: str) -> Column:
    same = F.col(label) == F.col(pred)
    return (
        F.when(same & (F.col(label) == 1), "correct_positive")
        .when(same & (F.col(label) == 0), "correct_negative")
        .when(~same, "error")
    )


def outcome_examples(df: DataFrame, label: str, pred: str, keys: list[str], unique: str, seed: int = 42,
                     quotas: dict[str, int] | None = None, total: int = 8) -> DataFrame:
    """A few rows of every outcome, one per property, at most ``total``.

    The row_number filter has a fixed bound, so Spark keeps only that many rows per task and outcome
    before it shuffles.
    """
    quotas = quotas or vocab.EXAMPLE_QUOTAS
    marked = _hashed(df.withColumn("outcome", outcome(label, pred)), keys, seed)
    rank = F.row_number().over(Window.partitionBy("outcome").orderBy(HASH, *keys))
    limit = F.lit(0)
    for kind, size in quotas.items():
        limit = F.when(F.col("outcome") == kind, size).otherwise(limit)
    picked = (
        marked.withColumn("_rank", rank)
        .where(F.col("_rank") <= max(quotas.values()))
        .where(F.col("_rank") <= limit)
    )
    once = F.row_number().over(Window.partitionBy(unique).orderBy(HASH, *keys))
    return (
        picked.withColumn("_once", once).where(F.col("_once") == 1)
        .orderBy(HASH, *keys).limit(total)
        .drop(HASH, "_rank", "_once")
    )
