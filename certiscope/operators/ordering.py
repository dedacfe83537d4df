"""Order statistics, running totals and ranked selection without a single-task sort.

A global ``Window.orderBy`` moves all rows into one task. Here the ordered range is cut into many
buckets that are themselves in order. Totals per bucket form a small table (strata x buckets); running
totals over that table give every bucket its starting point, and only the rows inside one bucket are
ever sorted together. All results are exact, whatever the cuts are.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from certiscope.session import shuffle_width

BUCKET = "_bucket"
HASH_BUCKET_BITS = 12
MAX_BUCKETS = 4096
SMALL_TABLE_ROWS = 10_000


def score_cuts(df: DataFrame, score: str, buckets: int | None = None) -> list[float]:
    """Cut points that split the rows into about equally full ranges of ``score``."""
    return sorted(cut_shares(df, score, buckets))


def cut_shares(df: DataFrame, score: str, buckets: int | None = None) -> dict[float, int]:
    """The cut points with how often each came up; above 1 the value alone fills that many ranges.

    One scan of one column. The result is a fixed number of doubles, used only to spread the work.
    """
    wanted = buckets or min(MAX_BUCKETS, 4 * shuffle_width(df.sparkSession))
    probs = [i / wanted for i in range(1, wanted)]
    found = df.approxQuantile(score, probs, 1 / (4 * wanted)) if probs else []
    return dict(Counter(c for c in found if c is not None and math.isfinite(c)))


def with_score_bucket(df: DataFrame, score: str, cuts: list[float]) -> DataFrame:
    """Add the number of the range that ``score`` falls in; lower ranges hold lower scores."""
    if not cuts:
        return df.withColumn(BUCKET, F.lit(0))
    # Never NULL, so that no join adds a filter that keeps Spark from reusing the shuffle below it.
    splits = [-math.inf, *cuts, math.inf]
    out = Bucketizer(splits=splits, inputCol=score, outputCol=BUCKET, handleInvalid="keep").transform(df)
    return out.withColumn(BUCKET, F.coalesce(F.col(BUCKET).cast("int"), F.lit(0)))


def hash_bucket(hash_column: str) -> Column:
    """Leading bits of a 32-bit hash: evenly filled, in hash order."""
    return F.shiftright(F.col(hash_column), 32 - HASH_BUCKET_BITS).cast("int")


def running_totals(cells: DataFrame, order: str, values: list[str], groups: list[str] = ()) -> DataFrame:
    """Add ``cum_<v>`` (this cell included) and ``all_<v>`` along ``order`` within each group.

    ``cells`` has one row per group and order value, and a bucket column. The bucket totals are read
    from the same shuffle as the cells (Spark reuses the exchange), and the join needs no further one.
    """
    groups = list(groups)
    within = Window.partitionBy(*groups, BUCKET).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*groups).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    totals = cells.groupBy(*groups, BUCKET).agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    starts = totals.select(
        *groups,
        BUCKET,
        *[F.coalesce(F.sum(f"_sum_{v}").over(before), F.lit(0)).alias(f"_start_{v}") for v in values],
        *[F.sum(f"_sum_{v}").over(whole).alias(f"all_{v}") for v in values],
    )
    inside = cells.select("*", *[F.sum(v).over(within).alias(f"_run_{v}") for v in values])
    joined = inside.join(starts, [*groups, BUCKET])
    return joined.select(
        *cells.columns,
        *[(F.col(f"_run_{v}") + F.col(f"_start_{v}")).alias(f"cum_{v}") for v in values],
        *[f"all_{v}" for v in values],
    )


def order_cuts(
    df: DataFrame,
    order: list[str],
    bucket: Column,
    quotas: dict[str, Column],
    strata: list[str] = (),
) -> DataFrame:
    """The row key found at given ranks: one row per stratum and quota name.

    ``order`` lists columns that together put the rows in a total ascending order, ``bucket`` is an
    expression that never decreases along it. A quota is an expression over ``n``, the size of the
    stratum, and the strata columns. Ranks below 1 give no row; ranks above ``n`` give the last row.
    """
    strata = list(strata)
    rows = df.dropna(subset=strata) if strata else df
    narrow = rows.select(*strata, *order, bucket.alias(BUCKET))
    upto = Window.partitionBy(*strata).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, 0)
    counts = narrow.groupBy(*strata, BUCKET).agg(F.count(F.lit(1)).alias("_in"))
    sized = counts.select(
        *strata, BUCKET, "_in",
        F.sum("_in").over(upto).alias("_upto"),
        F.sum("_in").over(Window.partitionBy(*strata)).alias("n"),
    )
    wanted = F.array(
        *[F.struct(F.lit(k).alias("quota"), q.cast("bigint").alias("rank")) for k, q in quotas.items()]
    )
    hit = (
        sized.select("*", F.explode(wanted).alias("_q"))
        .withColumn("_rank", F.least(F.col("_q.rank"), F.col("n")))
        .where((F.col("_rank") > F.col("_upto") - F.col("_in")) & (F.col("_rank") <= F.col("_upto")))
        .select(*strata, BUCKET, F.col("_q.quota").alias("quota"),
                (F.col("_rank") - F.col("_upto") + F.col("_in")).alias("_at"))
    )
    inside = Window.partitionBy(*strata, BUCKET, "quota").orderBy(*order)
    wanted_buckets, _ = settle_small(hit)  # one row per stratum and quota
    return (
        narrow.join(wanted_buckets, [*strata, BUCKET])
        .withColumn("_rn", F.row_number().over(inside))
        .where(F.col("_rn") == F.col("_at"))
        .select(*strata, "quota", F.struct(*order).alias("key"))
    )


def settle_small(df: DataFrame, limit: int = SMALL_TABLE_ROWS) -> tuple[DataFrame, list[Row] | None]:
    """Evaluate a table that is expected to be small, once.

    Up to ``limit`` rows come back as a local table marked for broadcast. A larger table is handed back
    as it was and joins through a shuffle.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df, None
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), rows


def attach_cuts(df: DataFrame, cuts: DataFrame, quota_names: list[str], strata: list[str] = ()) -> DataFrame:
    """Join the keys found by :func:`order_cuts` back as one column per quota (``NULL`` if none)."""
    strata = list(strata)
    small, _ = settle_small(cuts)
    wide = small.groupBy(*strata).agg(
        *[F.max(F.when(F.col("quota") == q, F.col("key"))).alias(q) for q in quota_names]
    )
    if not strata:
        one = wide.first()
        schema = wide.schema
        return df.select("*", *[_literal(one[q], schema[q].dataType).alias(q) for q in quota_names])
    settled, _ = settle_small(wide)
    return df.join(settled, strata, "left")


def take_first(
    df: DataFrame, order: list[str], bucket: Column, quota: Column, strata: list[str] = ()
) -> DataFrame:
    """The first ``quota`` rows of every stratum in the given order, exactly; rows keep their columns.

    Only the narrow key columns are ranked, and only inside one bucket per stratum; the full rows are
    filtered where they are read.
    """
    cuts = order_cuts(df, order, bucket, {"_cut": quota}, strata)
    rows = attach_cuts(df, cuts, ["_cut"], strata)
    return rows.where(F.struct(*order) <= F.col("_cut")).drop("_cut")


def exact_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], error: float = 1e-4
) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of many columns.

    A sketch brackets each wanted rank, one pass then counts what lies below the bracket and collects
    the few distinct values inside it. A single-buffer percentile would hold every distinct value of a
    column in one task. Rank errors of the sketch are bounded, and a bracket that still misses is
    widened to the whole column. NaN counts as missing.
    """
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    df = df.select(*[F.nanvl(c, F.lit(None)).alias(c) if c in floats else F.col(c) for c in columns])
    around = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-3 * error, 3 * error)})
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    brackets, widened = [], set()
    for c, found in zip(columns, df.approxQuantile(columns, around, error)):
        at = dict(zip(around, found))  # empty when the column has no values
        for i, p in enumerate(probs):
            if at:
                brackets.append((c, i, at[max(0.0, p - 3 * error)], at[min(1.0, p + 3 * error)]))
    while brackets:
        missed = []
        for (c, i, _, _), value in zip(brackets, _bracketed(df, brackets, probs)):
            if value is None:
                if (c, i) in widened:
                    raise ArithmeticError(f"no value of {c} has the rank of quantile {probs[i]}")
                widened.add((c, i))
                missed.append((c, i, -math.inf, math.inf))
            else:
                out[c][i] = value
        brackets = missed
    return out


def _bracketed(df: DataFrame, brackets: list[tuple], probs: list[float]) -> list[float | None]:
    """Interpolated quantile for each bracket, None where the wanted rank lies outside it."""
    below = [F.count(F.when(F.col(c) < lo, 1)).alias(f"b{k}") for k, (c, _, lo, _) in enumerate(brackets)]
    sizes = [F.count(c).alias(f"n{k}") for k, (c, *_) in enumerate(brackets)]
    known = df.agg(*below, *sizes).first()
    tagged = [
        F.when(F.col(c).between(lo, hi), F.struct(F.lit(k).alias("k"), F.col(c).cast("double").alias("v")))
        for k, (c, _, lo, hi) in enumerate(brackets)
    ]
    cells = (
        df.select(F.explode(F.array_compact(F.array(*tagged))).alias("e"))
        .groupBy(F.col("e.k").alias("k"), F.col("e.v").alias("v"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    ranks = [probs[i] * (known[f"n{k}"] - 1) + 1 for k, (_, i, _, _) in enumerate(brackets)]
    plan = df.sparkSession.createDataFrame(
        [(k, known[f"b{k}"], math.floor(r), math.ceil(r)) for k, r in enumerate(ranks)],
        "k int, start bigint, lo bigint, hi bigint",
    )
    run = Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("upto") - F.col("c")
    ends = (
        cells.withColumn("upto", F.sum("c").over(run))
        .join(F.broadcast(plan), "k")  # one row per column and quantile
        .withColumn("upto", F.col("upto") + F.col("start"))
        .where((F.col("upto") >= F.col("lo")) & (last < F.col("hi")))
        .groupBy("k")
        .agg(F.min(F.when(last < F.col("lo"), F.col("v"))).alias("low"),
             F.max(F.when(F.col("upto") >= F.col("hi"), F.col("v"))).alias("high"))
        .collect()
    )
    found = {r.k: (r.low, r.high) for r in ends}
    values = []
    for k, rank in enumerate(ranks):
        low, high = found.get(k, (None, None))
        ok = low is not None and high is not None
        values.append(low + (high - low) * (rank - math.floor(rank)) if ok else None)
    return values


def _literal(value, data_type) -> Column:
    if value is None:
        return F.lit(None).cast(data_type)
    return F.struct(*[F.lit(value[f.name]).cast(f.dataType).alias(f.name) for f in data_type.fields])
