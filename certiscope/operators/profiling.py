"""Profiles of a table: balance, missing and negative values, distributions, correlation, rates."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from certiscope import vocab
from certiscope.functions import columns as C
from certiscope.operators.cleaning import present
from certiscope.operators.ordering import exact_quantiles, settle_small


def class_balance(df: DataFrame, label: str, groups: list[str] = ()) -> DataFrame:
    """Rows and share of every class within each group."""
    counts = df.groupBy(*groups, label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*groups))
    return counts.withColumn("share", F.col("n") / total)


def _per_column(df: DataFrame, aggregates: dict[str, dict[str, Column]]) -> DataFrame:
    """One pass over the table, then one row per column: {column: {measure: aggregate}}."""
    flat = [a.alias(f"{c}:{m}") for c, measures in aggregates.items() for m, a in measures.items()]
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}:{m}`").alias(m) for m in measures])
        for c, measures in aggregates.items()
    ]
    return df.agg(*flat).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def missing_profile(df: DataFrame, columns: list[str] | None = None, alarm: float = 0.05) -> DataFrame:
    """Missing share of every column that has missing values, and whether it passes the alarm level."""
    wanted = columns or df.columns
    measures = {c: {"missing_rate": F.avg(F.col(c).isNull().cast("int"))} for c in wanted}
    rates = _per_column(df, measures)
    return rates.where("missing_rate > 0").withColumn("over_alarm", F.col("missing_rate") > alarm)


def negative_audit(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Number of negative values and the minimum, for the columns that have negative values."""
    found = present(df, columns or vocab.NON_NEGATIVE_COLUMNS)
    measures = {
        c: {
            "negatives": F.coalesce(F.sum((F.col(c) < 0).cast("bigint")), F.lit(0)),
            "minimum": F.min(c).cast("double"),
        }
        for c in found
    }
    return _per_column(df, measures).where("negatives > 0")


def negative_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    found = present(df, columns or vocab.NON_NEGATIVE_COLUMNS)
    bad = C.any_negative(found).cast("int")
    return df.agg(F.sum(bad).alias("rows_with_negative"), F.avg(bad).alias("share"))


def table_summary(df: DataFrame, label: str) -> DataFrame:
    """Rows, positives, positive rate, columns, rows with any missing value."""
    missing = C.any_missing(df.columns).cast("int")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(label).alias("positives"),
        F.avg(label).alias("positive_rate"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.sum(missing).alias("rows_with_missing"),
        F.avg(missing).alias("missing_share"),
    )


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Value counts of several columns in one pass; missing values are not counted."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.explode(F.array(*pairs)).alias("p"))
        .select("p.*")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """Type and number of filled values of every column."""
    types = dict(df.dtypes)
    return _per_column(df, {c: {"filled": F.count(c)} for c in df.columns}).withColumn(
        "type", F.create_map(*[F.lit(x) for pair in types.items() for x in pair])[F.col("column")]
    )


def cap_at_percentile(df: DataFrame, column: str, prob: float = 0.99) -> DataFrame:
    """Rows with a value up to the given exact percentile."""
    cap = exact_quantiles(df, [column], [prob])[column][0]
    return df.where(F.col(column) <= F.lit(cap))


def class_histogram(df: DataFrame, column: str, label: str, bins: int = 40) -> DataFrame:
    """Density histogram per class, each over its own range, empty bins left out.

    The rows are reduced to (class, value) counts first, so the ranges are joined to those.
    """
    cells = (
        df.where(F.col(column).isNotNull() & F.col(label).isNotNull())
        .groupBy(label, F.col(column).cast("double").alias("x"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    edges = cells.groupBy(label).agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("c").alias("n")
    )
    flat = F.col("lo") == F.col("hi")
    edges = edges.select(
        label, "n",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    ranges, _ = settle_small(edges)
    guess = F.least(F.floor((F.col("x") - F.col("lo")) / F.col("width")), F.lit(bins - 1))
    joined = cells.join(ranges, label).withColumn("g", guess)
    # A quotient that rounds across an edge is put back by comparing with the edge itself.
    placed = (
        F.when(F.col("x") < F.col("lo") + F.col("g") * F.col("width"), F.col("g") - 1)
        .when(
            (F.col("g") < bins - 1) & (F.col("x") >= F.col("lo") + (F.col("g") + 1) * F.col("width")),
            F.col("g") + 1,
        )
        .otherwise(F.col("g"))
    )
    return (
        joined.groupBy(label, placed.cast("int").alias("bin"), "lo", "width", "n")
        .agg(F.sum("c").alias("count"))
        .select(
            label, "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("left_edge"),
            "count",
            (F.col("count") / (F.col("n") * F.col("width"))).alias("density"),
        )
    )


def correlation_matrix(df: DataFrame, columns: list[str], labels: dict[str, str] | None = None) -> DataFrame:
    """Pearson correlation of every pair (lower triangle), over the rows where both are present."""
    names = labels or {}
    pairs = {
        (a, b): F.corr(F.col(a).cast("double"), F.col(b).cast("double")) for b, a in combinations(columns, 2)
    }
    flat = [v.alias(f"p{i}") for i, v in enumerate(pairs.values())]
    rows = [
        F.struct(
            F.lit(names.get(a, a)).alias("row"), F.lit(names.get(b, b)).alias("col"), F.col(f"p{i}").alias("r")
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return df.agg(*flat).select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def crosstab_percent(df: DataFrame, rows: str, cols: str, order: list[str]) -> DataFrame:
    """Row percentages of a two-way count with the columns in the given order."""
    counts = (
        df.where(F.col(rows).isNotNull()).groupBy(rows).pivot(cols, order).agg(F.count(F.lit(1))).na.fill(0, order)
    )
    total = sum((F.col(o) for o in order[1:]), F.col(order[0]))
    return counts.select(rows, *[(100.0 * F.col(o) / total).alias(f"pct_{o}") for o in order])


def rate_by_band(df: DataFrame, band: str, label: str, order: list[str]) -> DataFrame:
    """Label rate per band with the place of the band, against the overall mean of the table.

    Values outside ``order`` count for the overall mean only, as one group.
    """
    known = F.when(F.col(band).isin(order), F.col(band)).alias(band)
    grouped = df.groupBy(known).agg(F.count(label).alias("n"), F.sum(label).alias("hits"))
    everything = Window.partitionBy()  # over the handful of band rows
    overall = F.sum("hits").over(everything) / F.sum("n").over(everything)
    place = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(band))
    return (
        grouped.withColumn("overall_rate", overall)
        .where(F.col(band).isNotNull())
        .select(band, place.cast("int").alias("place"), "n", (F.col("hits") / F.col("n")).alias("rate"), "overall_rate")
    )
