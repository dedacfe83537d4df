"""Model inputs: parameters are fitted on one table and applied to any other as column expressions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from certiscope import vocab
from certiscope.functions import columns as C
from certiscope.operators.cleaning import check_no_leak, present
from certiscope.operators.ordering import exact_quantiles

# Per one-hot column; more is refused, not truncated. Low enough for Spark to limit rows per task first.
MAX_CATEGORIES = 500


@dataclass
class FeatureEncoder:
    """Fitted parameters. Numbers: median, mean, sd. Ordered text: mode. Nominal text: mode, categories."""

    numeric: list[str]
    ordered: dict[str, list[str]]
    nominal: list[str]
    medians: dict[str, float] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    sds: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)

    def feature_columns(self) -> dict[str, Column]:
        """Feature name -> expression, in the fixed order of the feature vector."""
        out: dict[str, Column] = {}
        for c in self.numeric:
            filled = F.coalesce(F.col(c).cast("double"), F.lit(self.medians[c]))
            out[c] = (filled - self.means[c]) / (self.sds[c] or 1.0)
        for c, order in self.ordered.items():
            filled = F.coalesce(F.col(c), F.lit(self.modes[c]))
            out[c] = C.ordinal(filled, order).cast("double")
        for c in self.nominal:
            filled = F.coalesce(F.col(c), F.lit(self.modes[c]))
            for category in self.categories[c][1:]:
                out[f"{c}_{category}"] = (filled == category).cast("double")
        return out

    @property
    def names(self) -> list[str]:
        return list(self.feature_columns())

    def transform(self, df: DataFrame, name: str = "features") -> DataFrame:
        """Add the features as one ML vector column."""
        return df.withColumn(name, array_to_vector(F.array(*self.feature_columns().values())))

    def wide(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """Key columns and one column per feature."""
        return df.select(*keep, *[e.alias(n) for n, e in self.feature_columns().items()])

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the parameters as a small table."""
        rows = []
        for c in self.numeric:
            for part in ("medians", "means", "sds"):
                rows.append((part, c, 0, None, float(getattr(self, part)[c])))
        for c, order in self.ordered.items():
            rows += [("order", c, i, v, None) for i, v in enumerate(order)]
        rows += [("modes", c, 0, v, None) for c, v in self.modes.items()]
        for c in self.nominal:
            rows += [("categories", c, i, v, None) for i, v in enumerate(self.categories[c])]
        rows += [("numeric", c, i, None, None) for i, c in enumerate(self.numeric)]
        rows += [("ordered", c, i, None, None) for i, c in enumerate(self.ordered)]
        rows += [("nominal", c, i, None, None) for i, c in enumerate(self.nominal)]
        schema = "part string, feature string, place int, text string, value double"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeatureEncoder":
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r.place)

        def listed(part):
            return [r.feature for r in rows if r.part == part]

        def texts(part, feature):
            return [r.text for r in rows if r.part == part and r.feature == feature]

        def values(part):
            return {r.feature: r.value for r in rows if r.part == part}

        return cls(
            numeric=listed("numeric"),
            ordered={c: texts("order", c) for c in listed("ordered")},
            nominal=listed("nominal"),
            medians=values("medians"),
            means=values("means"),
            sds=values("sds"),
            modes={r.feature: r.text for r in rows if r.part == "modes"},
            categories={c: texts("categories", c) for c in listed("nominal")},
        )


def default_inputs(df: DataFrame) -> FeatureEncoder:
    """Unfitted encoder over the usual model inputs that the table has."""
    ordered = {c: vocab.RATINGS_WORST_FIRST for c in present(df, ["CURRENT_ENERGY_RATING"])}
    ordered |= {c: vocab.COMPONENT_LEVELS for c in present(df, vocab.COMPONENT_RATINGS)}
    return FeatureEncoder(present(df, vocab.NUMERIC_INPUTS), ordered, present(df, vocab.NOMINAL_INPUTS))


def _value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def modes(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest one among equals."""
    best = _value_counts(df, columns).groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value")
    )
    return {r["column"]: r["value"] for r in best.collect()}


def categories(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted distinct values per column; a column too wide for one-hot encoding is an error."""
    rank = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    rows = _value_counts(df, columns).withColumn("rn", rank).where(F.col("rn") <= MAX_CATEGORIES + 1).collect()
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        found[r["column"]].append(r["value"])
    for c, values in found.items():
        if len(values) > MAX_CATEGORIES:
            raise ValueError(f"{c} has more than {MAX_CATEGORIES} categories")
        values.sort()
    return found


def fit_features(df: DataFrame, inputs: FeatureEncoder | None = None) -> FeatureEncoder:
    """Fit medians, then mean and population sd of the filled columns, modes and categories."""
    enc = inputs or default_inputs(df)
    check_no_leak([*enc.numeric, *enc.ordered, *enc.nominal])
    if enc.numeric:
        enc.medians = {c: q[0] for c, q in exact_quantiles(df, enc.numeric, [0.5]).items()}
        filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(enc.medians[c])) for c in enc.numeric}
        moments = df.agg(
            *[F.avg(e).alias(f"m:{c}") for c, e in filled.items()],
            *[F.stddev_pop(e).alias(f"s:{c}") for c, e in filled.items()],
        ).first()
        enc.means = {c: moments[f"m:{c}"] for c in enc.numeric}
        enc.sds = {c: moments[f"s:{c}"] for c in enc.numeric}
    text = [*enc.ordered, *enc.nominal]
    if text:
        enc.modes = modes(df, text)
    if enc.nominal:
        enc.categories = categories(df, enc.nominal)
    return enc


def add_age_year(df: DataFrame, band: str = "CONSTRUCTION_AGE_BAND", name: str = "AGE_BAND_YEAR") -> DataFrame:
    """Midpoint year of the age band; unmapped bands get the median midpoint.

    The median runs over at most twelve distinct values, so the single-buffer aggregate is small.
    """
    mid = C.age_midpoint(band)
    middle = df.agg(F.median(mid)).first()[0]
    return df.withColumn(name, F.coalesce(mid, F.lit(middle).cast("double")))


SIMPLE_NUMERIC = ["CURRENT_ENERGY_EFFICIENCY", "TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS", "AGE_BAND_YEAR"]
SIMPLE_NOMINAL = ["PROPERTY_TYPE", "BUILT_FORM", "TENURE", "WALL_TYPE"]


def simple_matrix(df: DataFrame, keep: list[str] = (), label: str = "RETROFIT_POTENTIAL") -> DataFrame:
    """Four numbers (missing -> median) and four categories (missing -> 'unknown') as dummies, first dropped."""
    numeric = present(df, SIMPLE_NUMERIC)
    nominal = present(df, SIMPLE_NOMINAL)
    middles = exact_quantiles(df, numeric, [0.5])
    filled = df.na.fill("unknown", nominal)
    levels = categories(filled, nominal)
    return filled.select(
        *keep,
        *[F.coalesce(F.col(c).cast("double"), F.lit(middles[c][0])).alias(c) for c in numeric],
        *[(F.col(c) == v).cast("int").alias(f"{c}_{v}") for c in nominal for v in levels[c][1:]],
        F.col(label),
    )


def missing_cells(matrix: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, columns and number of missing cells of a feature matrix; 0 is the only good answer."""
    holes = sum((F.col(c).isNull().cast("bigint") for c in columns), F.lit(0))
    return matrix.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(columns)).cast("bigint").alias("n_columns"),
        F.sum(holes).alias("missing_cells"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (classes * n_class) per class, and negatives / positives."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()  # over one row per class
    total, classes = F.sum("n").over(every), F.count(F.lit(1)).over(every)
    neg = F.sum(F.when(F.col(label) == 0, F.col("n"))).over(every)
    pos = F.sum(F.when(F.col(label) == 1, F.col("n"))).over(every)
    return counts.select(
        label, "n", (total / (classes * F.col("n"))).alias("balanced_weight"), C.ratio(neg, pos, None).alias("pos_weight")
    )
