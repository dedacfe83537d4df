"""Fitting and comparing classifiers with Spark ML. All fits run on the executors.

Tables carry a vector column ``features``, an integer ``label`` and a unique key; scores are columns of
the same rows, tied by key and never by position.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import product
from statistics import fmean, pstdev

import numpy as np
from pyspark.ml import Model, Pipeline
from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType
from pyspark.sql.window import Window

from certiscope.functions.columns import hash_rank
from certiscope.operators import exchange
from certiscope.operators.features import FeatureEncoder, class_weights
from certiscope.operators.metrics import RANK, class_scores, confusion, range_areas, roc_auc, score_summary
from certiscope.operators.ordering import BUCKET, MAX_BUCKETS, score_cuts
from certiscope.operators.sampling import stratified_folds
from certiscope.session import stored

WEIGHT = "weight"
FINAL_TREES = 300
SEARCH_TREES = 200
BOOST_ROUNDS = 300
BLOCK_ROWS = 100_000  # rows that one task orders when features are shuffled

# Settings tried in the search, by model.
GRIDS: dict[str, dict[str, list]] = {
    "logistic": {"C": [0.01, 0.1, 1, 10, 100]},
    "forest": {"max_features": ["sqrt", "0.3"], "min_leaf": [1, 5]},
    "boosting": {"max_depth": [4, 6], "rate": [0.05, 0.1]},
    "svm": {"C": [0.01, 0.1, 1]},
}


class MacroF1(Evaluator):
    """Unweighted mean of the F1 of both classes; the built-in f1 weights by class size."""

    def __init__(self, label: str = "label", pred: str = "prediction"):
        super().__init__()
        self.label, self.pred = label, pred

    def _evaluate(self, dataset: DataFrame) -> float:
        return confusion(dataset, self.label, self.pred).select(class_scores()["f1_macro"]).first()[0]

    def isLargerBetter(self) -> bool:
        return True


def balanced(df: DataFrame, label: str = "label") -> DataFrame:
    """Add the balanced class weight as a column; the weights are two numbers."""
    weights = {r[label]: r.balanced_weight for r in class_weights(df, label).collect()}
    out = F.lit(1.0)
    for value, weight in weights.items():
        out = F.when(F.col(label) == value, F.lit(weight)).otherwise(out)
    return df.withColumn(WEIGHT, out)


def boosted_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Positives weigh negatives / positives, negatives weigh one."""
    ratio = class_weights(df, label).select("pos_weight").first()[0]
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, F.lit(ratio)).otherwise(1.0))


def logistic(rows: int, C: float = 1.0, max_iter: int = 1000) -> LogisticRegression:
    """L2 strength 1/C on the summed loss. Balanced weights sum to the number of rows."""
    return LogisticRegression(weightCol=WEIGHT, regParam=1 / (C * rows), standardization=False, maxIter=max_iter)


def forest(rows: int = 0, max_features: str = "sqrt", min_leaf: int = 1, trees: int = FINAL_TREES,
           depth: int = 30, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(
        weightCol=WEIGHT, numTrees=trees, maxDepth=depth, featureSubsetStrategy=max_features,
        minInstancesPerNode=min_leaf, seed=seed,
    )


def boosting(rows: int = 0, max_depth: int = 6, rate: float = 0.1, rounds: int = BOOST_ROUNDS,
             seed: int = 42) -> GBTClassifier:
    return GBTClassifier(
        weightCol=WEIGHT, maxIter=rounds, maxDepth=max_depth, stepSize=rate, subsamplingRate=0.8,
        featureSubsetStrategy="0.8", seed=seed,
    )


def positive_score(column: str = "probability") -> Column:
    return vector_to_array(column)[1]


def score(model: Model, df: DataFrame, name: str = "score", keep: list[str] | None = None) -> DataFrame:
    """Probability of the positive class as a column next to the row's own columns."""
    kept = keep if keep is not None else df.columns
    return model.transform(df).select(*kept, positive_score().alias(name))


# --- calibrated linear SVM ----------------------------------------------------------------------


@dataclass
class CalibratedSvm:
    """One linear machine and one sigmoid per fold; the score is the mean of the fold probabilities."""

    parts: list[tuple[Model, float, float]]

    def transform(self, df: DataFrame, name: str = "score") -> DataFrame:
        columns, out, probabilities = df.columns, df, []
        for i, (machine, slope, offset) in enumerate(self.parts):
            raw = f"_raw{i}"
            out = machine.copy({machine.rawPredictionCol: raw, machine.predictionCol: f"_pred{i}"}).transform(out)
            probabilities.append(1 / (1 + F.exp(-(slope * vector_to_array(raw)[1] + offset))))
        return out.select(*columns, (sum(probabilities[1:], probabilities[0]) / len(probabilities)).alias(name))


def _sigmoid(held: DataFrame, label: str) -> tuple[float, float]:
    """Slope and offset of the sigmoid on the margin, with the usual smoothed targets.

    A soft target t is the pair (1 with weight t, 0 with weight 1 - t) of the same row.
    """
    neg, pos = held.agg(F.sum(1 - F.col(label)), F.sum(label)).first()
    target = F.when(F.col(label) == 1, (pos + 1) / (pos + 2)).otherwise(1 / (neg + 2))
    margin = vector_to_array("rawPrediction")[1]
    pairs = F.array(F.struct(F.lit(1.0).alias("y"), target.alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - target).alias("w")))
    soft = held.select(array_to_vector(F.array(margin)).alias("features"), F.explode(pairs).alias("p")).select(
        "features", F.col("p.y").alias("label"), F.col("p.w").alias(WEIGHT)
    )
    fit = LogisticRegression(weightCol=WEIGHT, standardization=False).fit(soft)
    return float(fit.coefficients[0]), float(fit.intercept)


def fit_calibrated_svm(df: DataFrame, keys: list[str], C: float = 1.0, folds: int = 5, label: str = "label",
                       max_iter: int = 100, seed: int = 42) -> CalibratedSvm:
    """Linear SVM with sigmoid calibration on held-out folds (hinge loss, balanced weights)."""
    folded = stratified_folds(balanced(df, label), folds, label, keys, seed, "_fold").persist()
    parts = []
    for k in range(folds):
        train, held = folded.where(F.col("_fold") != k), folded.where(F.col("_fold") == k)
        machine = LinearSVC(
            weightCol=WEIGHT, regParam=1 / (C * train.count()), standardization=False, maxIter=max_iter
        ).fit(train)
        parts.append((machine, *_sigmoid(machine.transform(held), label)))
    folded.unpersist()
    return CalibratedSvm(parts)


# --- search and nested cross-validation ---------------------------------------------------------

Builder = Callable[..., Estimator]  # build(rows=..., **setting); rows is the size of the training part


def settings(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def grid_search(df: DataFrame, build: Builder, grid: dict[str, list], keys: list[str], folds: int = 3,
                label: str = "label", parallelism: int = 4, seed: int = 42) -> tuple[dict, float]:
    """Best setting by mean macro F1 over stratified folds; the first one wins ties."""
    tried = settings(grid)
    rows = df.count() * (folds - 1) // folds
    estimators = [build(rows=rows, **s) for s in tried]
    folded = stratified_folds(df, folds, label, keys, seed, "_fold").persist()
    stages = Pipeline(stages=[])
    maps = [{stages.stages: [e]} for e in estimators]
    search = CrossValidator(
        estimator=stages, estimatorParamMaps=maps, evaluator=MacroF1(label), numFolds=folds, foldCol="_fold",
        parallelism=parallelism, seed=seed,
    ).fit(folded)
    folded.unpersist()
    means = list(search.avgMetrics)
    best = max(range(len(means)), key=lambda i: (means[i], -i))
    return tried[best], means[best]


def most_chosen(picks: DataFrame, fold: str, value: str) -> DataFrame:
    """The value picked in most folds; among equals the one picked first."""
    counts = picks.groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.min(fold).alias("first"))
    return counts.agg(
        F.min_by(value, F.struct(-F.col("n"), F.col("first"))).alias(value), F.max("n").alias("n_folds")
    )


def nested_cv(df: DataFrame, build: Builder, grid: dict[str, list], keys: list[str], outer: int = 5, inner: int = 3,
              label: str = "label", parallelism: int = 4, seed: int = 42) -> tuple[DataFrame, dict]:
    """Outer folds measure, inner folds choose. Returns one row per outer fold and the most chosen setting."""
    folded = stratified_folds(df, outer, label, keys, seed, "_outer").persist()
    rows, picks = [], []
    for k in range(outer):
        train = balanced(folded.where(F.col("_outer") != k).drop("_outer"), label).persist()
        best, inner_f1 = grid_search(train, build, grid, keys, inner, label, parallelism, seed)
        model = build(rows=train.count(), **best).fit(train)
        held = model.transform(folded.where(F.col("_outer") == k).withColumn(WEIGHT, F.lit(1.0)))
        f1 = MacroF1(label)._evaluate(held)
        auc = roc_auc(held.select(label, positive_score().alias("s")), label, "s").first().roc_auc
        rows.append((k, str(best), float(inner_f1), float(f1), auc))
        picks.append(best)
        train.unpersist()
    folded.unpersist()
    schema = "fold int, setting string, inner_f1_macro double, f1_macro double, roc_auc double"
    chosen = {name: Counter(p[name] for p in picks).most_common(1)[0][0] for name in grid}
    return df.sparkSession.createDataFrame(rows, schema), chosen


def fold_summary(folds: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold measures."""
    return folds.agg(
        *[f(c).alias(f"{c}_{n}") for c in ("f1_macro", "roc_auc") for f, n in ((F.avg, "mean"), (F.stddev_pop, "sd"))]
    )


def naive_inputs(rating_order: list[str]) -> FeatureEncoder:
    """The two structural inputs that alone explain much of the label."""
    return FeatureEncoder(["CURRENT_ENERGY_EFFICIENCY"], {"CURRENT_ENERGY_RATING": rating_order}, [])


# --- walk-forward -------------------------------------------------------------------------------


def walk_forward_years(years: Iterable[int], first_train: int = 2) -> list[tuple[list[int], int]]:
    """Growing training windows, each tested on the year right after it."""
    ordered = sorted(years)
    return [(ordered[:i], ordered[i]) for i in range(first_train, len(ordered))]


def walk_forward(df: DataFrame, folds: list[tuple[list[int], int]], year: str, build: Callable[[], Estimator],
                 encode: Callable[[DataFrame], FeatureEncoder], sample: Callable[[DataFrame, int], DataFrame],
                 label: str = "label") -> DataFrame:
    """One row of measures per fold. ``sample(rows, n_years)`` draws the yearly samples of a window."""
    rows = []
    for train_years, test_year in folds:
        train = sample(df.where(F.col(year).isin(train_years)), len(train_years)).persist()
        test = sample(df.where(F.col(year) == test_year), 1)
        encoder = encode(train)
        model = build().fit(balanced(encoder.transform(train), label))
        scored = score(model, encoder.transform(test).withColumn(WEIGHT, F.lit(1.0)), "s", [label]).persist()
        m = score_summary(scored, label, "s").first()
        n, rate = train.agg(F.count(F.lit(1)), F.avg(label)).first()
        rows.append((f"{train_years[0]}-{train_years[-1]}", test_year, n, m.n, float(rate), m.positive_rate,
                     m.roc_auc, m.f1_macro, m.average_precision, m.recall))
        train.unpersist()
        scored.unpersist()
    schema = ("train_years string, test_year int, n_train bigint, n_test bigint, train_positive_rate double, "
              "test_positive_rate double, test_roc_auc double, test_f1_macro double, test_pr_auc double, test_recall double")
    return df.sparkSession.createDataFrame(rows, schema)


# --- importances --------------------------------------------------------------------------------


def importances(spark: SparkSession, model: Model, names: list[str]) -> DataFrame:
    """Built-in importances or coefficients with the feature names."""
    values = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, values.toArray())], "feature string, importance double")


def shuffle_places(df: DataFrame, keys: list[str], seed: int, blocks: int) -> DataFrame:
    """Rows fall into blocks by one hash, ``_block``, and stand in the order of a second one, ``_place``, inside the block."""
    return df.withColumns(
        {"_block": F.pmod(hash_rank(seed, *keys), F.lit(blocks)), "_place": hash_rank(seed + 1, *keys)}
    )


def shuffled_features(df: DataFrame, keys: list[str], seed: int, blocks: int) -> DataFrame:
    """Give every row the feature vector of another row, as ``partner``: one shuffle for all features.

    The partner is the next row of the block, the last row takes the first. Every value is used exactly once.
    """
    placed = shuffle_places(df, keys, seed, blocks)
    w = Window.partitionBy("_block").orderBy("_place", *keys)
    following = F.lead("features").over(w)
    first = F.first("features").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn("partner", F.coalesce(following, first)).drop("_block", "_place")


def permutation_importance(model: Model, df: DataFrame, names: list[str], keys: list[str], label: str = "label",
                           repeats: int = 10, seed: int = 42) -> DataFrame:
    """Mean and deviation of the ROC-AUC lost when one feature is shuffled.

    The ranges of the score are cut once, on the rows as they are: cutting them on the shuffled rows would
    score rows x features a second time in every repeat. Results are exact for any cuts. A logistic model is
    scored from the terms of its sum; any other one scores the mixed vectors.
    """
    linear = exchange.linear_part(model)
    if linear:
        whole, exchanged = _linear_exchange(*linear, df, keys, label)
    else:
        whole, exchanged = _scored_exchange(model, df, len(names), keys, label)
    drops: dict[str, list[float]] = {n: [] for n in names}
    for r in range(repeats):
        for row in exchanged(seed + 2 * r).collect():
            drops[names[row["_j"] - 1]].append(whole - row.roc_auc)
    out = [(n, fmean(d), pstdev(d)) for n, d in drops.items()]
    return df.sparkSession.createDataFrame(out, "feature string, importance double, sd double")


def _linear_exchange(coefficients: np.ndarray, intercept: float, df: DataFrame, keys: list[str],
                     label: str) -> tuple[float, Callable[[int], DataFrame]]:
    """ROC-AUC of the rows as they are, and of every feature shuffled by a seed."""
    wide = df.select(*keys, label, vector_to_array("features").alias("_terms"))
    schema = StructType([*wide.schema.fields[:-1], StructField("_terms", BinaryType()), StructField("_s", DoubleType())])
    rows = stored(wide.mapInArrow(lambda it: exchange.pack_terms(it, coefficients, intercept), schema))
    ranked = rows.select((-F.col("_s")).alias(RANK)).where(~F.isnan(RANK))
    cuts = score_cuts(ranked, RANK, min(MAX_BUCKETS, 1 + rows.count() // exchange.RANGE_ROWS))
    limits = np.unique(-np.array(cuts, dtype=float))

    def areas(blocks: DataFrame) -> DataFrame:
        return range_areas(blocks.groupBy("_j", BUCKET).applyInArrow(exchange.range_pairs, exchange.SUMS), ["_j"])

    own = rows.select(F.col(label).alias("_label"), "_terms")
    base = areas(own.mapInArrow(
        lambda it: exchange.score_blocks(exchange.own_scores(it, intercept), limits, 0), exchange.BLOCKS)).first()
    blocks = 1 + (base.positives + base.negatives) // BLOCK_ROWS

    def exchanged(seed: int) -> DataFrame:
        """The pairs of :func:`shuffled_features`, made where the rows are scored."""
        order = F.shiftleft("_block", 32) + F.col("_place")  # one number, which a sort compares before the rows
        placed = shuffle_places(rows, keys, seed, blocks).repartition("_block").sortWithinPartitions(order, *keys)
        return areas(placed.select("_block", F.col(label).alias("_label"), "_terms").mapInArrow(
            lambda it: exchange.score_blocks(exchange.exchanged_scores(it, intercept), limits, 1), exchange.BLOCKS))

    return base.roc_auc, exchanged


def _scored_exchange(model: Model, df: DataFrame, width: int, keys: list[str],
                     label: str) -> tuple[float, Callable[[int], DataFrame]]:
    """The same for a model that has to score every mixed vector."""
    rows = stored(df.select(*keys, label, "features"))
    plain = score(model, rows, "s", [label])
    cuts = score_cuts(plain.select((-F.col("s")).alias(RANK)).where(~F.isnan(RANK)), RANK)
    base = roc_auc(plain, label, "s", cuts=cuts).first()
    blocks = 1 + (base.positives + base.negatives) // BLOCK_ROWS

    def exchanged(seed: int) -> DataFrame:
        pairs = shuffled_features(rows, keys, seed, blocks)
        own, other = vector_to_array("features"), vector_to_array("partner")
        tried = pairs.select(label, own.alias("_own"), other.alias("_other"), F.explode(F.sequence(F.lit(1), F.lit(width))).alias("_j"))
        mixed = F.concat(F.slice("_own", F.lit(1), F.col("_j") - 1), F.array(F.get("_other", F.col("_j") - 1)),
                         F.slice("_own", F.col("_j") + 1, F.lit(width)))
        scored = score(model, tried.select(label, "_j", array_to_vector(mixed).alias("features")), "s", [label, "_j"])
        return roc_auc(scored, label, "s", ["_j"], cuts)

    return base.roc_auc, exchanged
