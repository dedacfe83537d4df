"""Measures of scored tables. ``label`` is 0/1; ``groups`` (for example ``model``) may be empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from certiscope.functions.columns import ratio
from certiscope.functions.stats import CHI2_95, chi2_1_tail
from certiscope.operators.ordering import BUCKET, running_totals, score_cuts, with_score_bucket

RANK = "_rank"  # the negated score: ascending rank is descending score


def classify(score: str | Column, threshold: float = 0.5) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    return (score >= threshold).cast("int")


def long_scores(df: DataFrame, label: str, scores: dict[str, str], keep: list[str] = ()) -> DataFrame:
    """One row per model: {model name: score column} to columns model, score."""
    pairs = [F.struct(F.lit(m).alias("model"), F.col(c).alias("score")) for m, c in scores.items()]
    return df.select(*keep, F.col(label).alias("label"), F.explode(F.array(*pairs)).alias("s")).select(
        *keep, "label", "s.model", "s.score"
    )


def confusion(df: DataFrame, label: str, pred: str | Column, groups: list[str] = ()) -> DataFrame:
    """tn, fp, fn, tp per group; groups that are NULL are left out."""
    pred = F.col(pred) if isinstance(pred, str) else pred
    base = df.dropna(subset=list(groups)) if groups else df

    def hits(want_label: int, want_pred: int) -> Column:
        hit = (F.col(label) == want_label) & (pred == want_pred)
        return F.coalesce(F.sum(hit.cast("bigint")), F.lit(0))

    return base.groupBy(*groups).agg(
        hits(0, 0).alias("tn"), hits(0, 1).alias("fp"), hits(1, 0).alias("fn"), hits(1, 1).alias("tp")
    )


def class_scores() -> dict[str, Column]:
    """Measures over the four counts; a measure with an empty denominator is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    f1_pos = ratio(2 * tp, 2 * tp + fp + fn)
    f1_neg = ratio(2 * tn, 2 * tn + fn + fp)
    return {
        "accuracy": ratio(tp + tn, n),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": f1_pos,
        "f1_macro": (f1_pos + f1_neg) / 2,
        "f1_weighted": ratio(f1_pos * (tp + fn) + f1_neg * (tn + fp), n),
    }


def with_class_scores(counts: DataFrame) -> DataFrame:
    return counts.withColumns(class_scores())


def classification_report(df: DataFrame, label: str, pred: str | Column, groups: list[str] = ()) -> DataFrame:
    """Per-class rows, macro and weighted means: precision, recall, f1, support."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    pos, neg = tp + fn, tn + fp

    def row(name, p, r, f, support):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), support.alias("support"))

    one = (ratio(tp, tp + fp), ratio(tp, pos), ratio(2 * tp, 2 * tp + fp + fn))
    zero = (ratio(tn, tn + fn), ratio(tn, neg), ratio(2 * tn, 2 * tn + fn + fp))
    macro = [(a + b) / 2 for a, b in zip(zero, one)]
    weighted = [ratio(a * neg + b * pos, neg + pos) for a, b in zip(zero, one)]
    accuracy = ratio(tp + tn, pos + neg)
    rows = F.array(
        row("low", *zero, neg), row("high", *one, pos), row("macro avg", *macro, neg + pos),
        row("weighted avg", *weighted, neg + pos), row("accuracy", accuracy, accuracy, accuracy, neg + pos),
    )
    return confusion(df, label, pred, groups).select(*groups, F.explode(rows).alias("r")).select(*groups, "r.*")


def score_cells(df: DataFrame, label: str, score: str, groups: list[str] = (), cuts: list[float] | None = None) -> DataFrame:
    """Positives and negatives per distinct score, cut into ranges of descending score.

    The ranges are sketched from ``df``, which is another pass over it, unless ``cuts`` (of the negated score) are given.

    Equal scores are merged before anything is ordered, so a score shared by a large part of the
    rows is one cell.
    """
    groups = list(groups)
    for c in [label, score, *groups]:
        df = df.where(F.col(c).isNotNull())
    base = df.where(~F.isnan(score)).select(
        *groups, F.col(label).cast("bigint").alias("_label"), (-F.col(score)).alias(RANK)
    )
    base = with_score_bucket(base, RANK, score_cuts(base, RANK) if cuts is None else cuts)
    return base.groupBy(*groups, BUCKET, RANK).agg(
        F.sum("_label").alias("pos"), F.sum(1 - F.col("_label")).alias("neg")
    )


def roc_auc(df: DataFrame, label: str, score: str, groups: list[str] = (), cuts: list[float] | None = None) -> DataFrame:
    """Area under the ROC curve, ties counted half; NULL when a class is missing.

    Pairs inside a range are counted there; pairs across ranges follow from the totals of the ranges.
    """
    groups = list(groups)
    cells = score_cells(df, label, score, groups, cuts)
    above = Window.partitionBy(*groups, BUCKET).orderBy(RANK).rowsBetween(Window.unboundedPreceding, -1)
    pairs = F.col("neg") * (F.coalesce(F.sum("pos").over(above), F.lit(0)) + F.col("pos") / 2)
    ranges = (
        cells.withColumn("_pairs", pairs)
        .groupBy(*groups, BUCKET)
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("_pairs").alias("pairs"))
    )
    return range_areas(ranges, groups)


def range_areas(ranges: DataFrame, groups: list[str] = ()) -> DataFrame:
    """ROC-AUC from positives, negatives and pairs inside each range; pairs across ranges follow from the totals."""
    groups = list(groups)
    earlier = Window.partitionBy(*groups).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    across = F.col("neg") * F.coalesce(F.sum("pos").over(earlier), F.lit(0)).cast("double")
    return (
        ranges.withColumn("pairs", F.col("pairs") + across)
        .groupBy(*groups)
        .agg(
            F.sum("pos").alias("positives"),
            F.sum("neg").alias("negatives"),
            ratio(F.sum("pairs"), F.sum("pos").cast("double") * F.sum("neg"), None).alias("roc_auc"),
        )
    )


def _along_scores(df: DataFrame, label: str, score: str, groups: list[str]) -> DataFrame:
    """Cells with running counts of the rows that score at least as high (cum_*) and the totals (all_*)."""
    return running_totals(score_cells(df, label, score, groups), RANK, ["pos", "neg"], groups)


def average_precision(df: DataFrame, label: str, score: str, groups: list[str] = ()) -> DataFrame:
    """Sum of recall steps times precision (no interpolation)."""
    step = F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return (
        _along_scores(df, label, score, list(groups))
        .groupBy(*groups)
        .agg(ratio(F.sum(step), F.max("all_pos"), None).alias("average_precision"))
    )


def score_summary(df: DataFrame, label: str, score: str, groups: list[str] = (), threshold: float = 0.5) -> DataFrame:
    """Threshold measures, ROC-AUC and average precision together, from one pass over the cells."""
    cells = _along_scores(df, label, score, list(groups))
    flagged = -F.col(RANK) >= threshold

    def total(keep: Column, what: str) -> Column:
        return F.sum(F.when(keep, F.col(what)).otherwise(0))

    pairs = F.col("neg") * (F.col("cum_pos") - F.col("pos") + F.col("pos") / 2)
    step = F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    counts = cells.groupBy(*groups).agg(
        total(flagged, "pos").alias("tp"),
        total(flagged, "neg").alias("fp"),
        total(~flagged, "pos").alias("fn"),
        total(~flagged, "neg").alias("tn"),
        F.sum(pairs).alias("_pairs"),
        F.sum(step).alias("_steps"),
    )
    pos, neg = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    return with_class_scores(counts).withColumns(
        {
            "n": pos + neg,
            "positive_rate": ratio(pos, pos + neg),
            "roc_auc": ratio("_pairs", pos.cast("double") * neg, None),
            "average_precision": ratio("_steps", pos, None),
        }
    ).drop("_pairs", "_steps")


def roc_curve(df: DataFrame, label: str, score: str, groups: list[str] = (), drop_intermediate: bool = True) -> DataFrame:
    """Threshold, false and true positive rate; starts at (0, 0), whose threshold is NULL.

    ``drop_intermediate`` leaves out points that lie on a straight line between their neighbours with
    equal steps, as the usual curve routine does.
    """
    groups = list(groups)
    cells = score_cells(df, label, score, groups)
    points = running_totals(cells, RANK, ["pos", "neg"], groups)
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    last = (F.col("cum_pos") == F.col("all_pos")) & (F.col("cum_neg") == F.col("all_neg"))
    if drop_intermediate:
        step = F.struct("pos", "neg")
        heads = cells.groupBy(*groups, BUCKET).agg(F.min_by(step, F.col(RANK)).alias("_head"))
        following = F.lead("_head").over(Window.partitionBy(*groups).orderBy(BUCKET))
        heads = heads.select(*groups, BUCKET, following.alias("_next_head"))
        inside = Window.partitionBy(*groups, BUCKET).orderBy(RANK)
        points = points.join(heads, [*groups, BUCKET]).withColumn(
            "_next", F.coalesce(F.lead(step).over(inside), F.col("_next_head"))
        )
        turn = (F.col("_next.pos") != F.col("pos")) | (F.col("_next.neg") != F.col("neg"))
        points = points.where(first | last | turn)
    here = F.struct(
        (-F.col(RANK)).alias("threshold"),
        ratio("cum_neg", "all_neg", None).alias("fpr"),
        ratio("cum_pos", "all_pos", None).alias("tpr"),
    )
    start = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    rows = F.when(first, F.array(start, here)).otherwise(F.array(here))
    return points.select(*groups, F.explode(rows).alias("p")).select(*groups, "p.*")


def pr_curve(df: DataFrame, label: str, score: str, groups: list[str] = ()) -> DataFrame:
    """Threshold, precision, recall, and the no-skill level; ends at recall 0, precision 1."""
    groups = list(groups)
    points = _along_scores(df, label, score, groups)
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    here = F.struct(
        (-F.col(RANK)).alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        ratio("cum_pos", "all_pos", 1.0).alias("recall"),
    )
    end = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    rows = F.when(first, F.array(end, here)).otherwise(F.array(here))
    level = (F.col("all_pos") / (F.col("all_pos") + F.col("all_neg"))).alias("no_skill")
    return points.select(*groups, level, F.explode(rows).alias("p")).select(*groups, "no_skill", "p.*")


def calibration_curve(df: DataFrame, label: str, score: str, groups: list[str] = (), bins: int = 10) -> DataFrame:
    """Mean score and positive share per equal-width bin; a score on an edge belongs to the lower bin."""
    passed = [(F.col(score) > i / bins).cast("int") for i in range(1, bins)]
    base = df.dropna(subset=[label, score, *groups])
    return (
        base.withColumn("bin", sum(passed, F.lit(0)))
        .groupBy(*groups, "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"), F.avg(label).alias("positive_share"))
    )


def mcnemar(df: DataFrame, label: str, pairs: dict[str, tuple[str, str]], p_values: bool = False) -> DataFrame:
    """Continuity-corrected test for every pair of prediction columns, from one pass.

    The statistic is NULL when the two models never disagree in correctness.
    """
    y = F.col(label)
    sums, rows = [], []
    for i, (name, (a, b)) in enumerate(pairs.items()):
        a_ok, b_ok = F.col(a) == y, F.col(b) == y
        sums += [
            F.coalesce(F.sum((~a_ok & b_ok).cast("bigint")), F.lit(0)).alias(f"b{i}"),
            F.coalesce(F.sum((a_ok & ~b_ok).cast("bigint")), F.lit(0)).alias(f"c{i}"),
        ]
        rows.append(F.struct(F.lit(name).alias("pair"), F.col(f"b{i}").alias("only_b_right"),
                             F.col(f"c{i}").alias("only_a_right")))
    off = F.abs(F.col("only_b_right") - F.col("only_a_right")) - 1
    out = (
        df.agg(*sums).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        .withColumn("statistic", ratio(off * off, F.col("only_b_right") + F.col("only_a_right"), None))
        .withColumn("significant", F.col("statistic") > CHI2_95)
    )
    return out.withColumn("p_value", chi2_1_tail("statistic")) if p_values else out


def best_rows(table: DataFrame, name: str, largest: list[str], smallest: list[str] = ()) -> DataFrame:
    """Best row and value for each metric column; equal values go to the first name."""
    found, rows = [], []
    for c in [*largest, *smallest]:
        rank = F.struct(-F.col(c) if c in largest else F.col(c), F.col(name))
        found.append(F.min_by(F.struct(F.col(name).alias("winner"), F.col(c).alias("value")), rank).alias(c))
        rows.append(F.struct(F.lit(c).alias("metric"), F.col(f"{c}.winner").alias("winner"),
                             F.col(f"{c}.value").alias("value")))
    return table.agg(*found).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def top_by_size(table: DataFrame, name: str, value: str, n: int = 20) -> DataFrame:
    """The n entries with the largest absolute value."""
    return table.orderBy(F.abs(F.col(value)).desc(), F.col(name)).limit(n)
