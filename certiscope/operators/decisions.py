"""What a scored table means for decisions: fixed budgets, groups, thresholds, cities, districts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certiscope import vocab
from certiscope.functions.columns import low_rated, outward_code, ratio
from certiscope.functions.stats import normal_two_sided
from certiscope.operators.metrics import class_scores, confusion
from certiscope.operators.ordering import BUCKET, attach_cuts, order_cuts, score_cuts, with_score_bucket
from certiscope.operators.sampling import half_split

LABEL = "RETROFIT_POTENTIAL"
MIN_GROUP = 300
MIN_POSITIVES = 30
MIN_DISTRICT = 20


def eligible(df: DataFrame) -> DataFrame:
    """Low-rated stock, the homes a survey would consider."""
    return df.where(low_rated("CURRENT_ENERGY_RATING"))


def top_budget(df: DataFrame, score: str, share: float, keys: list[str]) -> DataFrame:
    """The int(share * rows) best-scored rows; equal scores are taken in key order.

    The budget grows with the table, so it is not a ``limit``: the key of the last row inside the
    budget is found first, and the rows are filtered against it.
    """
    scored = df.dropna(subset=[score]).withColumn("_rank", -F.col(score))
    bucketed = with_score_bucket(scored, "_rank", score_cuts(scored, "_rank"))
    order = ["_rank", *keys]
    quota = {"_cut": F.floor(F.lit(share) * F.col("n"))}
    rows = attach_cuts(bucketed, order_cuts(bucketed, order, F.col(BUCKET), quota), ["_cut"])
    return rows.where(F.struct(*order) <= F.col("_cut")).drop("_rank", "_cut", BUCKET)


def _savings_row(strategy: str, surveyed: Column, hits: Column, cost: Column, co2: Column) -> list[Column]:
    return [
        F.lit(strategy).alias("strategy"),
        surveyed.cast("bigint").alias("surveyed"),
        hits.cast("bigint").alias("true_positives"),
        cost.cast("bigint").alias("annual_cost_saving"),
        F.round(co2, 1).alias("annual_co2_saving"),
    ]


def impact_ranked(df: DataFrame, score: str, keys: list[str], share: float = 0.10) -> DataFrame:
    """Hits and savings of surveying the best-scored share of the eligible stock."""
    return top_budget(eligible(df), score, share, keys).agg(
        *_savings_row("ranked", F.count(F.lit(1)), F.sum(LABEL), F.sum("COST_SAVING"), F.sum("CO2_SAVING"))
    )


def impact_random(df: DataFrame, share: float = 0.10) -> DataFrame:
    """Expected hits and savings of a random survey of the same size: the limit of repeated draws."""
    budget = F.floor(F.lit(share) * F.count(F.lit(1)))
    return eligible(df).agg(
        *_savings_row("rating band only", budget, budget * F.avg(LABEL), budget * F.avg("COST_SAVING"),
                      budget * F.avg("CO2_SAVING"))
    )


def impact_uplift(ranked: DataFrame, random: DataFrame) -> DataFrame:
    """Both strategies with the ratio of the cost they save."""
    both = ranked.unionByName(random)

    def cost(strategy: str) -> Column:
        return F.max(F.when(F.col("strategy") == strategy, F.col("annual_cost_saving")))

    rows = F.collect_list(F.struct(*ranked.columns))  # two rows
    return (
        both.agg(rows.alias("rows"), (cost("ranked") / F.greatest(cost("rating band only"), F.lit(1))).alias("uplift"))
        .select(F.explode("rows").alias("r"), "uplift")
        .select("r.*", "uplift")
    )


def group_fairness(df: DataFrame, label: str, pred: str, dimensions: dict[str, str],
                   min_rows: int = MIN_GROUP, min_positives: int = MIN_POSITIVES) -> DataFrame:
    """Recall, precision and positive rate for the values of each dimension; small groups left out.

    ``dimensions`` maps column -> name. All groupings come from one pass (GROUPING SETS).
    """
    dims = list(dimensions)
    flags = [F.col(label).alias("_label"), F.col(pred).alias("_pred")]
    base = df.select(*dims, *flags)

    def hits(l: int, p: int) -> Column:
        return F.sum(((F.col("_label") == l) & (F.col("_pred") == p)).cast("bigint"))

    counts = base.groupingSets([[d] for d in dims], *dims).agg(
        F.grouping_id().alias("_gid"), hits(1, 1).alias("tp"), hits(0, 1).alias("fp"),
        hits(1, 0).alias("fn"), hits(0, 0).alias("tn"),
    )
    every = (1 << len(dims)) - 1
    name, value = F.lit(None), F.lit(None)
    for i, d in enumerate(dims):
        here = F.col("_gid") == every - (1 << (len(dims) - 1 - i))
        name = F.when(here, dimensions[d]).otherwise(name)
        value = F.when(here, F.col(d)).otherwise(value)
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    pos = F.col("tp") + F.col("fn")
    scores = class_scores()
    return counts.select(
        name.cast("string").alias("dimension"), value.cast("string").alias("group"), n.alias("n"),
        pos.alias("positives"), ratio(pos, n).alias("positive_rate"),
        scores["recall"].alias("recall"), scores["precision"].alias("precision"),
    ).where(F.col("group").isNotNull() & (F.col("n") >= min_rows) & (F.col("positives") >= min_positives))


def recall_spread(groups: DataFrame) -> DataFrame:
    """Largest minus smallest group recall, each as reported to three places."""
    recall = F.round("recall", 3)
    return groups.agg(
        F.max(recall).alias("highest"), F.min(recall).alias("lowest"), (F.max(recall) - F.min(recall)).alias("spread")
    )


def threshold_sweep(df: DataFrame, label: str, score: str, hundredths: list[int], groups: list[str] = ()) -> DataFrame:
    """Recall, precision, f1 and flagged rows at every threshold.

    Rows are first counted by how many thresholds they reach; each of those few counts then adds to
    the thresholds it covers, so the table is read once however many thresholds there are.
    """
    groups = list(groups)
    steps = sorted(set(hundredths))
    base = df.dropna(subset=[label, score, *groups])
    reached = with_score_bucket(base, score, [h / 100 for h in steps])
    counts = reached.groupBy(*groups, BUCKET).agg(
        F.sum(F.col(label).cast("bigint")).alias("_pos"), F.count(F.lit(1)).alias("_n")
    )
    each = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(h).alias("h")) for i, h in enumerate(steps)]))
    covered = F.col(BUCKET) >= F.col("t.i")

    def total(what: str, keep: Column) -> Column:
        return F.sum(F.when(keep, F.col(what)).otherwise(0))

    spread = counts.select(*groups, BUCKET, "_pos", "_n", each.alias("t")).withColumn("_neg", F.col("_n") - F.col("_pos"))
    return (
        spread.groupBy(*groups, F.col("t.h").alias("hundredths"))
        .agg(total("_pos", covered).alias("tp"), total("_neg", covered).alias("fp"),
             total("_pos", ~covered).alias("fn"), total("_neg", ~covered).alias("tn"))
        .withColumns({k: v for k, v in class_scores().items() if k in ("recall", "precision", "f1")})
        .select(*groups, "hundredths", (F.col("hundredths") / 100).alias("threshold"), "recall", "precision", "f1",
                (F.col("tp") + F.col("fp")).alias("flagged"))
    )


def _tuned_threshold(part: DataFrame, label: str, score: str, tune: Column, hold: Column, target: float) -> DataFrame:
    """Highest grid threshold whose recall on the tuning rows reaches the target; scores on the held rows."""
    sweep = threshold_sweep(part.where(tune), label, score, list(vocab.TUNING_HUNDREDTHS))
    reached = sweep.where(F.col("recall") >= target).agg(F.max("hundredths")).first()[0]
    chosen = vocab.DEFAULT_HUNDREDTHS if reached is None else reached
    default = vocab.DEFAULT_HUNDREDTHS
    held = part.where(hold)
    both = F.array(*[
        F.struct(F.lit(name).alias("when"), F.lit(h / 100).alias("t")) for name, h in (("before", default), ("after", chosen))
    ])
    flagged = held.select(F.col(label).alias("_l"), F.col(score).alias("_s"), F.explode(both).alias("c")).select(
        "_l", F.col("c.when").alias("when"), (F.col("_s") >= F.col("c.t")).cast("int").alias("_p")
    )
    counts = confusion(flagged, "_l", "_p", ["when"]).withColumns(class_scores())

    def at(name: str, measure: str) -> Column:
        return F.max(F.when(F.col("when") == name, F.col(measure))).alias(f"{measure}_{name}")

    size = F.max(F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n_holdout")
    return counts.agg(
        F.lit(target).alias("reference_recall"), F.lit(chosen / 100).alias("chosen_threshold"),
        *[at(w, m) for m in ("recall", "precision", "f1") for w in ("before", "after")], size,
    )


def _reference_recall(df: DataFrame, group: str, reference: str, label: str, score: str) -> float:
    pred = (F.col(score) >= vocab.DEFAULT_HUNDREDTHS / 100).cast("int")
    return confusion(df.where(F.col(group) == reference), label, pred).select(class_scores()["recall"]).first()[0]


def group_threshold(df: DataFrame, group: str, focus: str, reference: str, label: str, score: str,
                    keys: list[str], seed: int = 42) -> DataFrame:
    """Threshold for one group that reaches another group's recall: chosen on one half, reported on the other."""
    target = _reference_recall(df, group, reference, label, score)
    part = half_split(df.where(F.col(group) == focus), keys, seed)
    return _tuned_threshold(part, label, score, F.col("half") == "tune", F.col("half") == "hold", target)


def group_threshold_by_year(df: DataFrame, group: str, focus: str, reference: str, label: str, score: str,
                            year: str, tune_year: int, hold_year: int, min_rows: int = MIN_GROUP) -> DataFrame:
    """As :func:`group_threshold`, chosen on one year and reported on the next; no row when either is too small."""
    part = df.where(F.col(group) == focus)
    sizes = {r[0]: r[1] for r in part.where(F.col(year).isin(tune_year, hold_year)).groupBy(year).count().collect()}
    target = _reference_recall(df, group, reference, label, score)
    out = _tuned_threshold(part, label, score, F.col(year) == tune_year, F.col(year) == hold_year, target)
    enough = min(sizes.get(tune_year, 0), sizes.get(hold_year, 0)) >= min_rows
    return out.withColumn("n_tune", F.lit(sizes.get(tune_year, 0)).cast("bigint")).where(F.lit(enough))


def proportion_z(x1: Column, n1: Column, x2: Column, n2: Column) -> Column:
    """Pooled two-proportion z statistic."""
    pooled = (x1 + x2) / (n1 + n2)
    return ratio(x1 / n1 - x2 / n2, F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n2)), None)


def city_table(scored: DataFrame, members: DataFrame, key: str, city: str, label: str, pred: str,
               p_values: bool = False) -> DataFrame:
    """Every city against the rest of the table, in one pass for any number of cities.

    ``members`` has one row per city and property. The rest is the total minus the city; cities
    without a property in the table give no row.
    """
    counted = scored.select(key, F.col(label).alias("_l"), F.col(pred).alias("_p"))
    whole = confusion(counted, "_l", "_p").first()
    cities = confusion(counted.join(members.select(key, city).distinct(), key), "_l", "_p", [city])
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n1, x1 = tp + fp + fn + tn, tp + fn
    n2, x2 = F.lit(sum(whole)) - n1, F.lit(whole.tp + whole.fn) - x1
    scores = class_scores()
    rate, rest = x1 / n1, ratio(x2, n2, None)
    out = cities.select(
        city, n1.alias("n"), rate.alias("positive_rate"), scores["accuracy"].alias("accuracy"),
        F.greatest(rate, 1 - rate).alias("majority_accuracy"),
        scores["precision"].alias("precision"), scores["recall"].alias("recall"), scores["f1"].alias("f1"),
        n2.alias("n_rest"), rest.alias("rest_positive_rate"), ((rate - rest) * 100).alias("rate_gap_points"),
        (scores["accuracy"] - F.greatest(rate, 1 - rate)).alias("accuracy_gain"),
        F.when(n2 > 0, proportion_z(x1, n1, x2, F.greatest(n2, F.lit(1)))).alias("z"),
    )
    return out.withColumn("p_value", normal_two_sided("z")) if p_values else out


def district_summary(df: DataFrame, postcode: str, centres: DataFrame, label: str, pred: str,
                     min_rows: int = MIN_DISTRICT) -> DataFrame:
    """Predicted and actual rate per postcode district with its centre; small and unknown districts left out."""
    rates = (
        df.groupBy(outward_code(postcode).alias("district"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(pred).alias("predicted_positive_rate"),
             F.avg(label).alias("actual_positive_rate"))
        .where(F.col("n") >= min_rows)
    )
    return rates.join(centres, "district").select(
        "district", "lat", "lon", "n", "predicted_positive_rate", "actual_positive_rate"
    )


def district_extremes(districts: DataFrame) -> DataFrame:
    """Districts with the lowest and the highest predicted rate; equal rates go to the first name."""
    rate = F.col("predicted_positive_rate")
    return districts.agg(
        F.min_by("district", F.struct(rate, F.col("district"))).alias("lowest_district"),
        F.min(rate).alias("lowest_rate"),
        F.min_by("district", F.struct(-rate, F.col("district"))).alias("highest_district"),
        F.max(rate).alias("highest_rate"),
    )


def metric_delta(table: DataFrame, name: str, base: str, best: str, metrics: list[str]) -> DataFrame:
    """Metric differences between two named rows of a result table."""
    def at(row: str, metric: str) -> Column:
        return F.max(F.when(F.col(name) == row, F.col(metric)))

    return table.agg(
        F.max(F.lit(base)).alias("base"), F.max(F.lit(best)).alias("best"),
        *[(at(best, m) - at(base, m)).alias(f"{m}_delta") for m in metrics],
    )


def walk_forward_summary(folds: DataFrame, year: str, auc: str, f1: str, early: list[int], late: list[int]) -> DataFrame:
    """Range of the yearly ROC-AUC, mean F1 of the early and of the late years."""
    return folds.agg(
        F.min(auc).alias("auc_min"), F.max(auc).alias("auc_max"),
        F.avg(F.when(F.col(year).isin(early), F.col(f1))).alias("f1_early"),
        F.avg(F.when(F.col(year).isin(late), F.col(f1))).alias("f1_late"),
    )
