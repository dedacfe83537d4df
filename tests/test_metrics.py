import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from certiscope.operators import decisions, metrics, resampling

SIX = [(.9, 1), (.8, 0), (.7, 1), (.6, 0), (.55, 1), (.3, 0)]


@pytest.fixture(scope="module")
def six(spark):
    return spark.createDataFrame(SIX, "s double, y int")


def one(df):
    return df.first()


def test_auc_and_average_precision(six):
    assert one(metrics.roc_auc(six, "y", "s")).roc_auc == pytest.approx(2 / 3)
    assert one(metrics.average_precision(six, "y", "s")).average_precision == pytest.approx(.7555555555)
    both = one(metrics.score_summary(six, "y", "s"))
    assert both.roc_auc == pytest.approx(2 / 3) and both.average_precision == pytest.approx(.7555555555)


def test_ties_count_half_and_one_class_has_no_auc(spark):
    tied = spark.createDataFrame([(.5, 0), (.5, 1), (.5, 1)], "s double, y int")
    assert one(metrics.roc_auc(tied, "y", "s")).roc_auc == .5
    assert one(metrics.roc_auc(tied.where("y = 1"), "y", "s")).roc_auc is None
    assert one(metrics.score_summary(tied.where("y = 1"), "y", "s")).roc_auc is None


def test_always_positive_model(spark):
    df = spark.createDataFrame([(1.0, i % 2) for i in range(10)], "s double, y int")
    m = one(metrics.score_summary(df, "y", "s"))
    assert (m.recall, m.precision, m.roc_auc) == (1.0, .5, .5)
    assert m.f1_weighted == pytest.approx(1 / 3)


def test_confusion_matrix(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (1, 0), (0, 0)], "y int, p int")
    assert tuple(one(metrics.confusion(df, "y", "p"))) == (2, 0, 1, 1)


def test_empty_denominators_are_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 0)], "y int, p int")
    m = one(metrics.with_class_scores(metrics.confusion(df, "y", "p")))
    assert (m.precision, m.recall, m.f1, m.f1_macro) == (0.0, 0.0, 0.0, 0.0)


def plain_roc(rows):
    """Curve by its definition: all points, then those on a line with equal steps left out."""
    scores = sorted({s for s, _ in rows}, reverse=True)
    step = [(sum(y for s, y in rows if s == t), sum(1 - y for s, y in rows if s == t)) for t in scores]
    keep = [i for i in range(len(step)) if i in (0, len(step) - 1) or step[i + 1] != step[i]]
    tp, fp = np.cumsum([p for p, _ in step]), np.cumsum([n for _, n in step])
    return {(0.0, 0.0)} | {(round(fp[i] / fp[-1], 12), round(tp[i] / tp[-1], 12)) for i in keep}


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_roc_curve_across_ranges(spark, monkeypatch, buckets):
    rng = np.random.default_rng(3)
    rows = [(float(s), int(y)) for s, y in zip(rng.integers(0, 60, 400) / 60, rng.random(400) < .4)]
    df = spark.createDataFrame(rows, "s double, y int")
    cuts = [-i / buckets for i in range(buckets - 1, 0, -1)]
    monkeypatch.setattr(metrics, "score_cuts", lambda *a: cuts)
    got = {(round(r.fpr, 12), round(r.tpr, 12)) for r in metrics.roc_curve(df, "y", "s").collect()}
    assert got == plain_roc(rows)


def test_pr_curve_ends(six):
    points = metrics.pr_curve(six, "y", "s").collect()
    assert len(points) == 7 and [(p.precision, p.recall) for p in points if p.threshold is None] == [(1.0, 0.0)]


def test_calibration_edges(spark):
    df = spark.createDataFrame([(.3, 1), (.30000001, 0), (0.0, 0), (1.0, 1), (.7, 1)], "s double, y int")
    assert {r.bin: r.n for r in metrics.calibration_curve(df, "y", "s").collect()} == {2: 1, 3: 1, 0: 1, 9: 1, 6: 1}


def test_mcnemar(spark):
    df = spark.createDataFrame([(1, 0, 1)] * 10 + [(1, 1, 0)] * 2 + [(0, 0, 0)], "y int, a int, b int")
    r = one(metrics.mcnemar(df, "y", {"x": ("a", "b")}, p_values=True))
    assert (r.only_b_right, r.only_a_right) == (10, 2) and r.statistic == pytest.approx(49 / 12)
    assert r.p_value == pytest.approx(math.erfc(math.sqrt(49 / 24)))
    same = one(metrics.mcnemar(df, "y", {"x": ("a", "a")}, p_values=True))
    assert same.statistic is None and same.p_value is None


def test_top_by_size(spark):
    df = spark.createDataFrame([("feature_a", .5), ("feature_b", -.9), ("feature_c", .2)], "f string, v double")
    assert [r.f for r in metrics.top_by_size(df, "f", "v", 2).collect()] == ["feature_b", "feature_a"]


def test_threshold_sweep_at_the_edge(spark):
    df = spark.createDataFrame([(.5, 1), (.15, 1), (.1, 0), (.49, 0)], "s double, y int")
    got = {r.hundredths: (r.flagged, r.recall) for r in decisions.threshold_sweep(df, "y", "s", [50, 15, 60]).collect()}
    assert got == {50: (1, .5), 15: (3, 1.0), 60: (0, 0.0)}


def test_small_groups_are_left_out(spark):
    df = spark.createDataFrame([("big", "x", 1, 1)] * 40 + [("small", "x", 1, 0)] * 5 + [(None, "x", 1, 1)] * 40,
                               "t string, u string, y int, p int")
    got = decisions.group_fairness(df, "y", "p", {"t": "T", "u": "U"}, min_rows=30, min_positives=30).collect()
    assert {(r.dimension, r.group, r.n) for r in got} == {("T", "big", 40), ("U", "x", 85)}


def test_threshold_by_year_needs_enough_rows(spark):
    df = spark.createDataFrame([("Flat", 2000, .4, 1)], "t string, yr int, s double, y int")
    assert decisions.group_threshold_by_year(df, "t", "Flat", "House", "y", "s", "yr", 2000, 2001).collect() == []


def plain_auc(y, s, w):
    pos, neg = w * (y == 1), w * (y == 0)
    wins = (pos[:, None] * neg[None, :] * ((s[:, None] > s[None, :]) + .5 * (s[:, None] == s[None, :]))).sum()
    return wins / (pos.sum() * neg.sum())


def test_bootstrap_against_plain_weights(spark, monkeypatch):
    """A third of the rows share one score; blocks and salts must not change a replicate."""
    monkeypatch.setattr(resampling, "BLOCK", 7)
    rng = np.random.default_rng(5)
    n = 600
    a = np.where(rng.random(n) < .34, .5, rng.integers(0, 200, n) / 200)
    b = rng.integers(0, 40, n) / 40
    y = (rng.random(n) < .3 + .4 * a).astype(int)
    df = spark.createDataFrame([(int(l), float(p), float(q)) for l, p, q in zip(y, a, b)], "y int, a double, b double")
    got = {(r.model, r.replicate): r.roc_auc for r in resampling.bootstrap_replicates(df, "y", {"A": "a", "B": "b"}, 6).collect()}
    cells = df.groupBy("y", "a", "b").count().withColumn("h", resampling.hash_rank(42, "y", "a", "b")).toPandas()
    constants = np.array(resampling.replicate_constants(6, 42), dtype=np.int64)
    w = resampling.draw_weights(cells["h"].to_numpy(), cells["count"].to_numpy(), constants)
    for i, (model, column) in enumerate((("A", "a"), ("B", "b"))):
        for r in range(6):
            assert got[(model, r)] == pytest.approx(plain_auc(cells["y"].to_numpy(), cells[column].to_numpy(), w[:, r]), abs=1e-12)


@pytest.mark.parametrize("rate", [1, 3, 400])
def test_poisson_weights(rate):
    constants = np.array(resampling.replicate_constants(200, 1), dtype=np.int64)
    hashes = np.array([hash((i, "x")) % 2**32 for i in range(500)], dtype=np.int64)
    w = resampling.draw_weights(hashes, np.full(500, rate), constants)
    assert w.mean() == pytest.approx(rate, rel=.02) and w.var() == pytest.approx(rate, rel=.1)


def test_two_proportions(spark):
    z = decisions.proportion_z(F.lit(30), F.lit(100), F.lit(45), F.lit(100))
    expected = (.3 - .45) / math.sqrt(.375 * .625 * .02)
    assert spark.range(1).select(z.alias("z")).first().z == pytest.approx(expected)


def test_bootstrap_query_draws_two_thousand_replicates(spark, monkeypatch):
    from certiscope.plans import queries
    from certiscope.plans.oracle import SQL
    rows = [(int(i % 3 == 0), (i * 7 % 50) / 50, (i * 11 % 40) / 40) for i in range(200)]
    df = spark.createDataFrame(rows, f"{queries.LABEL} int, SCORE_A double, SCORE_B double")
    monkeypatch.setattr(queries, "_two_scores", lambda *_: df)
    assert {r.model: r.n_resamples for r in queries.bootstrap_auc(spark, "").collect()} == {"A": 2000, "B": 2000}
    assert "(1999, " in SQL["bootstrap_auc"] and "(1999, " not in SQL["bootstrap_gap"]


@pytest.mark.parametrize("size", [1, 3, 64])
def test_range_sums_do_not_depend_on_the_blocks(monkeypatch, size):
    """Ties over block edges, many rows of a score, large and small counts, draws at the edge of the prime."""
    import pandas as pd
    rng = np.random.default_rng(6)
    n, constants = 120, np.array([(2**31 - 2, 2**31 - 2), *resampling.replicate_constants(4, 42)], dtype=np.int64)
    hashes = np.concatenate(([0, 1, 2**31 - 2, 2**31 - 1, 2**31, 2**32 - 1], rng.integers(0, 2**32, n - 6)))
    u = (hashes[:, None] % resampling.PRIME * constants[None, :, 0] + constants[None, :, 1]) % resampling.PRIME
    counts = rng.choice([1, 2, 256, 257], n)
    labels, ranks = rng.integers(0, 2, n), np.sort(rng.integers(0, 9, n) / 4)
    limits = [resampling.poisson_limits(int(c)) for c in counts]
    w = np.array([t[0] + np.searchsorted(t[1:], row, side="right") for t, row in zip(limits, u)])
    assert (resampling.draw_weights(hashes, counts, constants) == w).all()
    monkeypatch.setattr(resampling, "BLOCK_WEIGHTS", size * len(constants))
    rows = pd.DataFrame({"model": "A", resampling.BUCKET: 0, "salt": -1, "rank": ranks, "label": labels, "n": counts, "h": hashes})
    got = pd.concat(resampling._range_sums(iter([rows[:50], rows[50:]]), constants))
    for r in range(len(constants)):
        pos, neg = w[:, r] * labels, w[:, r] * (1 - labels)
        pairs = (pos[:, None] * neg * ((ranks[:, None] < ranks) + .5 * (ranks[:, None] == ranks))).sum()
        assert tuple(got.iloc[r][["pos", "neg", "pairs"]]) == (pos.sum(), neg.sum(), pairs)
