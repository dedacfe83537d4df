"""The scaled paths against plain single-window or pandas answers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from certiscope.functions.columns import hash_rank
from certiscope.operators import decisions, ordering, sampling


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(7)
    rows = [(str(i), rng.choice([0.5, rng.random(), 0.25]), i % 3, int(rng.random() < 0.3)) for i in range(3000)]
    rows += [("null", None, 1, 0)]
    return spark.createDataFrame(rows, "id string, x double, g int, label int").repartition(5)


def test_exact_quantiles(numbers):
    values = np.array([r.x for r in numbers.collect() if r.x is not None])
    found = ordering.exact_quantiles(numbers, ["x", "g"], [0.0, 0.013, 0.5, 0.99, 1.0])["x"]
    assert found == pytest.approx([float(np.quantile(values, p)) for p in (0.0, 0.013, 0.5, 0.99, 1.0)], abs=1e-15)


def test_exact_quantile_of_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert ordering.exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}


def test_quantile_misses_are_widened(numbers, monkeypatch):
    """A bracket in the wrong place must not change the answer."""
    plain = ordering.exact_quantiles(numbers, ["x"], [0.4])
    monkeypatch.setattr(type(numbers), "approxQuantile", lambda self, cols, probs, err: [[2.0] * len(probs) for _ in cols])
    assert ordering.exact_quantiles(numbers, ["x"], [0.4]) == plain


@pytest.mark.parametrize("cuts", [[], [0.25], [0.1, 0.25, 0.5, 0.9]])
def test_running_totals(numbers, cuts):
    rows = ordering.with_score_bucket(numbers.dropna(), "x", cuts)
    cells = rows.groupBy("g", ordering.BUCKET, "x").agg(F.count(F.lit(1)).alias("c"))
    got = ordering.running_totals(cells, "x", ["c"], ["g"]).select("g", "x", "cum_c", "all_c")
    w = Window.partitionBy("g").orderBy("x")
    plain = cells.select("g", "x", F.sum("c").over(w).alias("cum_c"), F.sum("c").over(Window.partitionBy("g")).alias("all_c"))
    assert sorted(got.collect()) == sorted(plain.collect())


@pytest.mark.parametrize("quota", [0, 1, 700, 5000])
def test_take_first(numbers, quota):
    df = numbers.dropna().withColumn("h", hash_rank(1, "id"))
    got = ordering.take_first(df, ["h", "id"], ordering.hash_bucket("h"), F.lit(quota), ["g"])
    w = Window.partitionBy("g").orderBy("h", "id")
    plain = df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= quota)
    assert {r.id for r in got.collect()} == {r.id for r in plain.collect()}


def test_many_strata_use_a_join(numbers, monkeypatch):
    monkeypatch.setattr(ordering.settle_small, "__defaults__", (1,))
    df = numbers.dropna()
    got = sampling.equal_sample(df, 30, "g", 3, ["id"])
    assert {r.g: r["count"] for r in got.groupBy("g").count().collect()} == {0: 10, 1: 10, 2: 10}


def test_folds_are_balanced_and_repeatable(numbers):
    one = sampling.stratified_folds(numbers, 4, "label", ["id"])
    sizes = one.groupBy("label", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r.label == label]
        assert len(counts) == 4 and max(counts) - min(counts) <= 1
    two = sampling.stratified_folds(numbers.repartition(3), 4, "label", ["id"])
    assert {(r.id, r.fold) for r in one.collect()} == {(r.id, r.fold) for r in two.collect()}


def test_half_split(numbers):
    assert {r.half: r["count"] for r in sampling.half_split(numbers, ["id"]).groupBy("half").count().collect()} == {"tune": 1500, "hold": 1501}


def test_sample_larger_than_table(numbers):
    assert sampling.uniform_sample(numbers, 10**6, ["id"]).count() == numbers.count()
    assert sampling.stratified_sample_quota(numbers, 10**6, "label", ["id"]).count() == numbers.count()


def test_top_budget_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(str(i), 0.5) for i in range(10)], "id string, s double")
    assert sorted(r.id for r in decisions.top_budget(df, "s", 0.3, ["id"]).collect()) == ["0", "1", "2"]


def test_one_hot_bucket_is_one_score(spark):
    """A third of the rows share one score: it becomes one cell whatever the cuts."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 9000).alias("s"))
    shares = ordering.cut_shares(df, "s", 32)
    assert shares[0.5] >= 8 and len(shares) <= 32
