import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from certiscope.operators import models
from certiscope.operators.metrics import roc_auc


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = []
    for i in range(600):
        x, noise = rng.gauss(0, 1), rng.gauss(0, 1)
        data.append((str(i), x, noise, int(x + rng.gauss(0, .5) > .6)))
    df = spark.createDataFrame(data, "id string, x double, noise double, label int")
    return df.withColumn("features", array_to_vector(F.array("x", "noise"))).persist()


def auc(df):
    return roc_auc(df, "label", "s").first().roc_auc


@pytest.mark.parametrize("build", [
    lambda n: models.logistic(n, C=1.0), lambda n: models.forest(trees=10, depth=5),
    lambda n: models.boosting(max_depth=3, rounds=5),
])
def test_models_learn(rows, build):
    train = models.balanced(rows)
    assert auc(models.score(build(train.count()).fit(train), train, "s")) > .85


def test_calibrated_svm_gives_probabilities(rows):
    model = models.fit_calibrated_svm(rows.drop("x", "noise"), ["id"], folds=3, max_iter=20)
    out = model.transform(rows, "s")
    low, high = out.agg(F.min("s"), F.max("s")).first()
    assert 0 <= low < high <= 1 and auc(out) > .85
    rate, mean = out.agg(F.avg("label"), F.avg("s")).first()
    assert abs(rate - mean) < .1


def test_weights(rows):
    n = rows.count()
    assert models.balanced(rows).agg(F.sum("weight")).first()[0] == pytest.approx(n)
    sums = {r.label: r.w for r in models.boosted_weights(rows).groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert sums[0] == pytest.approx(sums[1])


def test_nested_search(rows):
    folds, chosen = models.nested_cv(
        rows.select("id", "label", "features"), lambda rows, C: models.logistic(rows, C, 20), {"C": [0.01, 1]}, ["id"], outer=2, inner=2
    )
    assert folds.count() == 2 and chosen["C"] in (0.01, 1)
    summary = models.fold_summary(folds).first()
    assert summary.roc_auc_mean > .8 and summary.roc_auc_sd >= 0


def test_most_chosen_first_wins_ties(spark):
    picks = spark.createDataFrame([(0, "b"), (1, "a"), (2, "a"), (3, "b")], "fold int, c string")
    assert tuple(models.most_chosen(picks, "fold", "c").first()) == ("b", 2)


def test_shuffled_features_is_a_permutation(rows):
    out = models.shuffled_features(rows.select("id", "features"), ["id"], 3, 4)
    values = out.select(models.vector_to_array("features")[0].alias("a"), models.vector_to_array("partner")[0].alias("b")).collect()
    assert sorted(r.a for r in values) == sorted(r.b for r in values)
    assert sum(r.a == r.b for r in values) < 5


def test_permutation_importance_finds_the_signal(rows):
    train = models.balanced(rows)
    model = models.logistic(train.count()).fit(train)
    got = {r.feature: r.importance for r in models.permutation_importance(model, rows.withColumn("weight", F.lit(1.0)), ["x", "noise"], ["id"], repeats=2).collect()}
    assert got["x"] > .2 > abs(got["noise"])
    built_in = models.importances(rows.sparkSession, model, ["x", "noise"])
    assert {r.feature for r in built_in.collect()} == {"x", "noise"}


def test_walk_forward_windows():
    assert models.walk_forward_years([2022, 2020, 2021, 2023]) == [([2020, 2021], 2022), ([2020, 2021, 2022], 2023)]


def test_permutation_importance_cuts_the_scores_once(rows, monkeypatch):
    """No repeat sketches the scores of all rows and features."""
    from certiscope.operators import metrics
    model = models.logistic(rows.count()).fit(models.balanced(rows))
    test = rows.withColumn("weight", F.lit(1.0))
    calls, plain = [], models.score_cuts

    def counted(*args):
        calls.append(args)
        return plain(*args)

    monkeypatch.setattr(models, "score_cuts", counted)
    monkeypatch.setattr(metrics, "score_cuts", counted)
    models.permutation_importance(model, test, ["x", "noise"], ["id"], repeats=2).collect()
    assert len(calls) == 1


def test_linear_importance_equals_scoring_every_mixed_row(rows, spark, monkeypatch):
    """Without mixed vectors: blocks of partners, score ranges, ties, a missing label; no row is exploded by feature."""
    rng = random.Random(2)
    data = [(None if i == 7 else f"k{i % 390}", *[float(rng.randint(0, 3)) for _ in range(5)], None if i == 11 else rng.randint(0, 1))
            for i in range(400)]
    df = spark.createDataFrame(data, "id string, a double, b double, c double, d double, e double, label int")
    df = df.select("id", "label", array_to_vector(F.array("a", "b", "c", "d", "e")).alias("features")).dropDuplicates(["id"])
    model = models.logistic(400).fit(models.balanced(df.dropna()))
    monkeypatch.setattr(models, "BLOCK_ROWS", 90)
    monkeypatch.setattr(models.exchange, "RANGE_ROWS", 60)
    monkeypatch.setattr(models.exchange, "HELD_VALUES", 300)
    monkeypatch.setattr(models.exchange, "CHUNK", 16)

    def found():
        return {r.feature: (r.importance, r.sd) for r in models.permutation_importance(model, df, list("abcde"), ["id"], repeats=3).collect()}

    with monkeypatch.context() as m:
        m.setattr(models, "_scored_exchange", None)
        got = found()
    monkeypatch.setattr(models.exchange, "linear_part", lambda _: None)
    plain = found()
    assert set(got) == set("abcde")
    for name, values in got.items():
        assert values == pytest.approx(plain[name], abs=1e-12)


def test_range_pairs_against_plain_counts():
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from certiscope.operators import exchange
    rng = np.random.default_rng(3)
    scores = np.concatenate([np.repeat(rng.random(6), 40), rng.random(160), [0.0, 1.0, np.nan]])
    labels = rng.integers(0, 2, len(scores))
    halves = [(scores[None, a::2].copy(), labels[a::2]) for a in (0, 1)]
    blocks = [b for h in halves for b in exchange._sorted_blocks([h], np.array([.3, .6]), 0)]
    table = pa.Table.from_batches(blocks)
    got = np.zeros(3)
    above = 0
    for bucket in (0, 1, 2):  # descending score
        part = exchange.range_pairs(table.filter(pc.equal(table[exchange.BUCKET], bucket))).to_pylist()[0]
        got += [part["pos"], part["neg"], part["pairs"] + above * part["neg"]]
        above += part["pos"]
    valid = ~np.isnan(scores)
    pos, neg = scores[valid & (labels == 1)], scores[valid & (labels == 0)]
    pairs = (pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2
    assert tuple(got) == (len(pos), len(neg), pairs)


def test_permutation_importance_query_shuffles_ten_times(rows, spark, monkeypatch):
    from types import SimpleNamespace
    from certiscope.plans import queries
    table = rows.select(F.col("id").alias("UPRN"), F.expr("if(id % 2 = 0, 'train', 'test')").alias("split"), "label", "features")
    monkeypatch.setattr(queries, "model_table", lambda *_: (table, SimpleNamespace(names=["x", "noise"])))
    seeds, limits, plain = [], [], models.shuffle_places
    monkeypatch.setattr(models, "shuffle_places", lambda df, keys, seed, blocks: seeds.append(seed) or plain(df, keys, seed, blocks))
    whole = models.permutation_importance
    monkeypatch.setattr(models, "permutation_importance", lambda model, *rest, **kw: limits.append(model.getMaxIter()) or whole(model, *rest, **kw))
    assert queries.permutation_importance(spark, "").count() == 2
    assert len(set(seeds)) == 10 and limits == [1000]


def test_exchanged_scores_hold_one_batch():
    """A block over several batches and several blocks in one: each row meets the next, the last one the first."""
    import numpy as np
    import pyarrow as pa
    from certiscope.operators import exchange
    sizes, cuts = [5, 1, 3], [0, 2, 4, 8, 9]
    rng = np.random.default_rng(4)
    terms, block = rng.normal(size=(9, 3)), np.repeat([7, 8, 9], sizes)
    batches = [pa.RecordBatch.from_arrays([
        pa.array(block[a:b]), pa.array([None if i == 3 else i % 2 for i in range(a, b)]),
        exchange._binary(terms[a:b].reshape(-1).copy(), np.arange(b - a + 1) * 3)], names=["_block", "_label", "_terms"])
        for a, b in zip(cuts[:-1], cuts[1:])]
    got = np.concatenate([s for s, _ in exchange.exchanged_scores(iter(batches), .5)], axis=1)
    partner = [1, 2, 3, 4, 0, 5, 7, 8, 6]
    for at, i in enumerate(i for i in range(9) if i != 3):
        for j in range(3):
            mixed = terms[i].copy()
            mixed[j] = terms[partner[i], j]
            assert got[j, at] == pytest.approx(1 / (1 + np.exp(-mixed.sum() - .5)))
