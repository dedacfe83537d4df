"""Every registered query against its SQL answer on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from certiscope.plans import queries as queries_module
from conftest import SF_DIR

# Fits on the whole table, covered by relation in test_models.
SLOW = {"nested_search", "calibrated_svm_fit", "walk_forward_fit", "permutation_importance", "boosting_fit", "built_in_importance", "city_scoring", "naive_fit"}
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_answer_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    out = QUERIES[name](spark, SF_DIR)
    assert differences(out, con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_impute_values_joins_once(spark, monkeypatch):
    """The passes of the quantiles and modes read stored rows, not the joins again."""
    plans, plain = [], queries_module.ordering.exact_quantiles

    def spied(df, *rest):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df, *rest)

    monkeypatch.setattr(queries_module.ordering, "exact_quantiles", spied)
    assert len(QUERIES["impute_values"](spark, SF_DIR).collect()) == 6
    assert len(plans) == 1 and "Join" not in plans[0]
