import pytest

import corpus_pipeline
from certiscope.llm.oracle import SQL
from certiscope.llm.queries import QUERIES
from compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None


def test_stages(spark, docs, empty):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, empty.select(*corpus_pipeline.COLUMNS), SF).collect()
    kept = corpus_pipeline.keep_known_language(spark, docs, SF).collect()
    assert {r["doc_id"] for r in kept} == {None, 3, 4, 5, 6, 7, 8, 9, 10} and all(r["lang"] for r in kept)
    single = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()}
    assert single == {None, 0, 1, 2, 3, 4, 7, 9, 10, 11}
    clean = {r["doc_id"]: r for r in corpus_pipeline.mask_personal_data(spark, docs, SF).collect()}
    assert clean[None]["text"] == "no id here, mail <EMAIL>" and clean[None]["n_chars"] == 24 and clean[1]["text"] is None


def test_run(spark):
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert pieces and all(0 < r["length"] <= 2048 for r in pieces)
