"""Inputs that differ from the tidy case: NaN, line breaks in values, lower-case headers, missing scores."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from certiscope import vocab
from certiscope.operators import joins
from certiscope.operators.dedup import latest_per_key
from certiscope.operators.ordering import exact_quantiles
from certiscope.sources import register
from certiscope.streaming import incremental


def test_quantiles_take_nan_as_missing(spark):
    df = spark.createDataFrame([(float(k),) for k in range(10)] + [(float("nan"),)] * 12 + [(None,)], "v double")
    assert exact_quantiles(df, ["v"], [0.5]) == {"v": [4.5]}


def test_line_breaks_in_values(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,text\n1,"x\ny"\n2,z\n')
    rows = register.read_csv(spark, str(path), multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("1", "x\ny"), ("2", "z")]
    with pytest.raises((PySparkException, Py4JJavaError)):
        register.read_csv(spark, str(path)).collect()


def test_stream_of_yearly_csv_files(spark, tmp_path):
    names = [c.lower() for c in vocab.REQUIRED_COLUMNS]
    value = {"uprn": "U{}", "lodgement_date": "2021-0{}-01", "current_energy_rating": "D", "potential_energy_rating": "B",
             "current_energy_efficiency": "55", "potential_energy_efficiency": "80", "property_type": "House"}
    for year in (2021, 2022):
        folder = tmp_path / "raw" / f"certificates-{year}"
        folder.mkdir(parents=True)
        lines = [",".join([*names, "unused"])] + [",".join([*(value.get(c, "NA").format(k) for c in names), "x"]) for k in range(1, 5)]
        (folder / "part.csv").write_text("\n".join(lines) + "\n")
    paths = [str(tmp_path / "raw" / f"certificates-{y}") for y in (2021, 2022)]
    whole = latest_per_key(incremental.clean_register(register.read_years(spark, paths)), file_year="FILE_YEAR")
    schema = register.read_csv(spark, paths[0]).schema
    stream = incremental.watch_files(spark, str(tmp_path / "raw" / "*"), schema, file_format="csv")
    out = str(tmp_path / "out")
    incremental.start_load(stream, out, str(tmp_path / "progress"), "FILE_YEAR").awaitTermination()
    got = incremental.current(spark, out, "FILE_YEAR")
    assert sorted(map(tuple, got.select(*whole.columns).collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert {r["FILE_YEAR"] for r in got.collect()} == {2022}


def test_scores_must_be_complete_and_unique(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    scores = spark.createDataFrame([(1, .5), (2, .6)], "id int, s double")
    assert joins.attach_scores(rows, scores, "id").count() == 2
    for wrong in (scores.where("id = 1"), scores.union(scores)):
        with pytest.raises(PySparkException):
            joins.attach_scores(rows, wrong, "id").collect()


def test_latest_per_key_ignores_case_of_names(spark):
    df = spark.createDataFrame([("a", "2021-01-01"), ("a", "2022-01-01")], "uprn string, lodgement_date string")
    assert [r[1] for r in latest_per_key(df).collect()] == ["2022-01-01"]
