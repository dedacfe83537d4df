import pytest
from pyspark.sql import functions as F

from certiscope import vocab
from certiscope.functions import columns as C
from certiscope.operators import cleaning, dedup, features, joins


def first_row(df, column, value):
    """The frame with one value changed in the row of 2022."""
    return df.withColumn(column, F.when(F.col("LODGEMENT_DATE") == "2022-01-01", F.lit(value)).otherwise(F.col(column)))


def test_latest_certificate_is_kept(three):
    rows = {r.UPRN: r for r in dedup.latest_per_key(three).collect()}
    assert len(rows) == 2 and rows["A"].LODGEMENT_DATE == "2022-01-01"


def test_latest_needs_key_and_date(three):
    assert dedup.latest_per_key(three.drop("LODGEMENT_DATE")).count() == 3


def test_unreadable_date_ranks_last(spark):
    df = spark.createDataFrame([("A", "junk", 1), ("A", "2020-01-01", 2), ("B", None, 3)], "UPRN string, LODGEMENT_DATE string, x int")
    assert {r.UPRN: r.x for r in dedup.latest_per_key(df).collect()} == {"A": 2, "B": 3}


def test_file_year_beats_date(spark):
    df = spark.createDataFrame(
        [("A", "2024-12-31", 2024), ("A", "2020-01-01", 2025)], "UPRN string, LODGEMENT_DATE string, FILE_YEAR int"
    )
    assert dedup.latest_per_key(df, file_year="FILE_YEAR").first().FILE_YEAR == 2025


@pytest.mark.parametrize("column,value,left", [
    ("CURRENT_ENERGY_RATING", "Z", 2), ("CURRENT_ENERGY_EFFICIENCY", 0, 2), ("TOTAL_FLOOR_AREA", -90.0, 2),
    ("TOTAL_FLOOR_AREA", None, 3), ("TOTAL_FLOOR_AREA", float("nan"), 3), ("PROPERTY_TYPE", None, 2),
])
def test_valid_records(three, column, value, left):
    assert cleaning.valid_records(first_row(three, column, value)).count() == left


def test_age_band_has_no_gaps(three):
    out = features.add_age_year(first_row(three, "CONSTRUCTION_AGE_BAND", "NO DATA!"))
    assert sorted(r.AGE_BAND_YEAR for r in out.collect()) == [1971.0, 1988.0, 2005.0]


def test_wall_type(three, spark):
    out = {r.LODGEMENT_DATE: r.WALL_TYPE for r in cleaning.add_wall_type(three).collect()}
    assert out["2022-01-01"] == "cavity" and out["2020-06-01"] == "solid"
    assert cleaning.add_wall_type(three.drop("WALLS_DESCRIPTION")).first().WALL_TYPE == "unknown"
    texts = spark.createDataFrame([("SOLID brick and cavity",), (None,)], "w string").select(C.wall_type("w").alias("t"))
    assert [r.t for r in texts.collect()] == ["solid", "other"]


def test_label_and_gap(three):
    out = {r.LODGEMENT_DATE: r for r in cleaning.label_potential(three, 20).collect()}
    assert (out["2022-01-01"].RETROFIT_POTENTIAL, out["2022-01-01"].EFFICIENCY_GAP) == (1, 25)
    assert out["2021-03-15"].RETROFIT_POTENTIAL == 0


def test_simple_matrix(three):
    df = cleaning.label_potential(cleaning.add_wall_type(features.add_age_year(three)))
    matrix = features.simple_matrix(df)
    assert matrix.count() == 3
    assert features.missing_cells(matrix, matrix.columns).first().missing_cells == 0
    assert "PROPERTY_TYPE_House" in matrix.columns and "PROPERTY_TYPE_Flat" not in matrix.columns


def test_numbers_from_text(spark):
    texts = ["12", " 12.5 ", "1e2", "1d", "0x1F", "nan", "", None, "12m2", "-3", ".5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(C.number("t").alias("x"))
    assert [r.x for r in df.collect()] == [12.0, 12.5, 100.0, None, None, None, None, None, None, -3.0, 0.5]


def test_identifiers(spark):
    df = spark.createDataFrame([("123.0",), (" 45 ",), ("nan",), (None,)], "UPRN string")
    assert [r.UPRN for r in cleaning.normalised_ids(df).collect()] == ["123", "45"]
    big = spark.createDataFrame([(100012345678.0,), (float("nan"),)], "UPRN double")
    assert [r.UPRN for r in cleaning.normalised_ids(big).collect()] == ["100012345678"]


@pytest.mark.parametrize("text,band", [
    ("England and Wales: 1930-1949", "1930-1949"), ("1750", "before 1900"), ("2021.0", "2012 onwards"),
    ("1966", "1950-1966"), ("NO DATA!", None), ("19301", None), (None, None),
])
def test_age_band(spark, text, band):
    assert spark.createDataFrame([(text,)], "t string").select(C.age_band("t").alias("b")).first().b == band


def test_any_non_ascii_blank_is_stripped(spark):
    assert spark.createDataFrame([("\xa0d\t",)], "t string").select(C.rating("t").alias("r")).first().r == "D"


def test_leaking_features_are_refused():
    with pytest.raises(ValueError):
        cleaning.check_no_leak(["TOTAL_FLOOR_AREA", "EFFICIENCY_GAP"])
    assert not set(vocab.NUMERIC_INPUTS) & set(vocab.LEAKING_COLUMNS)


def test_enrich_keeps_rows_and_refuses_copies(spark):
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a", 1)], "k string, x int")
    assert sorted(map(tuple, joins.enrich(left, right, "k", ["x"]).collect())) == [("a", 1), ("b", None)]
    with pytest.raises(Exception, match="not unique"):
        joins.enrich(left, right.union(right), "k", ["x"]).collect()
