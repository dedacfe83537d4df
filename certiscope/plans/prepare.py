"""From raw certificates to the prepared, labelled and split register."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from certiscope import vocab
from certiscope.operators import cleaning, dedup, sampling
from certiscope.sources import fixture, register

FIRST_TEST_YEAR = 2025


def prepare(raw: DataFrame, first_test_year: int = FIRST_TEST_YEAR, file_year: str = "FILE_YEAR",
            ties: list[str] = (), keep: list[str] | None = None) -> DataFrame:
    """Clean, keep the newest certificate per property, label, split by file year.

    One shuffle: everything before the per-key step works row by row. ``keep`` narrows the rows that
    go through it to the columns that are wanted later.
    """
    clean = cleaning.clean_register(raw)
    if keep is not None:
        needed = dict.fromkeys([*vocab.REQUIRED_COLUMNS, file_year, *ties, *keep])
        clean = clean.select(*cleaning.present(clean, list(needed)))
    latest = dedup.latest_per_key(clean, file_year=file_year, ties=list(ties))
    return sampling.temporal_split(cleaning.label_potential(latest), file_year, first_test_year)


def prepare_files(spark: SparkSession, paths: list[str], out: str, ties: list[str] = ()) -> DataFrame:
    """Yearly CSV files to the prepared parquet table, and that table read back."""
    register.write_prepared(prepare(register.read_years(spark, paths), ties=ties), out)
    return register.read_prepared(spark, out)


# Columns that the cleaning step looks at.
_CHECKED = [
    *vocab.REQUIRED_COLUMNS, "FILE_YEAR", *fixture.TIES, "TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS",
    "CO2_EMISSIONS_CURRENT", "HEATING_COST_CURRENT",
]


def prepared_fixture(spark: SparkSession, sf_dir: str, keep: list[str] = ()) -> DataFrame:
    """The prepared register over the given tables, with the wanted extra columns."""
    columns = list(dict.fromkeys([*_CHECKED, *keep]))
    raw = fixture.certificates(spark, sf_dir, columns)
    return prepare(raw, fixture.FIRST_TEST_YEAR, ties=fixture.TIES, keep=list(keep))
