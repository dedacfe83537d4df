"""Row filters and standardisation of the raw register."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from certiscope import vocab
from certiscope.functions import columns as C


def present(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted columns that the table has, in the wanted order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def missing_required(df: DataFrame, required: list[str] | None = None) -> list[str]:
    have = set(df.columns)
    return [c for c in required or vocab.REQUIRED_COLUMNS if c not in have]


def standardise_text(df: DataFrame) -> DataFrame:
    """Ratings trimmed and in upper case, property type trimmed."""
    return df.withColumns(
        {
            "CURRENT_ENERGY_RATING": C.rating("CURRENT_ENERGY_RATING"),
            "POTENTIAL_ENERGY_RATING": C.rating("POTENTIAL_ENERGY_RATING"),
            "PROPERTY_TYPE": C.stripped("PROPERTY_TYPE"),
        }
    )


def valid_domains(df: DataFrame) -> DataFrame:
    """Known ratings and property types only; a missing value is not known."""
    return df.where(
        F.col("CURRENT_ENERGY_RATING").isin(vocab.RATINGS_BEST_FIRST)
        & F.col("POTENTIAL_ENERGY_RATING").isin(vocab.RATINGS_BEST_FIRST)
        & F.col("PROPERTY_TYPE").isin(vocab.PROPERTY_TYPES)
    )


def numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns as doubles with junk and NaN as NULL."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for c in present(df, columns):
        if isinstance(kinds[c], T.StringType):
            changed[c] = C.number(c)
        elif isinstance(kinds[c], (T.DoubleType, T.FloatType)):
            changed[c] = C.nan_to_null(c).cast("double")
        else:
            changed[c] = F.col(c).cast("double")
    return df.withColumns(changed) if changed else df


def valid_scores(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Both efficiency scores inside the valid range."""
    low, high = vocab.SCORE_RANGE
    for c in present(df, columns or ["CURRENT_ENERGY_EFFICIENCY", "POTENTIAL_ENERGY_EFFICIENCY"]):
        df = df.where(F.col(c).between(low, high))
    return df


def non_negative(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with any negative physical quantity; missing quantities stay."""
    found = present(df, columns or vocab.NON_NEGATIVE_COLUMNS)
    return df.where(~C.any_negative(found)) if found else df


def valid_records(df: DataFrame) -> DataFrame:
    """Domain, range and sign checks on an already typed table."""
    return non_negative(valid_scores(valid_domains(df)))


def normalised_ids(df: DataFrame, key: str = "UPRN") -> DataFrame:
    """Id as text without a decimal tail; rows without an id are dropped."""
    kind = df.schema[key].dataType
    raw = F.col(key)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        raw = C.nan_to_null(key).cast("decimal(38,0)")
    return df.withColumn(key, C.identifier(raw.cast("string"))).where(F.col(key).isNotNull())


def label_potential(df: DataFrame, gap_threshold: int = vocab.GAP_THRESHOLD) -> DataFrame:
    """Efficiency gap, and 1 for a low-rated property whose gap reaches the threshold."""
    gap = F.col("POTENTIAL_ENERGY_EFFICIENCY") - F.col("CURRENT_ENERGY_EFFICIENCY")
    hit = C.low_rated("CURRENT_ENERGY_RATING") & (gap >= gap_threshold)
    return df.withColumns(
        {"EFFICIENCY_GAP": gap, "RETROFIT_POTENTIAL": F.when(hit, 1).otherwise(0)}
    )


def add_wall_type(df: DataFrame) -> DataFrame:
    """Wall class from the description; 'unknown' for tables without a description."""
    if "WALLS_DESCRIPTION" not in df.columns:
        return df.withColumn("WALL_TYPE", F.lit("unknown"))
    return df.withColumn("WALL_TYPE", C.wall_type("WALLS_DESCRIPTION"))


def in_year(df: DataFrame, year: int, date: str = "LODGEMENT_DATE") -> DataFrame:
    """Half-open date range on the stored column, so that it reaches the parquet scan."""
    return df.where((F.col(date) >= f"{year}-01-01") & (F.col(date) < f"{year + 1}-01-01"))


def savings(df: DataFrame) -> DataFrame:
    """Cost and CO2 saved per property; rows where either is negative or missing are dropped."""
    return df.withColumns(
        {
            "COST_SAVING": F.col("HEATING_COST_CURRENT") - F.col("HEATING_COST_POTENTIAL"),
            "CO2_SAVING": F.col("CO2_EMISSIONS_CURRENT") - F.col("CO2_EMISSIONS_POTENTIAL"),
        }
    ).where((F.col("COST_SAVING") >= 0) & (F.col("CO2_SAVING") >= 0))


def clean_register(df: DataFrame) -> DataFrame:
    """All row-wise steps of the preparation, in order; one narrow stage without a shuffle."""
    df = df.dropna(subset=["UPRN", "LODGEMENT_DATE"])
    df = valid_domains(standardise_text(df))
    df = valid_scores(numbers(df, vocab.NUMBER_COLUMNS))
    df = normalised_ids(non_negative(df, vocab.NON_NEGATIVE_RAW))
    return df.where(C.iso_date(F.col("LODGEMENT_DATE").cast("string")).isNotNull())


def check_no_leak(features: list[str]) -> list[str]:
    """Refuse features that define the label."""
    leaked = sorted({f for f in features if any(f == c or f.startswith(c + "_") for c in vocab.LEAKING_COLUMNS)})
    if leaked:
        raise ValueError(f"label-defining columns among the features: {leaked}")
    return features


def warn_skipped(source: str, missing: list[str]) -> None:
    warnings.warn(f"{source} left out, missing columns: {missing}", stacklevel=2)
