"""Reading and writing the register: yearly CSV files in, partitioned parquet and result CSV out."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from certiscope import vocab
from certiscope.operators.cleaning import missing_required, present, upper_names, warn_skipped
from certiscope.operators.joins import stack
from certiscope.operators.sampling import uniform_sample

YEAR_IN_PATH = r"certificates[-=](\d{4})"


def read_csv(spark: SparkSession, path: str | list[str], encoding: str = "ISO-8859-1",
             missing_values: bool = True, multi_line: bool = False) -> DataFrame:
    """All columns as text, names from the header. The texts that usually mean 'missing' become NULL.

    Spark splits the file itself, so there is no chunk size; columns that are not used are not parsed. Quoted
    values with line breaks need ``multi_line``, which reads each file in one task; without it they stop the
    query instead of passing as broken rows.
    """
    df = spark.read.options(**csv_options(encoding, multi_line)).option("enforceSchema", False).csv(path)
    return null_missing(df) if missing_values else df


def csv_options(encoding: str = "ISO-8859-1", multi_line: bool = False) -> dict[str, str | bool]:
    return {"header": True, "encoding": encoding, "quote": '"', "escape": '"', "multiLine": multi_line, "mode": "FAILFAST"}


def null_missing(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(~F.col(f"`{c}`").isin(vocab.CSV_MISSING), F.col(f"`{c}`")).alias(c) for c in df.columns])


def normalise_year(df: DataFrame) -> DataFrame:
    """Upper-case names, the wanted columns, and the file year from the path; for files and streams of files."""
    year = F.regexp_extract(F.col("_metadata.file_path"), YEAR_IN_PATH, 1).try_cast("int")
    named = [F.col(f"`{c}`").alias(c.upper()) for c in df.columns if c.upper() in vocab.WANTED_COLUMNS]
    found = df.select(*named, year.alias("FILE_YEAR"))
    return found.select(*present(found, vocab.WANTED_COLUMNS), "FILE_YEAR")


def read_sample(spark: SparkSession, path: str, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """A CSV file reduced to exactly n rows; whole when it is not larger."""
    return uniform_sample(read_csv(spark, path), n, keys, seed)


def read_year(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame | None:
    """One yearly file with upper-case names, reduced to the wanted columns, and its file year.

    A missing file and a file without a required column are reported and left out.
    """
    try:
        df = read_csv(spark, path, multi_line=multi_line)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"{path} not found, left out", stacklevel=2)
        return None
    lacking = missing_required(upper_names(df))
    if lacking:
        warn_skipped(path, lacking)
        return None
    return normalise_year(df)


def read_years(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All yearly files as one table; each file is read by its own header, so columns may differ."""
    tables = [t for t in (read_year(spark, p) for p in paths) if t is not None]
    if not tables:
        raise ValueError("none of the yearly files could be read")
    return stack(tables)


def required_columns_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Per source: rows, number of required columns it lacks, and whether it is used."""
    rows = []
    for name, df in tables.items():
        lacking = missing_required(upper_names(df))
        rows.append(
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("source"), "n_rows", F.lit(len(lacking)).cast("bigint").alias("missing_columns"),
                F.lit(not lacking).alias("used"),
            )
        )
    return stack(rows)


def write_prepared(df: DataFrame, path: str, split: str = "split", year: str = "FILE_YEAR") -> None:
    """Parquet by split and year, so that a date range reads only its own folders.

    Rows are gathered by folder before they are written, and Spark splits what is too large for one task.
    """
    df.hint("rebalance", split, year).write.partitionBy(split, year).parquet(path)


def read_prepared(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*present(df, columns)) if columns else df


def write_result(df: DataFrame, path: str) -> None:
    """A result table as CSV with a header, written by as many tasks as the table has partitions."""
    _csv_writer(df).csv(path)


def write_years(df: DataFrame, path: str, year: str, encoding: str = "ISO-8859-1") -> None:
    """One folder of CSV files per year."""
    _csv_writer(df, encoding).partitionBy(year).csv(path)


def _csv_writer(df: DataFrame, encoding: str = "UTF-8") -> DataFrameWriter:
    """Values are written as they are, with the blanks around them."""
    return (
        df.write.option("header", True).option("encoding", encoding).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    )
