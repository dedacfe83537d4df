"""Column expressions: text, number, date and category clean-up. All run inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certiscope import vocab

# What Python's str.strip removes from latin-1 text; Spark's trim removes blanks only.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
NUMBER_PATTERN = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stripped(c: str | Column) -> Column:
    return F.btrim(col(c), F.lit(BLANKS))


def rating(c: str | Column) -> Column:
    """Rating letter: no blanks around it, upper case."""
    return F.upper(stripped(c))


def number(c: str | Column) -> Column:
    """Text as double; anything that is not a plain decimal number becomes NULL."""
    text = stripped(c)
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def nan_to_null(c: str | Column) -> Column:
    """NaN compares as larger than everything in Spark; as NULL it stays out of comparisons."""
    return F.when(~F.isnan(col(c)), col(c))


def iso_date(c: str | Column) -> Column:
    """Text as date; unreadable text becomes NULL."""
    return stripped(c).try_cast("date")


def identifier(c: str | Column) -> Column:
    """Text id without a decimal tail; the text 'nan' and empty text count as missing."""
    text = stripped(F.substring_index(col(c), ".", 1))
    return F.when(~text.isin("nan", ""), text)


def outward_code(c: str | Column) -> Column:
    """First part of a postcode."""
    return F.substring_index(col(c), " ", 1)


def wall_type(c: str | Column) -> Column:
    """Keyword class; a text that names both kinds counts as solid, a missing one as other."""
    text = F.lower(col(c))
    return F.when(text.contains("solid"), "solid").when(text.contains("cavity"), "cavity").otherwise("other")


def age_midpoint(c: str | Column) -> Column:
    """Midpoint year of a full band name, NULL for every other text."""
    return F.element_at(_literal_map(vocab.AGE_MIDPOINTS), col(c)).cast("double")


def age_band(c: str | Column) -> Column:
    """Band name of a band text or of a bare build year; NULL when it is neither."""
    name = stripped(F.replace(col(c), F.lit(vocab.AGE_PREFIX.strip()), F.lit("")))
    year = F.regexp_extract(name, r"^(\d{4})(\.0)?$", 1).try_cast("int")
    out = F.when(name.isin(vocab.AGE_BAND_ORDER), name)
    for band, low, high, _ in vocab.AGE_BANDS:
        out = out.when(year.between(low, high), band)
    return out


def ordinal(c: str | Column, order: list[str], unknown: int = -1) -> Column:
    """Position of the value in ``order``; values outside it get ``unknown``."""
    code = F.element_at(_literal_map({v: i for i, v in enumerate(order)}), col(c))
    return F.when(col(c).isNotNull(), F.coalesce(code, F.lit(unknown)))


def low_rated(c: str | Column) -> Column:
    return col(c).isin(vocab.LOW_RATINGS)


def any_negative(columns: list[str]) -> Column:
    """True when at least one of the columns is below zero; missing values do not count."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c) < 0, F.lit(False)) for c in columns], F.lit(False))


def any_missing(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns], F.lit(False))


def hash_rank(seed: int, *keys: str | Column) -> Column:
    """A repeatable 32-bit shuffle key for a row, from md5 so that other engines agree on it."""
    text = F.concat_ws("|", *[col(k).cast("string") for k in keys])
    digest = F.md5(F.concat(F.lit(f"{seed}:"), text))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def split_mean_sd(df: DataFrame, text: str, mean: str = "mean", sd: str = "sd") -> DataFrame:
    """Numbers of a 'mean +/- sd' text as two columns."""
    parts = F.split(F.col(text), r" \+/- ")
    return df.withColumns({mean: number(F.get(parts, F.lit(0))), sd: number(F.get(parts, F.lit(1)))})


def ratio(num: str | Column, den: str | Column, empty: float | None = 0.0) -> Column:
    """num / den as double, with ``empty`` where the denominator is zero."""
    return F.when(col(den) != 0, col(num) / col(den)).otherwise(F.lit(empty).cast("double"))


def _literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
