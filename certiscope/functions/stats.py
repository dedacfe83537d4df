"""Tail probabilities for the few result rows of a test. Spark SQL has no error function."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Fixed value: 95% point of the chi-square distribution with one degree of freedom.
CHI2_95 = 3.841458820694124


@F.pandas_udf(DoubleType())
def chi2_1_tail(x: pd.Series) -> pd.Series:
    """P(X > x) for chi-square with one degree of freedom."""
    return x.map(lambda v: None if v is None or math.isnan(v) else math.erfc(math.sqrt(v / 2)))


@F.pandas_udf(DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    """P(|Z| > |z|) for the standard normal."""
    return z.map(lambda v: None if v is None or math.isnan(v) else math.erfc(abs(v) / math.sqrt(2)))
