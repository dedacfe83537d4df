"""Joins and key-set operations. None of them assumes that a side is small."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(left: DataFrame, right: DataFrame, key: str | list[str], columns: list[str]) -> DataFrame:
    """Left join that must not change the number of rows.

    The uniqueness of the right key is checked inside the plan: the right side is grouped on the join
    key (the exchange that the join needs anyway) and a key that occurs twice stops the query.
    """
    keys = [key] if isinstance(key, str) else list(key)
    unique = right.groupBy(*keys).agg(
        F.min(F.struct(*columns)).alias("_right"), F.count(F.lit(1)).alias("_copies")
    )
    message = F.concat(F.lit(f"{', '.join(keys)} is not unique on the right side: "), F.concat_ws(", ", *keys))
    checked = unique.select(
        *keys, F.when(F.col("_copies") > 1, F.raise_error(message)).otherwise(F.col("_right")).alias("_right")
    )
    joined = left.join(checked, keys, "left")
    return joined.select(*left.columns, *[F.col("_right")[c].alias(c) for c in columns])


def keep_known(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def keep_unknown(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_anti")


def flag_known(df: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """Both halves of the split in one pass: True for rows whose key is in ``keys``."""
    marks = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(marks, key, "left")
    return joined.withColumn(name, F.coalesce("_hit", F.lit(False))).drop("_hit")


def stack(tables: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns that a table lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def attach_scores(rows: DataFrame, scores: DataFrame, key: str | list[str]) -> DataFrame:
    """Join model scores by key; a row without a score and a key with two scores stop the query.

    Row position never ties two tables together.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = [c for c in scores.columns if c not in keys]
    found = enrich(rows, scores.withColumn("_scored", F.lit(True)), keys, [*columns, "_scored"])
    message = F.concat(F.lit("no score for "), F.concat_ws(", ", *keys))
    first = columns[0]
    checked = F.when(F.col("_scored").isNull(), F.raise_error(message)).otherwise(F.col(first))
    return found.withColumn(first, checked).drop("_scored")


def missing_in_dimension(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keys of ``df`` that the dimension lacks."""
    return df.select(key).distinct().join(dimension.select(key), key, "left_anti")
