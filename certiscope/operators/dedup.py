"""One row per key.

``max_by`` over a struct keeps one candidate per key and map task before the shuffle, so a key that
holds a large part of all rows does not gather in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certiscope.functions.columns import iso_date
from certiscope.session import stored

#: Rows of the place table (1,024 rows of the input each) that are sent to every task, about 60 MB.
BROADCAST_PLACES = 400_000
PLACE_WORDS = 16


def best_per_key(df: DataFrame, key: str | list[str], order: list[str | Column]) -> DataFrame:
    """The row with the largest ``order`` tuple per key; NULLs in it rank lowest.

    Rows without a key count as one key, as a pandas ``drop_duplicates`` does. The column order of
    the input is kept.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def latest_per_key(df: DataFrame, key: str = "UPRN", date: str = "LODGEMENT_DATE",
                   file_year: str | None = None, ties: list[str] = ()) -> DataFrame:
    """Newest certificate per property: newest file first, then newest date, then the tie columns.

    A table without the key or the date column is returned as it is; case does not matter in names.
    """
    named = {c.lower(): c for c in df.columns}
    if key.lower() not in named or date.lower() not in named:
        return df
    key, date = named[key.lower()], named[date.lower()]
    first = [file_year] if file_year else []
    return best_per_key(df, key, [*first, iso_date(F.col(date).cast("string")), *ties])


def latest_per_key_late(df: DataFrame, key: str = "UPRN", date: str = "LODGEMENT_DATE",
                        file_year: str | None = None, ties: list[str] = ()) -> DataFrame:
    """:func:`latest_per_key` for a table read from parquet files, by late materialisation.

    Winners are chosen on narrow rows: the key, the order columns and each row's place (number of the file and
    row index). Only those go through the shuffle, one candidate per key and task. The winners' places are
    kept as one bit a row, ``PLACE_WORDS`` longs a row of the place table, and the wide rows look their bit up:
    the place table (stored, then counted) is broadcast when it has at most ``BROADCAST_PLACES`` rows, else both
    sides are dealt by place and the bits hashed, so wide rows are never sorted. Place is the last tie, so
    equal orders give the same row every time.
    """
    named = {c.lower(): c for c in df.columns}
    if key.lower() not in named or date.lower() not in named:
        return df
    key, date = named[key.lower()], named[date.lower()]
    first = [F.col(file_year)] if file_year else []
    located = _numbered_files(df.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}))
    order = F.struct(*first, iso_date(F.col(date).cast("string")), *[F.col(t) for t in ties], "_file", "_row")
    winners = located.select(key, order.alias("_order")).groupBy(key).agg(F.max("_order").alias("_order"))
    places = stored(_place_bits(winners.select(F.col("_order._file").alias("_file"), F.col("_order._row").alias("_row"))), "winners")
    how = "broadcast" if places.count() <= BROADCAST_PLACES else "shuffle_hash"
    words = F.array(*[F.col(f"_bits{k}") for k in range(PLACE_WORDS)])
    found = located.withColumn("_chunk", _chunk()).join(places.hint(how), ["_file", "_chunk"]).withColumn("_bits", words[_word()])
    return found.where("shiftrightunsigned(_bits, cast(_row % 64 as int)) & 1 = 1").select(*df.columns)


def _numbered_files(located: DataFrame) -> DataFrame:
    """``_file`` as the number of the path in path order, so that rows do not carry the path through a shuffle."""
    paths = sorted(r[0] for r in located.select("_file").distinct().collect())  # one row a file
    numbers = located.sparkSession.createDataFrame(list(enumerate(paths)), "_number int, _file string")
    rest = [c for c in located.columns if c != "_file"]
    return located.join(F.broadcast(numbers), "_file").select(*rest, F.col("_number").alias("_file"))


def _chunk() -> Column:
    return F.floor(F.col("_row") / (64 * PLACE_WORDS)).cast("long")


def _word() -> Column:
    return (F.shiftright(F.col("_row"), 6) % PLACE_WORDS).cast("int")


def _place_bits(places: DataFrame) -> DataFrame:
    """Per file and chunk of rows one bit a row, set for the rows in ``places``."""
    words = places.groupBy("_file", _chunk().alias("_chunk"), _word().alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_row % 64 as int))")).alias("_bits"))
    return words.groupBy("_file", "_chunk").agg(*[
        F.coalesce(F.max(F.when(F.col("_word") == k, F.col("_bits"))), F.lit(0).cast("long")).alias(f"_bits{k}")
        for k in range(PLACE_WORDS)])


def last_per_key(df: DataFrame, key: str, source_order: list[str]) -> DataFrame:
    """The last row per key in source order, which is given by columns and not by row position."""
    return best_per_key(df, key, list(source_order))


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Any one row per key, made repeatable: the smallest by ``order``."""
    rest = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*[c if c == key else F.col("_row")[c].alias(c) for c in df.columns])
