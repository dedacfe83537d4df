"""Sampling documents to target proportions by iterative proportional fitting, in DataFrame operations only.

Method
    Tokens are summed by cell (source, language, topic). Raking scales the cells so that their sums over each
    of the three dimensions meet that dimension's targets, one dimension after the other, until all hold. A
    cell's factor tells how strongly its documents are wanted. The factors are calibrated to probabilities whose
    expected tokens are the share ``KEEP`` of all: cells that would need more than all their documents are
    taken whole, the others keep the proportions that raking gave them. A document is drawn by a hash of its id, so a sample can be repeated and does not depend
    on the order of rows.

Scale
    One pass sums the tokens, with partial sums before the shuffle. Raking works on the cells alone, of which
    there are at most sources x languages x topics however many documents there are, and stores them every
    few rounds. The factors return to the documents by a join that Spark broadcasts when they are small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from certiscope.session import stored

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 40
STORE_ROUNDS = 4
TOLERANCE = 1e-12
TEMPER = 0.5
KEEP = 0.5
_WORD = r"[^\x20\x09-\x0D]+"
_HASH_RANGE = 16**12


def topic_of(text: Column) -> Column:
    """A coarse topic from the look of a text: notice, contact, data, passage or prose.

    A text with licence words is a notice, one with an address sign is contact, one in which every twentieth
    character or more is a digit is data, one of under 200 words is a passage; the rest is prose.
    """
    digits = F.length(F.regexp_replace(text, "[^0-9]", ""))
    return (
        F.when(text.rlike("(?i)licen[cs]e|copyright"), "notice").when(F.instr(text, "@") > 0, "contact")
        .when((F.length(text) > 0) & (20 * digits >= F.length(text)), "data")
        .when(F.regexp_count(text, F.lit(_WORD)) < 200, "passage").otherwise("prose")
    )


def tempered_targets(cells: DataFrame, temper: float = TEMPER) -> list[DataFrame]:
    """A target share for each level of each dimension: its share of the tokens to the power ``temper``."""
    out = []
    for d in DIMENSIONS:
        sums = stored(cells.groupBy(d).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temper)).alias("size")), f"sizes-{d}")
        whole = sums.agg(F.sum("size")).first()[0] or 1.0
        out.append(sums.select(d, (F.col("size") / F.lit(whole)).alias("target")))
    return out


def rake(cells: DataFrame, targets: list[DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (the dimensions and tokens) with ``weight``, whose sums by dimension have the target shares.

    Levels without a target get weight 0; targets of levels without tokens are spread over the others. When
    the targets contradict each other, the last dimension's hold after the last round.
    """
    for d, target in zip(DIMENSIONS, targets, strict=True):
        wanted = target.select(F.col(d).alias("level"), F.col("target").alias(f"target_{d}"))
        cells = cells.join(wanted, F.col(d).eqNullSafe(F.col("level")), "left").drop("level")
    cells = stored(cells.withColumn("weight", F.col("tokens").cast("double")), "cells")
    for _ in range(0, rounds, STORE_ROUNDS):
        start = F.col("weight").alias("start")
        cells = cells.select(*[c for c in cells.columns if c != "start"], start)
        for d in DIMENSIONS * STORE_ROUNDS:
            have = F.sum("weight").over(Window.partitionBy(d))
            cells = cells.withColumn("weight", F.when(have > 0, F.col("weight") * F.coalesce(f"target_{d}", F.lit(0.0)) / have).otherwise(0.0))
        cells = stored(cells, "raked")
        far = cells.agg(F.max(F.abs(F.col("weight") - F.col("start")) / F.greatest("weight", F.lit(1e-300)))).first()[0]
        if far is None or far <= tolerance:
            break
    return cells.select(*DIMENSIONS, "tokens", "weight")


def calibration(factors: DataFrame, keep: float) -> float:
    """What to multiply the factors with so that the share ``keep`` of all tokens is expected.

    No probability exceeds 1: cells that reach it are taken whole, and the others share what is left of the
    budget by their factors. Each step of the search is one row from the cells.
    """
    budget = (factors.agg(F.sum("tokens")).first()[0] or 0) * keep
    scale, whole = 0.0, -1
    while True:
        full = F.col("factor") * F.lit(scale) >= 1
        found = factors.agg(F.count(F.when(full, 1)).alias("n"), F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0)).alias("taken"),
                            F.coalesce(F.sum(F.when(~full, F.col("tokens") * F.col("factor"))), F.lit(0.0)).alias("open")).first()
        if found["n"] == whole or not found["open"]:
            return scale
        whole, scale = found["n"], (budget - found["taken"]) / found["open"]


def mix(docs: DataFrame, temper: float = TEMPER, keep: float = KEEP, seed: int = 17, doc_id: str = "doc_id", text: str = "text",
        source: str = "source", lang: str = "lang", rounds: int = ROUNDS) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability and sampled for every row of ``docs``.

    Tokens are words. A null source or language is a level of its own. A null, empty or blank text has no
    tokens, takes part in no proportion and is not sampled. Repeated rows share their fate, as the draw
    depends on the id and the text. Other columns are not read.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"))
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5("text"))), 1, 12), 16, 10)
    read = stored(docs.select("doc_id", "source", "lang", topic_of(F.col("text")).alias("topic"),
                              F.regexp_count("text", F.lit(_WORD)).cast("long").alias("tokens"), draw.cast("long").alias("draw")), "measured")
    cells = stored(read.where("tokens > 0").groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    raked = rake(cells, tempered_targets(cells, temper), rounds)
    factors = stored(raked.select(*[F.col(d).alias(f"of_{d}") for d in DIMENSIONS], "tokens", (F.col("weight") / F.col("tokens")).alias("factor")), "factors")
    scale = calibration(factors, keep)
    chances = factors.select(*[f"of_{d}" for d in DIMENSIONS], F.least(F.lit(1.0), F.col("factor") * F.lit(scale)).alias("chance"))
    same = reduce(lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"of_{d}")) for d in DIMENSIONS])
    chance = F.when(F.col("tokens") > 0, F.coalesce("chance", F.lit(0.0))).otherwise(0.0)
    return read.join(stored(chances, "chances"), same, "left").select(
        "doc_id", *DIMENSIONS, "tokens", F.round(chance, 9).alias("probability"),
        (F.col("draw") < F.round(chance, 9) * F.lit(float(_HASH_RANGE))).alias("sampled"))
