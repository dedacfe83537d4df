"""Quality by robust multivariate outliers: the minimum covariance determinant of each language and source.

Method
    Of every document a vector of five transformed statistics is taken: log number of words, log mean word
    length, the log of one plus the percentage of symbols, and the shares of repeated lines and of repeated words. For
    each group (language and source) the estimate is the mean and covariance of the ``SHARE`` of its documents
    that lie closest together: from a start by medians and absolute deviations, concentration steps choose the
    closest documents under the present estimate and estimate anew. Covariances of the closest are scaled up to
    those of all by the factor that is right for normal data. A document is rejected when its squared Mahalanobis
    distance from its group exceeds ``CUTOFF``, the ``QUANTILE`` of chi-square with five degrees of freedom.

Scale
    Texts are read once; the rest works on a stored table of eight numbers a document. Steps are aggregates
    with partial results (sums of products, mergeable quantiles), so a source with a third of all documents is
    spread over all tasks; no group is gathered. Variances have a floor, as most documents of a clean source
    have no symbols or repetitions at all and an exact fit would reject every other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certiscope.llm import textops
from certiscope.session import stored

SHARE = 0.75
STEPS = 5
QUANTILE = 0.9999
MIN_GROUP = 50
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: the least spread of each statistic: one repeated line in a short text is nothing odd. A floor times the root of
#: CUTOFF (5.07) lies within the reach of its statistic, so that each of them can reject alone
FLOORS = (0.5, 0.1, 0.3, 0.1, 0.1)

_D = len(FLOORS)


def chi2_cdf(x: float, k: int) -> float:
    """The chi-square distribution function for an odd number of degrees of freedom."""
    out, term = math.erf(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    for j in range(1, k - 1, 2):
        out, term = out - term, term * x / (j + 2)
    return out


def chi2_quantile(share: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, k) < share else (low, middle)
    return low


def consistency(share: float) -> float:
    """What the covariance of the closest ``share`` of normal rows is multiplied with to be that of all."""
    return 1.0 if share >= 1 else share / chi2_cdf(chi2_quantile(share, _D), _D + 2)


CUTOFF = chi2_quantile(QUANTILE, _D)
_PAIRS = [(i, j) for i in range(_D) for j in range(i, _D)]
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_BLANKS = " \t\n\v\f\r"
_WINDOW = 3


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Words, code points in words, symbols, lines with a word, such lines equal to an earlier one, and words in
    three-word windows that the text has twice or more."""
    data, offsets = textops.utf8(texts)
    starts, ends, bounds = textops.words(data, offsets)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    inside = ~textops.SPACE[data]
    n_words = np.diff(bounds)
    hashes = textops.span_hashes(data, starts, ends)
    covered = np.zeros(len(hashes) + _WINDOW, dtype=bool)
    runs, at = textops.shingles(hashes, bounds, _WINDOW)
    owner = np.repeat(np.arange(len(n_words)), np.diff(at))
    own = np.where(n_words[owner] >= _WINDOW, runs + textops.mix(owner.astype(np.uint64) + np.uint64(1)), runs)
    order = np.argsort(own, kind="stable")
    ranked = own[order]
    same = (ranked[1:] == ranked[:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(own), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    place = (bounds[:-1][owner] + np.arange(len(own)) - at[:-1][owner])[twice]
    for k in range(_WINDOW):
        covered[place + k] = True
    words_before = np.concatenate([[0], np.cumsum(covered[:len(hashes)])])
    lines = [[line for line in (t or "").split("\n") if line.strip(_BLANKS)] for t in texts.to_pylist()]
    return {
        "n_words": n_words, "word_chars": per_text(inside & ((data & 0xC0) != 0x80)), "n_symbols": per_text(_SYMBOL[data]),
        "n_lines": np.array([len(x) for x in lines], dtype=np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], dtype=np.int64),
        "n_repeat_words": words_before[bounds[1:]] - words_before[bounds[:-1]],
    }


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in textops.slices(batch, "text"):
            counts = text_counts(part.column("text"))
            yield pa.record_batch({c: part.column(c) for c in ("doc_id", "lang", "source")} | {c: pa.array(counts[c], pa.int64()) for c in _COUNTS})


def statistics() -> list[Column]:
    """The transformed statistics x0 to x4 from the counts."""
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))

    return [c.alias(f"x{k}") for k, c in enumerate([
        F.log1p(F.col("n_words").cast("double")), F.log(F.greatest(F.coalesce(F.try_divide(F.col("word_chars").cast("double"), F.col("n_words")), F.lit(1.0)), F.lit(1.0))),
        F.log1p(100 * share("n_symbols", "word_chars")), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")])]


def _distance() -> Column:
    centred = [F.col(f"x{i}") - F.col("center")[i] for i in range(_D)]
    return sum(((1 if i == j else 2) * F.col("inverse")[i * _D + j] * centred[i] * centred[j] for i, j in _PAIRS), F.lit(0.0))


def _inverted(batches: Iterator[pa.RecordBatch], factor: float) -> Iterator[pa.RecordBatch]:
    """Means and inverse covariances, multiplied with ``factor``, from sums; variances below the floor are lifted to it."""
    for batch in batches:
        if not batch.num_rows:
            continue
        n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.float64)
        mean = np.stack([batch.column(f"s{i}").to_numpy(zero_copy_only=False) for i in range(_D)], axis=1) / n[:, None]
        cov = np.zeros((len(n), _D, _D))
        for i, j in _PAIRS:
            cov[:, i, j] = cov[:, j, i] = batch.column(f"p{i}{j}").to_numpy(zero_copy_only=False) / n - mean[:, i] * mean[:, j]
        cov *= factor
        lift = np.maximum(np.square(FLOORS) - cov[:, range(_D), range(_D)], 0) + 1e-9
        cov[:, range(_D), range(_D)] += lift
        inverse = np.linalg.inv(cov).reshape(len(n), -1)
        yield pa.record_batch({"group": batch.column("group"), "center": pa.array(mean.tolist(), pa.list_(pa.float64())),
                               "inverse": pa.array(inverse.tolist(), pa.list_(pa.float64()))})


def _estimate(rows: DataFrame, share: float) -> DataFrame:
    factor = consistency(share)
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(_D)] + [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in _PAIRS]
    return rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"), *sums).mapInArrow(
        lambda batches: _inverted(batches, factor), "group string, center array<double>, inverse array<double>")


def _closest(rows: DataFrame, share: float) -> DataFrame:
    """The share of each group's rows with the smallest ``d2``."""
    cuts = rows.groupBy("group").agg(F.percentile_approx("d2", share, 10000).alias("cut"))
    return rows.join(cuts.withColumnRenamed("group", "of"), F.col("group") == F.col("of")).where("d2 <= cut")


def estimates(rows: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """(group, center, inverse) by concentration steps; ``rows`` has group and x0 to x4."""
    medians = stored(rows.groupBy("group").agg(*[F.percentile_approx(f"x{i}", 0.5, 10000).alias(f"m{i}") for i in range(_D)]), "medians")
    centred = rows.join(medians.withColumnRenamed("group", "of"), F.col("group") == F.col("of"))
    mads = stored(centred.groupBy("group").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(_D)],
        *[F.greatest(F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, 10000) * 1.4826, F.lit(FLOORS[i])).alias(f"d{i}") for i in range(_D)]), "deviations")
    start = sum(((F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"d{i}")) ** 2 for i in range(_D))
    placed = rows.join(mads.withColumnRenamed("group", "of"), F.col("group") == F.col("of")).select("group", *[f"x{i}" for i in range(_D)], start.alias("d2"))
    for _ in range(steps):
        found = stored(_estimate(_closest(placed, share), share), "estimates")
        placed = _placed(rows, found)
    return found


def _placed(rows: DataFrame, found: DataFrame) -> DataFrame:
    joined = rows.join(found.withColumnRenamed("group", "of"), F.col("group") == F.col("of"), "left")
    return joined.withColumn("d2", _distance()).drop("of", "center", "inverse")


def judge(docs: DataFrame, cutoff: float = CUTOFF, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """doc_id, the counts, base_failed, distance and kept for every row of ``docs``.

    base_failed: fewer than ``MIN_WORDS`` words, or more than half of the words repeated. Groups of fewer than
    ``MIN_GROUP`` rows are joined, first those of one language, then those of all; a group that stays smaller
    has no estimate and its distance is null, which rejects nothing. A null language or source is a level of
    its own; a null text has no words. Repeated rows count each. Other columns are not read.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"))
    counted = stored(docs.mapInArrow(_measured, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in _COUNTS)), "measured")
    own = F.to_json(F.struct("lang", "source"))
    sizes = counted.groupBy(own.alias("own"), F.to_json(F.struct("lang")).alias("of_lang")).agg(F.count(F.lit(1)).alias("n"))
    small = sizes.where(f"n < {MIN_GROUP}").groupBy("of_lang").agg(F.sum("n").alias("rest"))
    groups = stored(sizes.join(small, "of_lang", "left").select("own", F.when(F.col("n") >= MIN_GROUP, F.col("own")).when(
        F.col("rest") >= MIN_GROUP, F.col("of_lang")).otherwise("{}").alias("group")), "groups")
    rows = stored(counted.withColumn("own", own).join(groups, "own").select(
        "doc_id", *_COUNTS, "group", *statistics()), "statistics")
    large = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where(f"n >= {MIN_GROUP}").select("group")
    fitted = rows.join(large, "group", "left_semi").select("group", *[f"x{i}" for i in range(_D)])
    out = _placed(rows, estimates(fitted))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.select("doc_id", *_COUNTS, failed.alias("base_failed"), F.col("d2").alias("distance"),
                      (~failed & ~F.coalesce(F.col("d2") > cutoff, F.lit(False))).alias("kept"))
