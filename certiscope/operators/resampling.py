"""Bootstrap intervals of ROC-AUC and of the paired gap between two models.

No resampled table is ever built. Rows are merged to cells of equal scores and label; a replicate gives
every cell a Poisson(rows) weight, the large-sample form of drawing rows with replacement. The weight
comes from a hash of the cell and the replicate, so all models see the same draw although each has its
cells in its own score order. The cells of a model are shuffled once into ordered score ranges; a task
walks through a range batch by batch and keeps one running total per replicate, and only (range,
replicate) sums leave it.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from certiscope.functions.columns import hash_rank
from certiscope.operators.metrics import roc_auc
from certiscope.operators.ordering import BUCKET, cut_shares, with_score_bucket
from certiscope.session import shuffle_width

# The functions that run in tasks travel with the job; the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRIME = 2**31 - 1
BLOCK = 1024  # cells weighted at once, and
BLOCK_WEIGHTS = 1 << 18  # weights drawn at once; bound the memory of a task, and keep it in the processor's cache
COARSE_BITS = 19  # low bits of a draw that the first look-up leaves out
COARSE_RATES = 256  # up to this rate a look-up is kept
_COARSE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def replicate_constants(replicates: int, seed: int) -> list[tuple[int, int]]:
    """Multiplier and offset of every replicate's hash, fixed by the seed."""
    out = []
    for b in range(replicates):
        digest = hashlib.md5(f"{seed}:replicate:{b}".encode()).hexdigest()
        out.append((1 + int(digest[:8], 16) % (PRIME - 1), int(digest[8:16], 16) % PRIME))
    return out


def poisson_limits(rate: int) -> np.ndarray:
    """Upper limits, out of PRIME, of the values 0, 1, 2, ... of a Poisson variable, and the first value.

    The first entry is the smallest value considered; the tail left out has no weight at this resolution.
    """
    spread = 10 * math.sqrt(rate) + 20
    low, high = max(0, int(rate - spread)), int(rate + spread)
    k = np.arange(low, high + 1)
    logs = np.concatenate(([low * math.log(rate) - rate - math.lgamma(low + 1)], np.log(rate / k[1:])))
    return np.concatenate(([low], np.floor(np.cumsum(np.exp(np.cumsum(logs))) * PRIME)))


def _coarse_values(rate: int) -> tuple[np.ndarray, np.ndarray]:
    """The Poisson value of every stretch of draws, -1 where a limit cuts the stretch; and the limits."""
    if rate not in _COARSE:
        table = poisson_limits(rate)
        starts = np.arange((PRIME >> COARSE_BITS) + 1, dtype=np.int64) << COARSE_BITS
        first = np.searchsorted(table[1:], starts, side="right")
        last = np.searchsorted(table[1:], starts + (1 << COARSE_BITS) - 1, side="right")
        _COARSE[rate] = np.where(first == last, table[0] + first, -1.0), table
    return _COARSE[rate]


def _poisson(u: np.ndarray, rate: int) -> np.ndarray:
    if rate > COARSE_RATES:
        table = poisson_limits(rate)
        return table[0] + np.searchsorted(table[1:], u, side="right")
    coarse, table = _coarse_values(rate)
    weights = coarse[u >> COARSE_BITS]
    cut = np.flatnonzero(weights < 0)
    weights.reshape(-1)[cut] = table[0] + np.searchsorted(table[1:], u.reshape(-1)[cut], side="right")
    return weights


def _draws(hashes: np.ndarray, constants: np.ndarray) -> np.ndarray:
    """(hash * multiplier + offset) modulo PRIME of cells (rows) in replicates (columns)."""
    u = (hashes % PRIME)[:, None] * constants[:, 0]
    u += constants[:, 1]
    for _ in range(2):  # 2**31 leaves 1: the high bits are added to the low ones
        high = u >> 31
        u &= PRIME
        u += high
    u -= PRIME * (u >= PRIME)
    return u


def draw_weights(hashes: np.ndarray, counts: np.ndarray, constants: np.ndarray) -> np.ndarray:
    """Weights of cells (rows) in replicates (columns): whole numbers, kept as doubles."""
    u = _draws(hashes, constants)
    different = np.unique(counts)
    if len(different) == 1:
        return _poisson(u, int(different[0]))
    weights = np.empty(u.shape)
    for count in different:
        at = np.flatnonzero(counts == count)
        weights[at] = _poisson(u[at], int(count))
    return weights


def _range_sums(batches: Iterator[pd.DataFrame], constants: np.ndarray) -> Iterator[pd.DataFrame]:
    """Sums per (model, range, salt) and replicate from rows sorted by range and descending score.

    pairs counts negatives against the positives above them in the range, ties half. Rows of one score
    may continue in the next block, so the weights of a block's last score are kept.
    """
    b = len(constants)
    size = max(1, min(BLOCK, BLOCK_WEIGHTS // b))
    key, state = None, None

    def close():
        return pd.DataFrame({
            "model": key[0], BUCKET: key[1], "salt": key[2], "replicate": np.arange(b),
            "pos": state["pos"], "neg": state["neg"], "pairs": state["pairs"],
        })

    for batch in batches:
        for group, rows in batch.groupby(["model", BUCKET, "salt"], sort=False):
            if group != key:
                if key is not None:
                    yield close()
                key = group
                state = {n: np.zeros(b) for n in ("pos", "neg", "pairs", "tie_pos", "tie_neg")} | {"rank": None}
            ranks, labels, hashes, counts = (rows[c].to_numpy() for c in ("rank", "label", "h", "n"))
            for start in range(0, len(rows), size):
                at = slice(start, start + size)
                _add_block(state, ranks[at], labels[at] == 1, hashes[at], counts[at], constants)
    if key is not None:
        yield close()


def _add_block(state: dict, ranks: np.ndarray, is_pos: np.ndarray, hashes: np.ndarray, counts: np.ndarray,
               constants: np.ndarray) -> None:
    """Add the next rows of a range to its sums. All sums are whole or halves, so their order does not matter."""
    weights = draw_weights(hashes, counts, constants)
    pos, neg = weights[is_pos], weights[~is_pos]
    pos_ranks, neg_ranks = ranks[is_pos], ranks[~is_pos]
    upto = np.zeros((len(pos) + 1, weights.shape[1]))
    np.cumsum(pos, axis=0, out=upto[1:])
    neg_sum = neg.sum(axis=0)
    state["pairs"] += neg_sum * state["pos"]
    above, tied = (np.searchsorted(pos_ranks, neg_ranks, side=side) for side in ("left", "right"))
    if len(neg):
        state["pairs"] += np.einsum("ij,ij->j", upto[above], neg)
    ties = np.flatnonzero(above != tied)
    if len(ties):
        state["pairs"] += np.einsum("ij,ij->j", upto[tied[ties]] - upto[above[ties]], neg[ties]) / 2
    if state["rank"] == ranks[0]:  # the first score goes on: its pairs with the rows before are ties
        more_pos, more_neg = pos[pos_ranks == ranks[0]].sum(axis=0), neg[neg_ranks == ranks[0]].sum(axis=0)
        state["pairs"] += (more_pos * state["tie_neg"] - more_neg * state["tie_pos"]) / 2
    if state["rank"] != ranks[-1]:
        state.update(rank=ranks[-1], tie_pos=0.0, tie_neg=0.0)
    last_pos, last_neg = pos[pos_ranks == ranks[-1]].sum(axis=0), neg[neg_ranks == ranks[-1]].sum(axis=0)
    state.update(tie_pos=state["tie_pos"] + last_pos, tie_neg=state["tie_neg"] + last_neg)
    state["pos"] += upto[-1]
    state["neg"] += neg_sum


def bootstrap_replicates(df: DataFrame, label: str, scores: dict[str, str], replicates: int = 2000,
                         seed: int = 42) -> DataFrame:
    """ROC-AUC of every model in every replicate; replicates without positives or negatives give none."""
    names = list(scores)
    columns = [F.col(scores[m]).alias(f"s{i}") for i, m in enumerate(names)]
    base = df.select(F.col(label).cast("int").alias("label"), *columns).dropna()
    shares = [cut_shares(base.select((-F.col(f"s{i}")).alias("rank")), "rank") for i in range(len(names))]
    cells = base.groupBy("label", *[f"s{i}" for i in range(len(names))]).agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("h", hash_rank(seed, "label", *[f"s{i}" for i in range(len(names))]))
    ordered = []
    for i, m in enumerate(names):
        # A score that fills several ranges gets one of its own, spread over as many salts: inside a
        # single score the order does not matter.
        full = {c: times for c, times in shares[i].items() if times > 1}
        cuts = sorted({*shares[i], *[math.nextafter(c, math.inf) for c in full]})
        one = with_score_bucket(
            cells.select(F.lit(m).alias("model"), "label", "n", "h", (-F.col(f"s{i}")).alias("rank")), "rank", cuts
        )
        salt = F.lit(-1)
        if full:
            salts = F.create_map(*[F.lit(x) for pair in full.items() for x in pair])[F.col("rank")]
            salt = F.coalesce(F.pmod("h", salts).cast("int"), F.lit(-1))
        ordered.append(one.withColumn("salt", salt))
    rows = ordered[0]
    for other in ordered[1:]:
        rows = rows.unionByName(other)
    constants = np.array(replicate_constants(replicates, seed), dtype=np.int64)
    part = ["model", BUCKET, "salt"]
    sums = (
        # With a number of tasks given, Spark does not put these few bytes, which are much work, into one.
        rows.repartition(4 * shuffle_width(df.sparkSession), *part).sortWithinPartitions(*part, "rank")
        .select(*part, "rank", "label", "n", "h")
        .mapInPandas(lambda it: _range_sums(it, constants),
                     f"model string, {BUCKET} int, salt int, replicate int, pos double, neg double, pairs double")
    )
    ranges = sums.groupBy("model", "replicate", BUCKET).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
        # Salted ranges hold one score: all their pairs are ties.
        F.when(F.max("salt") >= 0, F.sum("pos") * F.sum("neg") / 2).otherwise(F.sum("pairs")).alias("pairs"),
    )
    above = Window.partitionBy("model", "replicate").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranges.withColumn("pairs", F.col("pairs") + F.col("neg") * F.coalesce(F.sum("pos").over(above), F.lit(0.0)))
        .groupBy("model", "replicate")
        .agg(F.sum("pos").alias("p"), F.sum("neg").alias("q"), F.sum("pairs").alias("pairs"))
        .where("p > 0 and q > 0")
        .select("model", "replicate", (F.col("pairs") / (F.col("p") * F.col("q"))).alias("roc_auc"))
    )


def intervals(replicates: DataFrame) -> DataFrame:
    """95% interval per model over its replicates (a few thousand values)."""
    return replicates.groupBy("model").agg(
        F.percentile("roc_auc", F.lit(0.025)).alias("ci_low"), F.percentile("roc_auc", F.lit(0.975)).alias("ci_high"),
        F.count(F.lit(1)).alias("n_resamples"),
    )


def bootstrap_auc(df: DataFrame, label: str, scores: dict[str, str], replicates: int = 2000, seed: int = 42) -> DataFrame:
    """Observed ROC-AUC and its interval for every model."""
    long = df.select(F.col(label).alias("label"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(c).alias("score")) for m, c in scores.items()
    ])).alias("s")).select("label", "s.*")
    observed = roc_auc(long, "label", "score", ["model"]).select("model", "roc_auc")
    return observed.join(intervals(bootstrap_replicates(df, label, scores, replicates, seed)), "model")


def paired_gap(replicates: DataFrame, top: str, second: str) -> DataFrame:
    """Mean gap, its interval, and the share of replicates in which the first model is ahead."""
    wide = replicates.groupBy("replicate").agg(
        (F.max(F.when(F.col("model") == top, F.col("roc_auc")))
         - F.max(F.when(F.col("model") == second, F.col("roc_auc")))).alias("gap")
    )
    return wide.agg(
        F.max(F.lit(top)).alias("top_model"), F.max(F.lit(second)).alias("second_model"), F.avg("gap").alias("gap"),
        F.percentile("gap", F.lit(0.025)).alias("gap_ci_low"), F.percentile("gap", F.lit(0.975)).alias("gap_ci_high"),
        F.avg((F.col("gap") > 0).cast("int")).alias("share_ahead"), F.count("gap").alias("n_resamples"),
    )
