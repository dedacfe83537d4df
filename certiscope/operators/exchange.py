"""Scores of a linear model with one feature taken from another row, and the exact pair counts of many such scores.

A linear score is a sum of one term a feature, so a row travels as its terms and the scores of all its
exchanges come from the terms of two rows; no mixed vector is built. The scores leave a task sorted, as one
block of bytes per feature and score range, and a range is merged by one task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegressionModel

from certiscope.operators.ordering import BUCKET

# The functions that run in tasks travel with the job; the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HELD_VALUES = 1 << 22  # scores a task holds before it sorts and hands them on
RANGE_ROWS = 1 << 18  # rows of a score range, which one task merges
CHUNK = 4096  # rows scored at once; they stay in the processor's cache
BLOCKS = f"_j int, {BUCKET} int, keys binary, counts binary"
SUMS = f"_j int, {BUCKET} int, pos bigint, neg bigint, pairs double"


def linear_part(model: Model) -> tuple[np.ndarray, float] | None:
    """Coefficients and intercept of a two-class logistic model; None for any other model."""
    if isinstance(model, LogisticRegressionModel) and model.coefficientMatrix.numRows == 1:
        return model.coefficients.toArray(), float(model.intercept)
    return None


def probability(margins: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1.0 - 1.0 / (1.0 + np.exp(margins))


def _next_level(level: np.ndarray) -> np.ndarray:
    if len(level) % 2:
        level = np.concatenate((level, np.zeros((1, level.shape[1]))))
    return level[::2] + level[1::2]


def own_margins(own: np.ndarray, intercept: float) -> np.ndarray:
    """Sum of the terms (rows of the matrix), added up pairwise along a fixed tree."""
    while len(own) > 1:
        own = _next_level(own)
    return own + intercept


def exchanged_margins(own: np.ndarray, other: np.ndarray, intercept: float) -> np.ndarray:
    """Margins with the j-th term taken from ``other``, as row j.

    The tree of :func:`own_margins` gives equal rows equal margins whichever term was exchanged, so ties
    stay ties; an exchange renews only the sums above its term.
    """
    margins, level, depth = other.copy(), own, 0
    while len(level) > 1:
        for j, margin in enumerate(margins):
            beside = (j >> depth) ^ 1
            if beside < len(level):  # the last one of an odd level stands alone
                margin += level[beside]
        level, depth = _next_level(level), depth + 1
    margins += intercept
    return margins


def _bytes(column: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows one after the other, and how many each row has."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].view(dtype) if data else np.empty(0, dtype)
    return values, np.diff(offsets) // np.dtype(dtype).itemsize


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column of the pieces of ``values`` between the given ends."""
    offsets = (ends * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _terms(batch: pa.RecordBatch) -> np.ndarray:
    values, _ = _bytes(batch.column("_terms").cast(pa.binary()), np.float64)
    return values.reshape(batch.num_rows, -1)


def pack_terms(batches: Iterator[pa.RecordBatch], coefficients: np.ndarray, intercept: float) -> Iterator[pa.RecordBatch]:
    """The last column, a list of features, as the bytes of the row's terms; the row's own score behind it."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        terms = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) * coefficients
        score = probability(own_margins(np.ascontiguousarray(terms.T), intercept))[0]
        packed = _binary(terms.reshape(-1), np.arange(n + 1) * len(coefficients))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], packed, pa.array(score)], names=[*batch.schema.names[:-1], "_terms", "_s"])


def score_keys(scores: np.ndarray, labels: np.ndarray | int) -> np.ndarray:
    """Whole numbers in the order of the scores (0 to 1), the label in the last bit."""
    return (scores.view(np.int64) << 1) | labels


def own_scores(batches: Iterator[pa.RecordBatch], intercept: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Scores of the rows as they are, as a matrix of one row, and their labels."""
    for batch in batches:
        if batch.num_rows:
            yield _labelled(probability(own_margins(_terms(batch).T, intercept)), batch.column("_label"))


def exchanged_scores(batches: Iterator[pa.RecordBatch], intercept: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Scores with each term in turn taken from the next row of the block (the last row takes the first), and the labels.

    The rows come in order of ``_block``; a batch is held until the row behind it is known.
    """
    key, first, held = None, None, None
    for batch in batches:
        ids = batch.column("_block").to_numpy()
        starts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1), len(ids)]
        for at, end in zip(starts[:-1], starts[1:]):
            if end == at:
                continue
            part = batch.slice(at, end - at)
            terms = _terms(part)
            if held is not None:
                yield from _chained(*held, terms[:1] if ids[at] == key else first, intercept)
            if ids[at] != key:
                key, first = ids[at], terms[:1].copy()
            held = terms, part.column("_label")
    if held is not None:
        yield from _chained(*held, first, intercept)


def _chained(terms: np.ndarray, labels: pa.Array, behind: np.ndarray, intercept: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    terms = np.concatenate((terms, behind))
    for at in range(0, len(labels), CHUNK):
        end = min(at + CHUNK, len(labels))
        own, other = np.ascontiguousarray(terms[at:end].T), np.ascontiguousarray(terms[at + 1:end + 1].T)
        yield _labelled(probability(exchanged_margins(own, other, intercept)), labels.slice(at, end - at))


def _labelled(scores: np.ndarray, labels: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows without a label are partners only."""
    if labels.null_count:
        scores, labels = scores[:, labels.is_valid().to_numpy(zero_copy_only=False)], labels.drop_null()
    return scores, labels.to_numpy(zero_copy_only=False).astype(np.int64)


def score_blocks(scored: Iterator[tuple[np.ndarray, np.ndarray]], cuts: np.ndarray, first: int) -> Iterator[pa.RecordBatch]:
    """Sorted score keys per matrix row (numbered from ``first``) and score range."""
    held, size = [], 0
    for scores, labels in scored:
        held.append((scores, labels))
        size += scores.size
        if size >= HELD_VALUES:
            yield from _sorted_blocks(held, cuts, first)
            held, size = [], 0
    if held:
        yield from _sorted_blocks(held, cuts, first)


def _sorted_blocks(held: list[tuple[np.ndarray, np.ndarray]], cuts: np.ndarray, first: int) -> Iterator[pa.RecordBatch]:
    labels = np.concatenate([y for _, y in held])
    limits = score_keys(cuts, 0)
    for j in range(len(held[0][0])):
        scores = np.concatenate([s[j] for s, _ in held])
        valid = ~np.isnan(scores)
        keys = score_keys(scores, labels) if valid.all() else score_keys(scores[valid], labels[valid])
        keys.sort()
        heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[:len(keys)])
        counts = np.empty(0, np.int64)  # sent where it saves bytes
        if 2 * len(heads) < len(keys):
            keys, counts = keys[heads], np.diff(np.append(heads, len(keys)))
        ends = np.concatenate(([0], np.searchsorted(keys, limits), [len(keys)]))
        block = pa.RecordBatch.from_arrays([
            pa.array(np.full(len(ends) - 1, j + first, np.int32)),
            pa.array(np.arange(len(ends) - 2, -1, -1, dtype=np.int32)),  # the highest scores come first
            _binary(keys, ends), _binary(counts, ends if len(counts) else np.zeros_like(ends)),
        ], names=["_j", BUCKET, "keys", "counts"])
        yield block.filter(pa.array(np.diff(ends) > 0))


def range_pairs(table: pa.Table) -> pa.Table:
    """Positives, negatives and, for each negative, the positives above it in one score range; ties count half."""
    parts = [(*_bytes(b.column("keys").cast(pa.binary()), np.int64), *_bytes(b.column("counts").cast(pa.binary()), np.int64))
             for b in table.to_batches()]
    keys = np.concatenate([p[0] for p in parts])
    if all(len(p[2]) == 0 for p in parts):
        keys.sort()
        counts = 1
    else:
        counts = np.ones(len(keys), np.int64)
        counts[np.concatenate([np.repeat(given > 0, sizes) for _, sizes, _, given in parts])] = np.concatenate([p[2] for p in parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    pos = counts * (keys & 1)
    neg = counts - pos
    # Negatives stand before the positives of the same score: those behind them are above or tied.
    pairs = (neg * (pos.sum() - np.cumsum(pos)).astype(float)).sum()
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] >> 1 != keys[:-1] >> 1)))
    if len(heads) < len(keys):
        pairs -= (np.add.reduceat(pos, heads).astype(float) * np.add.reduceat(neg, heads)).sum() / 2
    return pa.table({
        "_j": table["_j"][:1], BUCKET: table[BUCKET][:1], "pos": pa.array([pos.sum()], pa.int64()),
        "neg": pa.array([neg.sum()], pa.int64()), "pairs": pa.array([pairs], pa.float64()),
    })
