"""Vectorised text work on Arrow batches, shared by the operators of this package.

Texts stay UTF-8 bytes. Words are maximal runs of bytes other than blank, tab, line feed, vertical tab, form
feed and carriage return; as these are ASCII, a byte-wise cut never splits a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 512 << 10
CHUNK_ROWS = 1024  # short texts too come in pieces, as some arrays have a fixed size a text
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64)
_TURNS = np.random.default_rng(19970310).integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its values; a null counts as empty."""
    texts = texts.fill_null("")
    if not len(texts):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.empty(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of values that hold at most ``limit`` bytes together; a longer value stands alone."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
        yield start, stop
        start = stop


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose ``column`` holds a bounded number of bytes, of ``CHUNK_ROWS`` rows at most."""
    _, offsets = utf8(batch.column(column))
    for start, stop in chunks(offsets, limit):
        for at in range(start, stop, CHUNK_ROWS):
            yield batch.slice(at, min(stop - at, CHUNK_ROWS))


def _grown(name: str, base: int, n: int) -> np.ndarray:
    have = _powers[name]
    if len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        _powers[name] = have = np.multiply.accumulate(steps)
    return have[:n]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for every value the number of words before it (one more entry at the end)."""
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: a polynomial over random byte values, read from running sums."""
    n = len(data) + 1
    sums = np.zeros(n, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _grown("up", _BASE, n)[:-1], out=sums[1:])
    down = _grown("down", pow(_BASE, -1, 2**64), n)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _TURNS[63])


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and the bounds of each value's runs among them.

    A value with fewer words, but at least one, has its whole sequence as its only run.
    """
    counts = np.diff(bounds)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(runs)])
    owner = np.repeat(np.arange(len(runs)), runs)
    at = bounds[:-1][owner] + np.arange(out_bounds[-1]) - out_bounds[:-1][owner]
    end = bounds[1:][owner]
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(size):
        here = at + k
        ok = here < end
        total[ok] += hashes[here[ok]] * _TURNS[k]
    return mix(total), out_bounds
