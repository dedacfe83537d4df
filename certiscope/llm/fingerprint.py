"""Document fingerprints that add up: a homomorphic hash of the multiset of paragraphs.

Method
    A document is the multiset of its lines. Every line is hashed to a wide vector, and the fingerprint is the
    sum of the vectors, lane by lane: ``EQUAL_LANES`` lanes modulo 2**32 taken from a 512-bit cryptographic
    hash of the line, and ``NEAR_LANES`` lanes modulo 2**16 into which each of the line's three-word runs adds
    +1 or -1 at a hashed place. So the order of lines does not matter, and lines can be added or taken away
    without the rest of the text. The first lanes decide equality. The second are a random projection of the
    runs' counts: the cosine of two of them, cut at 0, estimates how much the texts have in common.

Scale
    One pass a document; neighbouring documents meet through one shuffle of the texts (see ``with_next``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certiscope.llm import textops
from certiscope.session import shuffle_width

EQUAL_LANES = 16
NEAR_LANES = 256
RUN = 3


def vectors(lines: list[str], owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The summed vectors of ``n`` documents, given their lines and each line's document in rising order."""
    equal, near = np.zeros((n, EQUAL_LANES), dtype=np.uint32), np.zeros(n * NEAR_LANES, dtype=np.int64)
    if lines:
        coded = [line.encode() for line in lines]
        lanes = np.frombuffer(b"".join(hashlib.blake2b(c).digest() for c in coded), dtype="<u4").reshape(-1, EQUAL_LANES)
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        equal[owner[first]] = np.add.reduceat(lanes, first, axis=0, dtype=np.uint32)
        data = np.frombuffer(b"".join(coded), dtype=np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded])])
        starts, ends, bounds = textops.words(data, offsets)
        runs, at = textops.shingles(textops.span_hashes(data, starts, ends), bounds, RUN)
        place = np.repeat(owner, np.diff(at)) * NEAR_LANES + (runs >> np.uint64(40)).astype(np.int64) % NEAR_LANES
        sign = np.where(runs & np.uint64(1), 1, -1)
        near += np.bincount(place, weights=sign, minlength=n * NEAR_LANES).astype(np.int64)
    return equal, near.astype(np.int16).reshape(n, NEAR_LANES)


def fingerprints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lines, owner = [], []
    for k, text in enumerate(texts):
        own = text.split("\n") if text else []
        lines += own
        owner += [k] * len(own)
    return vectors(lines, np.array(owner, dtype=np.int64), len(texts))


def combine(a: tuple, b: tuple, sign: int = 1) -> tuple:
    """The fingerprint after adding (or, with -1, taking away) the lines behind ``b``."""
    return (a[0] + b[0], a[1] + b[1]) if sign > 0 else (a[0] - b[0], a[1] - b[1])


def written(prints: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """One lowercase hex string a document, all lanes in order."""
    return [e.astype("<u4").tobytes().hex() + v.astype("<i2").tobytes().hex() for e, v in zip(*prints, strict=True)]


def likeness(a: tuple, b: tuple) -> np.ndarray:
    """0 to 1 for each pair of documents; 1 for equal fingerprints."""
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    size = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    cosine = np.divide((x * y).sum(axis=1), size, out=np.zeros(len(x)), where=size > 0)
    same = (a[0] == b[0]).all(axis=1) & (a[1] == b[1]).all(axis=1)
    return np.where(same, 1.0, np.clip(cosine, 0.0, 1.0))


def with_next(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """The texts in ranges of doc_id, each range in falling order, followed by the first row of the next range.

    Columns doc_id, text, block and ``extra`` (true for the row that only serves as somebody's next). The ids
    alone give the cuts and each range's largest id, one row a range; so the texts move once.
    """
    partitions = partitions or shuffle_width(docs.sparkSession)
    cuts = docs.agg(F.percentile_approx("doc_id", [k / partitions for k in range(1, partitions)], 10000).alias("cuts")).first()["cuts"]
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts or []))]).cast("array<bigint>")
    block = F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(bounds, lambda c: c <= F.col("doc_id"))))
    placed = docs.withColumn("block", block.cast("int"))
    largest = sorted((r["block"], r["id"]) for r in placed.groupBy("block").agg(F.max("doc_id").alias("id")).collect())
    heads = [(largest[k - 1][1], b) for k, (b, _) in enumerate(largest)]  # an id, the block whose last row it follows
    serves = docs.sparkSession.createDataFrame(heads, "head long, serves int")
    more = placed.join(F.broadcast(serves), F.col("doc_id").eqNullSafe(F.col("head"))).select(
        "doc_id", "text", F.col("serves").alias("block"), F.lit(True).alias("extra"))
    spread = placed.withColumn("extra", F.lit(False)).union(more)
    return spread.repartition(partitions, "block").sortWithinPartitions(
        "block", "extra", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row joins the row after it; only the rows of one piece are held."""
    held, block = [], None
    for batch in batches:
        for part in textops.slices(batch, "text", textops.CHUNK_BYTES // 2):
            for row in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "block", "extra")), strict=True):
                if row[2] != block:
                    if len(held) > 1:
                        yield _described(held)
                    held, block, done = [], row[2], False
                if not done:
                    held.append((row[0], row[1] or ""))
                    done = row[3]
            if len(held) > 1:
                yield _described(held)
                held = held[-1:]
    if len(held) > 1:
        yield _described(held)


def _described(rows: list[tuple]) -> pa.RecordBatch:
    """Results for all rows but the last, which is the last one's next."""
    texts = [t for _, t in rows]
    edited = [t[:len(t) - len(t) // 2] + after[:len(t) // 2] for t, after in zip(texts[:-1], texts[1:], strict=True)]
    plain, changed = fingerprints(texts), fingerprints(edited)
    own, after = tuple(x[:-1] for x in plain), tuple(x[1:] for x in plain)
    return pa.record_batch({
        "doc_id": pa.array([i for i, _ in rows[:-1]], pa.int64()),
        "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        "fingerprint": pa.array(written(own), pa.string()), "edited_fingerprint": pa.array(written(changed), pa.string()),
        "near_edited": pa.array(likeness(own, changed)), "near_next": pa.array(likeness(own, after)),
    })


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document and of the document with its second half replaced from the next one.

    Next follows falling doc_id, rows without an id last, equal ids by text (null first); after the last comes
    the first. A null text counts as empty. A single row is its own next. Equal texts have equal fingerprints,
    whatever the rest of the row; other columns are not read.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return with_next(docs).mapInArrow(
        _prints, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double")


def document_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fingerprint of every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textops.slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                yield pa.record_batch({"doc_id": part.column("doc_id"), "fingerprint": pa.array(written(fingerprints(texts)), pa.string())})

    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return docs.mapInArrow(run, "doc_id long, fingerprint string")
