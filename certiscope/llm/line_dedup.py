"""Line de-duplication: lines shared by many documents stay only in one of them.

Method
    A line's key is the line with blanks and control characters ``[\\x20\\x09-\\x0D]`` stripped at both ends and
    A-Z lower-cased; a key counts when it has at least ``min_chars`` code points. Every such key is hashed to
    128 bits (xxh3). Spark counts the documents holding each hash (distinct (hash, doc_id) first, so a very
    common line is spread over all tasks and pre-aggregated before the second shuffle) and keeps those found in
    at least ``min_docs`` documents, with the largest doc_id holding them.

    These frequent hashes are dealt into shards of about ``SHARD_KEYS`` keys. Each shard gets a minimal perfect
    hash (hash and displace: keys fall into buckets of about three, every bucket gets the smallest offset that
    moves all its keys to free slots, single keys take the last free slots directly) and three compact arrays
    in slot order: a 64-bit fingerprint (the other half of the 128-bit hash), the number of documents, the
    owning doc_id. Documents then probe the arrays: bucket, offset, slot, compare the fingerprint. No line
    is joined to anything.

Scale
    Counting is two aggregates over narrow (hash, doc_id) rows. The index is a table of shard rows; its size
    in bytes is counted before it is sent to the executors. When it is larger than ``PROBE_BYTES`` the
    shards are cut into blocks of at most that size, and the documents pass once per block, written to the
    shared folder after each pass, so no executor holds more than one block.

Defined results
    A null or empty text is one empty line; it is kept. Rows with a null doc_id hold keys but are never
    counted as a document and never own a key, so they lose every line of a frequent key. Repeated rows of
    one doc_id count as one document and give equal results. Two different keys with the same 128-bit hash
    would be taken as one (chance about 2**-128 a pair). The result has the columns doc_id, text (as given),
    kept_text, n_lines, n_dropped; other input columns are not carried.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certiscope.llm.textops import mix
from certiscope.session import stored

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_KEYS = 50_000
BUCKET_KEYS = 3
PROBE_BYTES = 64 << 20
_STRIP = " \t\n\x0b\x0c\r"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_SEEDS = (0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15)
_TRIES = 1024
_MASK = (1 << 64) - 1


def lines_of(text: str | None) -> list[str]:
    """The lines of a text; a null or empty text is one empty line."""
    return (text or "").split("\n")


def key_hash(line: str, min_chars: int = MIN_CHARS) -> tuple[int, int] | None:
    """The two signed 64-bit halves of the key's hash, or None for a key shorter than ``min_chars``."""
    key = line.strip(_STRIP).translate(_LOWER)
    if len(key) < min_chars:
        return None
    h = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass"))
    low, high = h & _MASK, h >> 64
    return low - (1 << 64) if low >> 63 else low, high - (1 << 64) if high >> 63 else high


def _occurrences(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, firsts, seconds = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for a, b in {h for h in (key_hash(line, min_chars) for line in lines_of(text)) if h is not None}:
                    ids.append(doc_id)
                    firsts.append(a)
                    seconds.append(b)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "h1": pa.array(firsts, pa.int64()),
                                              "h2": pa.array(seconds, pa.int64())})
    return run


# --- minimal perfect hash over 64-bit keys ----------------------------------------------------------------------

def _buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64) ^ np.uint64(_SEEDS[0])) % np.uint64(buckets)).astype(np.int64)


def _bases(keys: np.ndarray, turn: np.ndarray, size: int) -> np.ndarray:
    """Each key's first slot under a bucket's hash turn."""
    mixed = mix(keys.astype(np.uint64) ^ (np.uint64(_SEEDS[1]) + turn.astype(np.uint64)))
    return (mixed % np.uint64(max(size, 1))).astype(np.int64)


def build_mphf(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One offset a bucket and the slot of every key: a bijection of the ``len(keys)`` keys onto 0..n-1.

    Keys must be distinct. An offset holds a hash turn (high 32 bits) and a shift (low 32 bits); a key
    lands in slot (base(key, turn) + shift) mod n. Buckets are placed largest first: the smallest turn under
    which its keys have distinct bases, then the smallest shift that finds all their slots free. Buckets of
    one key take the free slots that are left, by their shift alone.
    """
    n = len(keys)
    buckets = max(1, math.ceil(n / BUCKET_KEYS))
    offsets = np.zeros(buckets, dtype=np.int64)
    slot = np.full(n, -1, dtype=np.int64)
    if n == 0:
        return offsets, slot
    bucket = _buckets(keys, buckets)
    free = np.ones(n, dtype=bool)
    order = np.argsort(bucket, kind="stable")
    bounds = np.flatnonzero(np.diff(np.concatenate([[-1], bucket[order], [buckets]])))
    groups = sorted(((int(bucket[order[a]]), order[a:b]) for a, b in zip(bounds[:-1], bounds[1:])), key=lambda g: -len(g[1]))
    shifts = np.arange(_TRIES, dtype=np.int64)
    singles = [g for g in groups if len(g[1]) == 1]
    for b, members in (g for g in groups if len(g[1]) > 1):
        turn, placed = 0, False
        while not placed:
            own = _bases(keys[members], np.full(len(members), turn), n)
            start = 0
            while len(np.unique(own)) == len(own) and start < n:
                hit = np.flatnonzero(free[(own[:, None] + start + shifts[None, :]) % n].all(axis=0))
                if len(hit):
                    shift = start + int(hit[0])
                    offsets[b] = (turn << 32) | shift
                    slot[members] = (own + shift) % n
                    free[slot[members]] = False
                    placed = True
                    break
                start += _TRIES
            turn += 1
    if singles:
        members = np.array([m[0] for _, m in singles], dtype=np.int64)
        which = np.array([b for b, _ in singles], dtype=np.int64)
        open_slots = np.flatnonzero(free)[:len(members)]
        slot[members] = open_slots
        offsets[which] = (open_slots - _bases(keys[members], np.zeros(len(members), dtype=np.int64), n)) % n
    return offsets, slot


def mphf_lookup(offsets: np.ndarray, n: int, keys: np.ndarray) -> np.ndarray:
    """The slot each key would take; for keys outside the set any slot."""
    if n == 0:
        return np.zeros(len(keys), dtype=np.int64)
    offset = offsets[_buckets(keys, len(offsets))]
    return (_bases(keys, offset >> 32, n) + (offset & 0xFFFFFFFF)) % n


def _build_shard(frame: pd.DataFrame) -> pd.DataFrame:
    keys = frame["h1"].to_numpy(np.int64)
    offsets, slot = build_mphf(keys)
    fps, counts, owners = (np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int32),
                           np.zeros(len(keys), dtype=np.int64))
    fps[slot] = frame["h2"].to_numpy(np.int64)
    counts[slot] = frame["n_docs"].to_numpy(np.int64).astype(np.int32)
    owners[slot] = frame["owner"].to_numpy(np.int64)
    return pd.DataFrame({"shard": [int(frame["shard"].iloc[0])], "n": [len(keys)], "offsets": [offsets.tobytes()],
                         "fps": [fps.tobytes()], "counts": [counts.tobytes()], "owners": [owners.tobytes()]})


class Index:
    """The shards of one block, ready to probe."""

    def __init__(self, rows: list, shards: int):
        self.shards = shards
        self.parts = {int(r["shard"]): (np.frombuffer(r["offsets"], dtype=np.int64), int(r["n"]),
                                        np.frombuffer(r["fps"], dtype=np.int64), np.frombuffer(r["owners"], dtype=np.int64))
                      for r in rows}

    def owners(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key: whether it is frequent (in this block), and the doc_id that owns it."""
        found, owner = np.zeros(len(h1), dtype=bool), np.zeros(len(h1), dtype=np.int64)
        shard = (h1 % self.shards).astype(np.int64)  # numpy % is never negative for a positive divisor
        for s, (offsets, n, fps, owners) in self.parts.items():
            at = np.flatnonzero(shard == s)
            if not len(at) or n == 0:
                continue
            slot = mphf_lookup(offsets, n, h1[at])
            hit = fps[slot] == h2[at]
            found[at[hit]] = True
            owner[at[hit]] = owners[slot[hit]]
        return found, owner


def _probe(shared, shards: int, min_chars: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value, shards)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            drops = batch.column("drops").to_pylist() if "drops" in batch.schema.names else [None] * len(ids)
            out_drops, kept_texts, n_lines, n_dropped = [], [], [], []
            for doc_id, text, before in zip(ids, texts, drops):
                lines = lines_of(text)
                keyed = [(k, h) for k, h in enumerate(key_hash(line, min_chars) for line in lines) if h is not None]
                gone = set(before or ())
                if keyed:
                    h1 = np.array([h[0] for _, h in keyed], dtype=np.int64)
                    h2 = np.array([h[1] for _, h in keyed], dtype=np.int64)
                    found, owner = index.owners(h1, h2)
                    gone |= {k for (k, _), f, o in zip(keyed, found, owner) if f and o != doc_id}
                if last:
                    kept_texts.append("\n".join(line for k, line in enumerate(lines) if k not in gone))
                    n_lines.append(len(lines))
                    n_dropped.append(len(gone))
                else:
                    out_drops.append(sorted(gone))
            columns = {"doc_id": batch.column("doc_id"), "text": batch.column("text")}
            if last:
                columns |= {"kept_text": pa.array(kept_texts, pa.string()), "n_lines": pa.array(n_lines, pa.int64()),
                            "n_dropped": pa.array(n_dropped, pa.int64())}
            else:
                columns["drops"] = pa.array(out_drops, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)
    return run


def frequent_keys(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, n_docs, owner) of every key of at least ``min_chars`` code points held by ``min_docs`` documents."""
    occurrences = docs.mapInArrow(_occurrences(min_chars), "doc_id long, h1 long, h2 long")
    held = occurrences.select("h1", "h2", "doc_id").distinct()
    return (held.groupBy("h1", "h2").agg(F.count("doc_id").alias("n_docs"), F.max("doc_id").alias("owner"))
            .where(F.col("n_docs") >= min_docs))


def build_index(frequent: DataFrame) -> tuple[DataFrame, int]:
    """The shard rows of the minimal perfect hash and the number of shards."""
    n = frequent.count()
    shards = max(1, math.ceil(n / SHARD_KEYS))
    dealt = frequent.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    index = dealt.groupBy("shard").applyInPandas(
        _build_shard, "shard int, n long, offsets binary, fps binary, counts binary, owners binary")
    return stored(index, "line_index"), shards


def _blocks(index: DataFrame, limit: int) -> list[list[int]]:
    """Shards grouped so that each group's arrays hold at most ``limit`` bytes (a larger shard stands alone)."""
    sizes = index.select("shard", (F.length("offsets") + F.length("fps") + F.length("owners")).alias("bytes")).collect()
    blocks, current, total = [], [], 0
    for row in sorted(sizes, key=lambda r: r["shard"]):
        if current and total + row["bytes"] > limit:
            blocks.append(current)
            current, total = [], 0
        current.append(row["shard"])
        total += row["bytes"]
    return blocks + [current] if current else blocks or [[]]


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, doc_id: str = "doc_id",
                text: str = "text", probe_bytes: int = PROBE_BYTES) -> DataFrame:
    """Every document with the lines of frequent keys removed except in the key's owner (see the module)."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    index, shards = build_index(stored(frequent_keys(docs, min_chars, min_docs), "frequent_lines"))
    blocks = _blocks(index, probe_bytes)  # one row a shard: as many rows as SHARD_KEYS-sized parts of the keys
    context = docs.sparkSession.sparkContext
    current = docs
    for k, block in enumerate(blocks):
        last = k == len(blocks) - 1
        rows = [r.asDict() for r in index.where(F.col("shard").isin(block)).select(
            "shard", "n", "offsets", "fps", "owners").collect()]  # at most probe_bytes, counted by _blocks
        schema = ("doc_id long, text string, kept_text string, n_lines long, n_dropped long" if last
                  else "doc_id long, text string, drops array<int>")
        step = current.mapInArrow(_probe(context.broadcast(rows), shards, min_chars, last), schema)
        current = step if last else stored(step, "line_drops")
    return current


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
