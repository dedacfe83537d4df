"""Phrase collocations: word pairs and triples that occur together far more often than their parts.

Method
    Texts are A-Z lower-cased and cut into pieces at ``[.,;:!?\\x0A-\\x0D]``, pieces into words ``[^\\x20\\x09]+``.
    Per language, f(phrase) counts the contiguous occurrences of a phrase of one to three words inside pieces.

    First pass: each task hashes every 1-, 2- and 3-word phrase of its texts to 64 bits (vectorised over the
    UTF-8 bytes, in slices of ``SLICE_BYTES``), counts the hashes whenever ``HELD_KEYS`` of them are held, and
    sends the counts to hash partitions of the language, one row of bytes a partition. Per partition the
    counts meet in a mergeable Misra-Gries summary whose capacity K is ``floor(M / threshold) + 1``, M being
    the partition's mass (all phrase occurrences sent to it): counters are summed and the (K+1)-th largest is
    subtracted from all. A phrase loses at most M / (K + 1) < threshold, so every phrase with f >= threshold
    survives; as each task's own summary is exact, a counter's error is the cut alone, and only counters of
    at least ``threshold`` above the cut can belong to a frequent phrase. Second pass: the surviving hashes go to every task in blocks of at most ``BLOCK_KEYS``; tasks
    count them exactly under a second, independent 64-bit hash and return the phrase text once per task.

    Candidates are the phrases of two or three words with a = f >= threshold. A cut after the first k words
    gives l = f(first part), r = f(rest) and score floor(10^6 a^2 / (l r)) in 38-digit decimals; the lowest
    score counts, ties to the smallest k. A pair is dropped when a candidate triple starts or ends with it
    and 100 f(triple) >= 50 a. Each language's best ``TOP`` by score, a, phrase (UTF-8 byte order) remain.

Scale
    The number of hash partitions of a language follows its size (``PART_BYTES`` of text a partition),
    so a language with a third of all text gets a third of the partitions. Spark brings the tasks' counters of a
    partition together and a task adds up one partition at a time. A very common phrase is one counter per task. The top list is cut within hashed groups
    first and then per language.

Defined results
    A null text has no words, a null lang is ``und``. Every row counts, repeated rows included. Languages
    without a candidate have no rows. Phrases are told apart by two 64-bit phrase hashes over 64-bit word hashes (two different
    words with equal hashes, chance about 2**-64 a pair, would be taken as one).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from certiscope.llm import textops
from certiscope.session import shuffle_width, stored

THRESHOLD = 10
TOP = 2000
PART_BYTES = 512 << 10
SLICE_BYTES = 512 << 10
HELD_KEYS = 1_500_000
BLOCK_KEYS = 2_000_000
MERGE_PARTITIONS = 2000
PACKED = "code int, part int, keys binary, counts binary"
UNKNOWN = "und"
_PIECE_BYTES = np.zeros(256, dtype=bool)
_PIECE_BYTES[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_WORD_GAP = np.zeros(256, dtype=bool)
_WORD_GAP[[0x20, 0x09]] = True
_WORD_GAP |= _PIECE_BYTES
_SEEDS = [np.random.default_rng(seed).integers(1, 2**64, 4, dtype=np.uint64) | np.uint64(1) for seed in (1969, 2003)]


def _words(data: np.ndarray, offsets: np.ndarray):
    """Start and end of every word, whether it follows the previous word in the same piece, and each text's first word."""
    inside = ~_WORD_GAP[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    cuts = np.concatenate([[0], np.cumsum(_PIECE_BYTES[data])])
    owner_first = np.searchsorted(starts, offsets)
    joined = np.zeros(len(starts), dtype=bool)
    if len(starts) > 1:
        joined[1:] = cuts[starts[1:]] == cuts[ends[:-1]]
    joined[owner_first[:-1][owner_first[:-1] < len(starts)]] = False  # a text's first word follows nothing
    return starts, ends, joined


def phrase_places(joined: np.ndarray, size: int) -> np.ndarray:
    """The index of the first word of every phrase of ``size`` words."""
    ok = np.ones(max(0, len(joined) - size + 1), dtype=bool)
    for k in range(1, size):
        ok &= joined[k:len(joined) - size + 1 + k]
    return np.flatnonzero(ok)


def phrase_hashes(words: np.ndarray, at: np.ndarray, size: int, family: int) -> np.ndarray:
    """The 64-bit hash, under one of two families, of the phrases of ``size`` words that begin at ``at``."""
    seeds = _SEEDS[family]
    total = np.full(len(at), size, dtype=np.uint64)
    for k in range(size):
        total += (words[at + k] ^ seeds[3]) * seeds[k]
    return textops.mix(total)


def _language(batch: pa.RecordBatch) -> pa.Array:
    return batch.column("lang").fill_null(UNKNOWN)


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    langs = _language(batch)
    for lang in pa.compute.unique(langs).to_pylist():
        yield lang, batch.filter(pa.compute.equal(langs, lang))


def _lower_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = textops.utf8(texts)
    return textops.LOWER[data], offsets


def _counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, with their summed counts. Without ``counts`` a key counts once and is sorted in place."""
    if counts is None:
        keys.sort()
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, dtype=np.int64)
    sums = np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts, first) if len(keys) else counts
    return keys[first], sums


def _packed(code: int, parts: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """One row a part: its keys and their counts as bytes. ``parts`` are sorted."""
    cuts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])).tolist() if len(parts) else []
    spans = list(zip(cuts, [*cuts[1:], len(parts)]))
    return pa.RecordBatch.from_pydict({
        "code": pa.array([code] * len(spans), pa.int32()), "part": pa.array([int(parts[x]) for x, _ in spans], pa.int32()),
        "keys": pa.array([keys[x:y].astype("<u8").tobytes() for x, y in spans], pa.binary()),
        "counts": pa.array([counts[x:y].astype("<i8").tobytes() for x, y in spans], pa.binary())})


def _first_pass(parts: dict[str, tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        sizes: dict[str, int] = {}

        def emit(lang):
            sizes.pop(lang)
            keys, counts = _counted(np.concatenate(held.pop(lang)))
            code, n_parts = parts[lang]
            part = ((keys >> np.uint64(32)) * np.uint64(n_parts) >> np.uint64(32)).astype(np.int32)  # rises with the key
            return _packed(code, part, keys, counts)

        for batch in batches:
            for lang, rows in _by_language(batch):
                for piece in textops.slices(rows, "text", SLICE_BYTES):
                    data, offsets = _lower_bytes(piece.column("text"))
                    starts, ends, joined = _words(data, offsets)
                    words = textops.span_hashes(data, starts, ends)
                    for size in (1, 2, 3):
                        hashes = phrase_hashes(words, phrase_places(joined, size), size, 0)
                        held.setdefault(lang, []).append(hashes)
                        sizes[lang] = sizes.get(lang, 0) + len(hashes)
                    if sum(sizes.values()) >= HELD_KEYS:  # the task's counters are handed on in bounded parts
                        for done in list(held):
                            yield emit(done)
        for lang in list(held):
            yield emit(lang)
    return run


def _spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte spans [begin, end) of ``data`` as a string array, gathered without a loop."""
    lengths = end - begin
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    index = np.repeat(begin - offsets[:-1], lengths) + np.arange(offsets[-1])
    body = pa.py_buffer(data[index].tobytes())
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), body]).cast(
        pa.large_string())


class _Places:
    """Sorted distinct hashes, found by their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys, bits = keys, max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        heads = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.starts = np.append(np.searchsorted(keys, heads), len(keys)).astype(np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash among the keys, -1 for one that is not there."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        head = (hashes >> self.shift).astype(np.int64)
        at, end = self.starts[head], self.starts[head + 1]
        rows = np.flatnonzero(at < end)
        at, end, hashes = at[rows], end[rows], hashes[rows]
        while len(rows):
            hit = self.keys[at] == hashes
            out[rows[hit]] = at[hit]
            more = ~hit & (at + 1 < end)
            rows, at, end, hashes = rows[more], at[more] + 1, end[more], hashes[more]
        return out


class _Exact:
    """One task's exact counts of one language's wanted phrases; a phrase's text is kept once."""

    def __init__(self, keys: np.ndarray):
        self.places = _Places(keys)
        self.second, self.count = np.zeros(len(keys), dtype=np.uint64), np.zeros(len(keys), dtype=np.int64)
        self.size = np.zeros(len(keys), dtype=np.int8)  # 0: not met yet
        self.order, self.texts = [], []

    def add(self, size: int, places: np.ndarray, second: np.ndarray, text) -> np.ndarray:
        """Counts phrases by place and second hash; the rows whose place is held by another phrase come back."""
        fresh = np.flatnonzero(self.size[places] == 0)
        found, first = np.unique(places[fresh], return_index=True)
        first = fresh[first]
        self.size[found], self.second[found] = size, second[first]
        if len(found):
            self.order.append(found)
            self.texts.append(text(first))
        own = (self.second[places] == second) & (self.size[places] == size)
        np.add.at(self.count, places[own], 1)
        return np.flatnonzero(~own)

    def rows(self, lang: str) -> Iterator[pa.RecordBatch]:
        for order, texts in zip(self.order, self.texts):
            yield _exact_rows(lang, self.places.keys[order], self.second[order], self.size[order], texts, self.count[order])


def _exact_rows(lang: str, g, g2, size, texts: pa.Array, f) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "lang": pa.array([lang] * len(g), pa.string()), "g": pa.array(g.view(np.int64)), "g2": pa.array(g2.view(np.int64)),
        "words": pa.array(size.astype(np.int32)), "phrase": texts, "f": pa.array(f)})


def _second_pass(shared, count_words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value  # lang -> sorted first-family hashes
        exact: dict[str, _Exact] = {}
        n_words: dict[str, int] = {}
        for batch in batches:
            for lang, rows in _by_language(batch):
                if lang not in wanted and not count_words:
                    continue
                if lang in wanted and lang not in exact:
                    exact[lang] = _Exact(wanted[lang])
                for piece in textops.slices(rows, "text", SLICE_BYTES):
                    data, offsets = _lower_bytes(piece.column("text"))
                    starts, ends, joined = _words(data, offsets)
                    n_words[lang] = n_words.get(lang, 0) + len(starts)
                    if lang not in exact:
                        continue
                    words = textops.span_hashes(data, starts, ends)
                    for size in (1, 2, 3):
                        at = phrase_places(joined, size)
                        places = exact[lang].places.find(phrase_hashes(words, at, size, 0))
                        at, places = at[places >= 0], places[places >= 0]
                        if not len(at):
                            continue
                        second = phrase_hashes(words, at, size, 1)

                        def text(k, at=at, size=size):  # blanks and tabs between words stay
                            return _spans(data, starts[at[k]], ends[at[k] + size - 1])

                        other = exact[lang].add(size, places, second, text)
                        if len(other):  # another phrase with an equal first hash
                            ones = np.ones(len(other), dtype=np.int64)
                            yield _exact_rows(lang, wanted[lang][places[other]], second[other], size * ones, text(other), ones)
        for lang in exact:
            yield from exact[lang].rows(lang)
        if count_words:  # a language's word count is a row of its own
            for lang, n in n_words.items():
                none = np.zeros(1, dtype=np.int64)
                yield _exact_rows(lang, none, none, none, pa.array([None], pa.large_string()), np.array([n], dtype=np.int64))
    return run


def _merge(threshold: int):
    """Rows of packed counters, those of a (code, part) one after another, to the survivors of each summary."""
    def survivors(owner, keys, counts):
        keys, sums = _counted(np.concatenate(keys), np.concatenate(counts))
        capacity = int(sums.sum()) // threshold + 1
        cut = np.partition(sums, len(sums) - capacity - 1)[len(sums) - capacity - 1] if len(sums) > capacity else 0
        keys = keys[(sums > cut) & (sums >= threshold)]
        return pa.RecordBatch.from_pydict({"code": pa.array([owner[0]] * len(keys), pa.int32()),
                                           "g": pa.array(keys.view(np.int64), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, keys, counts = None, [], []
        for batch in batches:
            for k in range(batch.num_rows):
                here = batch.column("code")[k].as_py(), batch.column("part")[k].as_py()
                if here != owner and owner is not None:
                    yield survivors(owner, keys, counts)
                    keys, counts = [], []
                owner = here
                keys.append(np.frombuffer(batch.column("keys")[k].as_py(), dtype="<u8"))
                counts.append(np.frombuffer(batch.column("counts")[k].as_py(), dtype="<i8"))
        if owner is not None:
            yield survivors(owner, keys, counts)
    return run


def merged_survivors(packed: DataFrame, threshold: int, partitions: int) -> DataFrame:
    """The mergeable Misra-Gries summaries: per (code, part) the capacity K = floor(M / threshold) + 1, the cut at
    the (K+1)-th largest summed counter (0 with fewer counters) and the counters left above it. A counter's
    error is at most the cut, so a phrase can reach the threshold only if its summed counter does: those stay.

    Counters travel as one row of bytes a task and part, not as a row each.
    """
    dealt = packed.repartition(partitions, "code", "part").sortWithinPartitions("code", "part")
    return dealt.mapInArrow(_merge(threshold), "code int, g long")


def summary_survivors(counted: DataFrame, threshold: int) -> DataFrame:
    """:func:`merged_survivors` of counters given as rows (code, part, g, c)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, part, g, c = (batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("code", "part", "g", "c"))
            for one in np.unique(code).tolist():
                rows = np.flatnonzero(code == one)
                rows = rows[np.argsort(part[rows], kind="stable")]
                yield _packed(one, part[rows], g[rows].view(np.uint64), c[rows])
    packed = counted.mapInArrow(run, PACKED)
    return merged_survivors(packed, threshold, shuffle_width(counted.sparkSession))


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(lang, phrase, words, f) of every phrase of one to three words with f >= threshold, counted exactly, and
    one row a language with words 0 and f its number of words."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text"))
    sizes = docs.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).collect()  # one row a language
    parts = {r["lang"]: (code, max(1, math.ceil((r["bytes"] or 0) / PART_BYTES))) for code, r in enumerate(sizes)}
    names = {code: lang for lang, (code, _) in parts.items()}
    packed = docs.mapInArrow(_first_pass(parts), PACKED)
    partitions = min(MERGE_PARTITIONS, sum(n for _, n in parts.values()) or 1)
    survivors = stored(merged_survivors(packed, threshold, partitions), "phrase_survivors")
    total = survivors.count()
    blocks = max(1, math.ceil(total / BLOCK_KEYS))
    exact = []
    for block in range(blocks):
        table = survivors.where(F.pmod(F.xxhash64("g"), F.lit(blocks)) == block).toArrow()  # about BLOCK_KEYS rows
        codes, keys = table.column("code").to_numpy(), np.ascontiguousarray(table.column("g").to_numpy())
        wanted = {names[int(c)]: np.unique(keys[codes == c].view(np.uint64)) for c in np.unique(codes)}
        shared = spark.sparkContext.broadcast(wanted)
        exact.append(docs.mapInArrow(_second_pass(shared, block == 0),
                                     "lang string, g long, g2 long, words int, phrase string, f long"))
    found = exact[0]
    for more in exact[1:]:
        found = found.unionByName(more)
    summed = found.groupBy("lang", "g", "g2", "words").agg(F.sum("f").alias("f"), F.first("phrase").alias("phrase"))
    phrase = F.regexp_replace("phrase", "[ \t]+", " ")
    return stored(summed.where((F.col("f") >= threshold) | (F.col("words") == 0)).select(
        "lang", phrase.alias("phrase"), "words", "f"), "phrase_counts")


def _exact_score(a, left, right):
    big = "decimal(38,0)"
    return F.expr(f"(cast({a} AS {big}) * {a} * 1000000) div (cast({left} AS {big}) * {right})")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP) -> DataFrame:
    """Per language the best ``top`` phrases: lang, rank, phrase, a, l, r, n, score (see the module)."""
    docs = docs.select("lang", "text")
    found = frequent_phrases(docs, threshold)
    n = found.where("words = 0").select("lang", F.col("f").alias("n"))
    counts = found.where("words > 0")
    candidates = counts.where(F.col("words") >= 2).select("lang", "phrase", "words", F.col("f").alias("a"),
                                                         F.split("phrase", " ").alias("w"))
    cuts = candidates.select("*", F.explode(F.expr(
        "transform(sequence(1, words - 1), k -> named_struct('k', k, 'left', array_join(slice(w, 1, k), ' '), "
        "'right', array_join(slice(w, k + 1, words - k), ' ')))")).alias("cut"))
    cuts = cuts.select("lang", "phrase", "words", "a", F.col("cut.k").alias("k"), F.col("cut.left").alias("left_part"),
                       F.col("cut.right").alias("right_part"))
    left = counts.select("lang", F.col("phrase").alias("left_part"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right_part"), F.col("f").alias("r"))
    scored = cuts.join(left, ["lang", "left_part"]).join(right, ["lang", "right_part"]).withColumn("score", _exact_score("a", "l", "r"))
    best = scored.groupBy("lang", "phrase", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best"))
    longer = candidates.where("words = 3").select("lang", "a", F.explode(F.array(
        F.array_join(F.slice("w", 1, 2), " "), F.array_join(F.slice("w", 2, 2), " "))).alias("phrase"))
    covering = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = (best.join(covering, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * 50))
            .join(n, "lang")
            .select("lang", "phrase", "a", "best.l", "best.r", "n", F.col("best.score").alias("score")))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
