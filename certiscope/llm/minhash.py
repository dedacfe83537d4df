"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Method
    The distinct word shingles of a document are thrown into bins round after round; a bin keeps the smallest
    (round, value) it has seen. The later rounds throw every shingle into one given bin each, so all bins
    fill, and a document stops as soon as they are full. Bins of two documents agree with a probability equal
    to their Jaccard similarity, concentrated as for independent draws. Groups of bins form band keys;
    documents that share a key are candidates, an estimate from the whole sketch thins them out, and what is
    left is confirmed on the full shingle sets. The thinning has a second part that errs to one side only: one
    bit a shingle is flipped in a small table, and two tables differ in no more bits than the sets differ in
    shingles, so pairs with too many different bits are no links for certain.

Scale
    Equal sets are merged before anything else, so exact copies cost one row. A large bucket is never turned
    into all its pairs. First each bucket is a chain (neighbours along another band's key, in slices of
    bounded size), and of the chain every document's most similar partner is confirmed; the links found are
    contracted. Then only buckets that still hold several components are searched, each document outside a
    bucket's main component against the bucket, in blocks of bounded size and on sketches alone: once for the
    most similar pair of each component, which joins nearly all there is to join, and at last for every likely
    pair across components. So work grows with the documents that are *not* linked yet, nothing is lost, and
    no group meets in one task.

Exactness
    Bands are chosen so that a link at the threshold is missed with probability at most ``MISS``; the
    estimate passes everything within five standard deviations of the threshold.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from certiscope.llm import textops
from certiscope.session import stored

SHINGLE = 5
PERCENT = 80
MISS = 1e-6
MAX_BINS = 192
SLICE = 1000
PARITY_BITS = 1024

_FULL = np.uint64(2**64 - 1)


def banding(percent: int, max_bins: int = MAX_BINS, miss: float = MISS) -> tuple[int, int]:
    """(bands, bins per band): the most selective bands that find a link at the threshold."""
    best = None
    for rows in range(1, 33):
        bands = max(1, math.ceil(math.log(miss) / math.log1p(-min(percent / 100, 1 - 1e-9) ** rows)))
        if bands * rows <= max_bins:
            best = bands, rows
    if best is None:
        raise ValueError(f"{max_bins} bins cannot find links at {percent} %")
    return best


def fill_bins(shingles: np.ndarray, owner: np.ndarray, n: int, bins: int) -> np.ndarray:
    """The sketches of ``n`` documents, one row each; ``owner`` is the document of each distinct shingle."""
    sketch = np.full(n * bins, _FULL, dtype=np.uint64)
    for turn in range(2 * bins):
        x = textops.mix(shingles + np.uint64((turn * 0xD1B54A32D192ED03 + 0x8CB92BA72F3D8DD7) % 2**64))
        if turn < bins:
            place = ((x >> np.uint64(40)) * np.uint64(bins) >> np.uint64(24)).astype(np.int64)
        else:
            place = np.int64(turn - bins)
        value = np.uint64(turn << 40) | (x & np.uint64(2**40 - 1))
        np.minimum.at(sketch, owner * bins + place, value)
        open_ = (sketch.reshape(n, bins) == _FULL).any(axis=1)
        left = open_[owner]
        if not left.any():
            break
        shingles, owner = shingles[left], owner[left]
    return sketch.reshape(n, bins)


def distinct_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = textops.utf8(texts)
    data = textops.LOWER[data]
    starts, ends, bounds = textops.words(data, offsets)
    runs, at = textops.shingles(textops.span_hashes(data, starts, ends), bounds, SHINGLE)
    return [np.unique(runs[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def _sketches(bands: int, rows: int):
    bins = bands * rows
    turns = np.random.default_rng(7).integers(1, 2**64, (bands, rows), dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textops.slices(batch, "text"):
                sets = distinct_sets(part.column("text"))
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                owner = np.repeat(np.arange(len(sets)), sizes)
                sketch = fill_bins(np.concatenate(sets), owner, len(sets), bins)
                keys = textops.mix((sketch.reshape(len(sets), bands, rows) * turns).sum(axis=2)).view(np.int64)
                small = np.concatenate([
                    (textops.mix(sketch) & np.uint64(255)).astype(np.uint8), parities(sets),
                    sizes.astype("<u4").view(np.uint8).reshape(-1, 4)], axis=1)
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "n_shingles": pa.array(sizes),
                    "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    "sketch": pa.array([r.tobytes() for r in small], pa.binary()),
                    "bands": pa.ListArray.from_arrays(
                        pa.array(np.arange(0, bands * len(sets) + 1, bands, dtype=np.int32)), pa.array(keys.ravel())),
                })

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in textops.slices(batch, "text"):
            sets = distinct_sets(part.column("text"))
            bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            values = pa.array(np.concatenate(sets).view(np.int64))
            yield pa.record_batch({"doc_id": part.column("doc_id"), "items": pa.ListArray.from_arrays(pa.array(bounds), values)})


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """For each set one table of bits, each telling whether an odd number of its shingles falls there."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    at = (np.concatenate(sets) >> np.uint64(20)).astype(np.int64) % PARITY_BITS
    odd = np.bincount(owner * PARITY_BITS + at, minlength=len(sets) * PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(sets), PARITY_BITS), axis=1)


class Sketches:
    """Sketches of many documents: bins, parity bits and set size of each."""

    def __init__(self, column: pa.Array, bins: int, percent: int):
        rows = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)
        self.bins, self.percent = rows[:, :bins], percent
        self.bits = np.ascontiguousarray(rows[:, bins:-4]).view(np.uint64)
        self.sizes = np.ascontiguousarray(rows[:, -4:]).view("<u4")[:, 0].astype(np.int64)

    def equal(self, a, other: Sketches, b) -> np.ndarray:
        """The number of equal bins of documents ``a`` and ``b`` (indices that broadcast); 0 where no link can be."""
        share = self.percent / 100
        least = self.bins.shape[1] * share - 5 * math.sqrt(self.bins.shape[1] * share * (1 - share))
        differ = np.bitwise_count(self.bits[a] ^ other.bits[b]).sum(axis=-1, dtype=np.int64)
        can = (100 + self.percent) * differ <= (100 - self.percent) * (self.sizes[a] + other.sizes[b])
        found = np.asarray((self.bins[a] == other.bins[b]).sum(axis=-1))
        return np.where(can & (found >= least), found, 0)


def _likely(bins: int, percent: int):
    """Pairs that can be links by their sketches, with the number of equal bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (Sketches(batch.column(c), bins, percent) for c in ("sketch_a", "sketch_b"))
            equal = a.equal(slice(None), b, slice(None))
            ok = pa.array(equal > 0)
            yield pa.record_batch({"a": batch.column("a").filter(ok), "b": batch.column("b").filter(ok), "equal": pa.array(equal[equal > 0])})

    return run


def _across(bins: int, percent: int, best: bool):
    """Pairs of different components inside each block of a bucket; blocks arrive sorted and are of bounded size.

    All likely pairs, or with ``best`` only the most similar one of each component outside the main one.
    """

    def pairs(ids, comps, minor, sketch):
        found = [np.empty((0, 3), dtype=np.int64)]
        rows, every = np.flatnonzero(minor), np.flatnonzero(~minor)
        for at in range(0, len(rows) if len(every) else 0, 64):
            some = rows[at:at + 64]
            equal = sketch.equal(some[:, None], sketch, every[None, :])
            equal[comps[some][:, None] == comps[every][None, :]] = 0
            if best:
                top = equal.argmax(axis=1)
                i = np.flatnonzero(equal[np.arange(len(some)), top])
                j = top[i]
            else:
                i, j = np.nonzero(equal)
            found.append(np.stack([some[i], every[j], equal[i, j]], axis=1))
        i, j, equal = np.concatenate(found).T
        if best and len(i):
            order = np.lexsort((-equal, comps[i]))
            first = order[np.concatenate([[True], comps[i[order]][1:] != comps[i[order]][:-1]])]
            i, j = i[first], j[first]
        return np.unique(np.stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])], axis=1), axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            batch = table.to_batches()[0] if table.num_rows else batch
            block = batch.column("block").to_numpy()
            cuts = np.flatnonzero(block[1:] != block[:-1]) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            rest = batch.slice(last)
            yield from emit(batch.slice(0, last), cuts)
        if rest is not None and rest.num_rows:
            yield from emit(rest, np.empty(0, dtype=np.int64))

    def emit(batch, cuts):
        if not batch.num_rows:
            return
        ids, comps = batch.column("id").to_numpy(), batch.column("comp").to_numpy()
        minor = batch.column("minor").to_numpy(zero_copy_only=False)
        edges = [0, *[c for c in cuts if c < batch.num_rows], batch.num_rows]
        found = [pairs(ids[s:e], comps[s:e], minor[s:e], Sketches(batch.column("sketch").slice(s, e - s), bins, percent))
                 for s, e in zip(edges[:-1], edges[1:], strict=True)]
        out = np.concatenate(found)
        yield pa.record_batch({"a": pa.array(out[:, 0]), "b": pa.array(out[:, 1])})

    return run


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every end of an edge (a, b): comp is the smallest id it is connected with.

    Every id points to its smallest neighbour, pointers are followed twice, and the edges are drawn anew
    between what they point to. Each round leaves a fraction of the ids, and each is stored, so a lost
    executor costs one round.
    """
    edges = stored(edges.where("a != b").select("a", "b").distinct(), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("id"), F.col("b").alias("other")).union(
            edges.select(F.col("b").alias("id"), F.col("a").alias("other")))
        step = stored(both.groupBy("id").agg(F.least("id", F.min("other")).alias("to")), "step")
        far = step.select(F.col("id").alias("to"), F.col("to").alias("far"))
        step = stored(step.join(far, "to").select("id", F.col("far").alias("to")), "jump")
        if labels is None:
            labels = step.select("id", F.col("to").alias("comp"))
        else:
            moved = step.select(F.col("id").alias("comp"), "to")
            labels = stored(labels.join(moved, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), "labels")
        a, b = step.select(F.col("id").alias("a"), F.col("to").alias("to_a")), step.select(F.col("id").alias("b"), F.col("to").alias("to_b"))
        edges = stored(
            edges.join(a, "a").join(b, "b").where("to_a != to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("comp")) if labels is None else labels


def near_duplicates(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Texts are linked when 100 * shared >= percent * all of their distinct five-word shingles (A-Z lower-cased).
    A null, empty or blank text has no shingles and is linked with nothing; a shorter text has its whole word
    sequence as its only shingle. Rows that share an id count as one document. A row without an id is linked
    with nothing: its component_id is null and it is kept. Other columns are not read.
    """
    bands, rows = banding(percent)
    bins = bands * rows
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketched = stored(docs.mapInArrow(
        _sketches(bands, rows), "doc_id long, n_shingles long, digest binary, sketch binary, bands array<long>"), "sketches")
    usable = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(usable.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    reps = stored(
        usable.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"])
        .select(F.col("doc_id").alias("id"), "sketch", "bands"), "representatives")
    sketches = reps.select("id", "sketch")

    keyed = reps.select("id", "bands", F.posexplode("bands").alias("band", "key")).select(
        "id", "key", F.col("bands")[(F.col("band") + 1) % bands].alias("along"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = stored(keyed.join(shared, "key"), "buckets")

    def with_sketches(pairs):
        a = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sketch_a"))
        b = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sketch_b"))
        return pairs.join(a, "a").join(b, "b")

    parts = F.ceil(F.col("size") / SLICE)
    chain = Window.partitionBy("key", F.pmod(F.xxhash64("id"), parts)).orderBy("along", "id")
    neighbours = buckets.select(F.lag("id").over(chain).alias("before"), "id").where("before IS NOT NULL AND before != id").select(
        F.least("before", "id").alias("a"), F.greatest("before", "id").alias("b")).distinct()
    likely = stored(with_sketches(neighbours).select("a", "b", "sketch_a", "sketch_b").mapInArrow(
        _likely(bins, percent), "a long, b long, equal long"), "likely")

    both = likely.union(likely.select("b", "a", "equal"))
    closest = stored(both.groupBy("a").agg(F.max_by("b", F.struct("equal", -F.col("b"))).alias("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "closest")
    sets = stored(_item_sets(docs, closest), "sets")
    linked = components(_confirmed(closest, sets, percent))
    tested = closest
    for best in (True, False):
        asked = _between(buckets, linked, sketches, bins, percent, best)
        if not best:
            ends = _component_of(_component_of(likely, linked, "a"), linked, "b")
            asked = asked.union(ends.where("comp_a != comp_b").select("a", "b")).distinct()
        asked = stored(asked.join(tested, ["a", "b"], "left_anti"), "asked")
        if asked.isEmpty():
            continue
        new = asked.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct().join(sets.select("doc_id"), "doc_id", "left_anti")
        sets = sets.union(stored(_item_sets(docs, new.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"))), "sets"))
        found = _component_of(_component_of(_confirmed(asked, sets, percent), linked, "a"), linked, "b")
        linked = _joined(linked, components(found.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))))
        tested = tested.union(asked)
    final = linked
    of_class = stored(classes.join(final, classes["rep"] == final["id"], "left").select(
        "digest", F.coalesce("comp", "rep").alias("component_id")), "class-components")
    out = sketched.select("doc_id", "n_shingles", F.when(F.expr("n_shingles > 0 AND doc_id IS NOT NULL"), F.col("digest")).alias("digest"))
    out = out.join(of_class, "digest", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _component_of(pairs: DataFrame, linked: DataFrame, end: str) -> DataFrame:
    """Adds the component of one end of the pairs, the document itself where it has no link."""
    names = linked.select(F.col("id").alias(end), F.col("comp").alias(f"comp_{end}"))
    return pairs.join(names, end, "left").withColumn(f"comp_{end}", F.coalesce(f"comp_{end}", end))


def _joined(linked: DataFrame, more: DataFrame) -> DataFrame:
    """Components after links between components; ``more`` maps components, or documents without one so far."""
    ids = linked.union(more.select("id", F.col("id").alias("comp"))).groupBy("id").agg(F.min("comp").alias("comp"))
    moved = more.select(F.col("id").alias("comp"), F.col("comp").alias("to"))
    return stored(ids.join(moved, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), "components")


def _item_sets(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(doc_id, items): the full shingle sets of all documents in the pairs."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "set-ids")
    return docs.join(ids, "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, items array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are as similar as asked for."""
    a = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("items_a"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("items").alias("items_b"))
    shared = F.size(F.array_intersect("items_a", "items_b"))
    met = 100 * shared >= percent * (F.size("items_a") + F.size("items_b") - shared)
    return pairs.join(a, "a").join(b, "b").where(met).select("a", "b")


def _between(buckets: DataFrame, linked: DataFrame, sketches: DataFrame, bins: int, percent: int, best: bool) -> DataFrame:
    """Likely pairs across the components that one bucket still holds.

    Every document outside the bucket's main component meets the whole bucket, in blocks of about SLICE by
    SLICE documents. Buckets of two were settled by the chain.
    """
    rows = buckets.where("size > 2").join(linked, "id", "left").select("key", "id", F.coalesce("comp", "id").alias("comp"))
    sizes = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("key").agg(
        F.sum("n").alias("size"), F.max("n").alias("main_size"), F.max_by("comp", F.struct("n", "comp")).alias("main"),
    ).where("size > main_size")
    rows = stored(rows.join(mixed, "key").select(
        "key", "id", "comp", (F.col("comp") != F.col("main")).alias("outside"),
        F.ceil((F.col("size") - F.col("main_size")) / SLICE).cast("int").alias("down"),
        F.ceil(F.col("size") / SLICE).cast("int").alias("over")), "mixed-buckets")
    at = F.xxhash64("id")
    minor = rows.where("outside").select(
        "key", "id", "comp", F.lit(True).alias("minor"), F.pmod(at, "down").alias("i"), F.explode(F.sequence(F.lit(0), F.col("over") - 1)).alias("j"))
    every = rows.select(
        "key", "id", "comp", F.lit(False).alias("minor"), F.explode(F.sequence(F.lit(0), F.col("down") - 1)).alias("i"), F.pmod(at, "over").alias("j"))
    blocks = minor.union(every.select(*minor.columns)).select("id", "comp", "minor", F.xxhash64("key", F.col("i").cast("int"), F.col("j").cast("int")).alias("block"))
    blocks = blocks.join(sketches, "id").repartition("block").sortWithinPartitions("block")
    return blocks.select("id", "comp", "minor", "block", "sketch").mapInArrow(_across(bins, percent, best), "a long, b long").distinct()
