"""Ranked lexical search: the best documents for each query by a saturating term-frequency score.

Method
    Terms are the maximal runs of characters other than ASCII punctuation, blanks and controls
    (``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``) with only A-Z lower-cased. With N documents that have a term, L
    terms in all, n terms in a document, df documents holding a term and tf its count in one document::

        w     = floor(1000 * ln((2N + 2) / (2 df + 1)))            (doubles)
        m     = 50 + (50 n N) div L                                  (64-bit integers from here on)
        score = sum over the query's distinct terms of  w * ((10^9 tf) div (1000 tf + 20 m))

    The index holds every document with a term, in blocks of documents of a similar number of distinct
    terms (at most ``BLOCK_DOCS`` documents and ``BLOCK_BITS`` signature bits a block). A document's Bloom signature has ``BITS_PER_TERM`` bits per distinct term (a power of two, at least
    ``MIN_BITS``) and ``PROBES`` bits set per term; a block stores them bit-sliced: for each bit position, one
    bitmap over the block's documents. Beside it, each document's sorted term hashes and counts.

    A query ANDs, for each term, the ``PROBES`` slices of its bits: a bitmap that holds every document with
    the term (and a few without). Summing the weights of the terms whose bitmap holds a document and
    multiplying by ``(10^9 n) div (1000 n + 20 m)`` (the largest factor any tf <= n can reach) bounds its score
    from above. Documents are rescored exactly in falling order of that bound until 50 exact scores are at
    least the next bound: a document whose bound lies below the 50th exact score found so far in its task's
    blocks cannot be in the answer, and every other one is scored exactly. The tasks' best 50 meet in a top-50
    by query, first within groups of tasks, then across them.

Scale
    One pass over the texts builds the index (written to the shared folder). Counting N, L and df reads the
    index, not the texts. Queries go in groups of ``ITEMS_PER_PASS`` with their weights sent to every task;
    each block is searched by one task without a shuffle; the two top-50 steps hold at most 50 rows a task.

Defined results
    A null text has no terms; documents without terms are counted nowhere and never returned. Every row is a
    document, repeated rows included (they take consecutive ranks). A null doc_id ranks after all ids of equal
    score. A query without terms, or whose terms no document holds, returns nothing. Terms are found and
    hashed on the UTF-8 bytes, vectorised over a batch (a term character is an ASCII letter or digit or any
    byte of a non-ASCII character), and identified by a 64-bit hash; two different terms with the same hash
    would be counted as one (chance about 2**-64 a pair).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from certiscope.llm import textops
from certiscope.llm.textops import mix
from certiscope.session import stored

TOP = 50
BITS_PER_TERM = 8
MIN_BITS = 64
PROBES = 3
BLOCK_DOCS = 4096
BLOCK_BITS = 1 << 22
ITEMS_PER_PASS = 10_000
TERM = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_PROBE_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
INDEX_SCHEMA = ("block long, bits int, doc_ids array<long>, ns array<long>, slices binary, hashes binary, tfs binary, "
                "starts binary")


_TERM_BYTE = np.zeros(256, dtype=bool)
_TERM_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(text: str | None) -> list[str]:
    return TERM.findall(text.translate(_LOWER)) if text else []


def term_hash(term: str) -> int:
    """The hash of one term, as :func:`text_terms` gives it."""
    return int(text_terms(pa.array([term]))[2][0]) if term else 0


def text_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every text its number of terms, and per text its distinct term hashes (sorted) with their counts:
    (bounds of each text's distinct terms, hashes, counts) besides the number of terms a text.

    Works on the UTF-8 bytes: a term character is an ASCII letter or digit or any byte of a non-ASCII
    character, so byte runs are exactly the pattern's maximal matches. A null text has no terms.
    """
    data, offsets = textops.utf8(texts)
    data = textops.LOWER[data]
    inside = _TERM_BYTE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    per_text = np.diff(np.searchsorted(starts, offsets))
    hashes = textops.span_hashes(data, starts, ends).view(np.int64)
    owner = np.repeat(np.arange(len(per_text)), per_text)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(hashes)))
    bounds = np.searchsorted(owner[at], np.arange(len(per_text) + 1))
    return per_text, bounds, hashes[at], counts


def probe_bits(hashes: np.ndarray) -> np.ndarray:
    """``PROBES`` 64-bit values per term hash; a signature of width B sets their low bits."""
    u = hashes.astype(np.int64).view(np.uint64)
    return np.stack([mix(u ^ seed) for seed in _PROBE_SEEDS[:PROBES]], axis=-1)


def width_of(distinct: int) -> int:
    return max(MIN_BITS, 1 << max(0, math.ceil(math.log2(max(1, distinct * BITS_PER_TERM)))))


def _block(bits: int, docs: list) -> dict:
    """One index block of documents that share a signature width."""
    d = len(docs)
    sig = np.zeros((bits, d), dtype=bool)
    hashes, tfs, starts = [], [], [0]
    for k, (_, _, own, counts) in enumerate(docs):
        sig[(probe_bits(own) & np.uint64(bits - 1)).astype(np.int64).ravel(), k] = True
        hashes.append(own)
        tfs.append(counts)
        starts.append(starts[-1] + len(own))
    return {"bits": bits, "doc_ids": [x[0] for x in docs], "ns": [x[1] for x in docs],
            "slices": np.packbits(sig, axis=1).tobytes(), "hashes": np.concatenate(hashes).tobytes(),
            "tfs": np.concatenate(tfs).astype(np.int32).tobytes(), "starts": np.array(starts, dtype=np.int64).tobytes()}


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: dict[int, list] = {}
    out: list[dict] = []

    def emit(bits):
        out.append(_block(bits, waiting.pop(bits)))

    for batch in batches:
        for piece in textops.slices(batch, "text"):
            n_terms, bounds, hashes, counts = text_terms(piece.column("text"))
            for k, doc_id in enumerate(piece.column("doc_id").to_pylist()):
                if not n_terms[k]:
                    continue
                own = hashes[bounds[k]:bounds[k + 1]].copy()  # copies, so that the slice's arrays are freed
                bits = width_of(len(own))
                docs = waiting.setdefault(bits, [])
                docs.append((doc_id, int(n_terms[k]), own, counts[bounds[k]:bounds[k + 1]].astype(np.int32)))
                if len(docs) >= max(1, min(BLOCK_DOCS, BLOCK_BITS // bits)):
                    emit(bits)
            if out:
                yield _rows(out)
                out.clear()
    for bits in list(waiting):
        emit(bits)
        yield _rows(out)
        out.clear()


def _rows(blocks: list[dict]) -> pa.RecordBatch:
    columns = {k: [b[k] for b in blocks] for k in ("bits", "doc_ids", "ns", "slices", "hashes", "tfs", "starts")}
    return pa.RecordBatch.from_pydict({
        "bits": pa.array(columns["bits"], pa.int32()), "doc_ids": pa.array(columns["doc_ids"], pa.list_(pa.int64())),
        "ns": pa.array(columns["ns"], pa.list_(pa.int64())),
        **{k: pa.array(columns[k], pa.binary()) for k in ("slices", "hashes", "tfs", "starts")}})


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The bit-sliced signature blocks of all documents that have a term, written to the shared folder."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    blocks = docs.mapInArrow(_index, INDEX_SCHEMA.replace("block long, ", ""))
    return stored(blocks.withColumn("block", F.monotonically_increasing_id()).select(
        "block", "bits", "doc_ids", "ns", "slices", "hashes", "tfs", "starts"), "search_index")


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, bounds, hashes, _ = text_terms(batch.column("text"))
        items = np.repeat(batch.column("item_id").to_numpy(zero_copy_only=False), np.diff(bounds))
        yield pa.RecordBatch.from_pydict({"item_id": pa.array(items, pa.int64()), "term_hash": pa.array(hashes, pa.int64())})


def _doc_frequencies(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            found = [np.frombuffer(h, dtype=np.int64) for h in batch.column("hashes").to_pylist()]
            hit = np.concatenate(found)[np.isin(np.concatenate(found), wanted)] if found else np.empty(0, np.int64)
            terms, counts = np.unique(hit, return_counts=True)  # a term is once in a document's sorted hashes
            yield pa.RecordBatch.from_pydict({"term_hash": pa.array(terms, pa.int64()), "df": pa.array(counts, pa.int64())})
    return run


def exact_scores(q_sorted: np.ndarray, w_sorted: np.ndarray, hashes: np.ndarray, tfs: np.ndarray, starts: np.ndarray,
                 lengths: np.ndarray, rows: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact scores of some documents of a block for one query (its term hashes sorted, with their weights)."""
    own = lengths[rows]
    offsets = np.concatenate([[0], np.cumsum(own)])
    index = np.repeat(starts[rows] - offsets[:-1], own) + np.arange(offsets[-1])
    found = hashes[index]
    at = np.minimum(np.searchsorted(q_sorted, found), len(q_sorted) - 1)
    hit = q_sorted[at] == found
    owner = np.repeat(np.arange(len(rows)), own)[hit]
    tf = tfs[index[hit]].astype(np.int64)
    part = w_sorted[at[hit]] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[rows][owner]))
    scores = np.zeros(len(rows), dtype=np.int64)
    np.add.at(scores, owner, part)
    return scores


def _search(shared, n_docs: int, n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value  # item -> (sorted hashes, weights, probe values)
        best: dict[int, tuple] = {}  # item -> (doc ids, whether null, scores) of the task's best TOP so far
        home = None  # the task's first block
        rescored = dict.fromkeys(queries, 0)
        for batch in batches:
            for k in range(batch.num_rows):
                home = batch.column("block")[k].as_py() if home is None else home
                bits = batch.column("bits")[k].as_py()
                ids = batch.column("doc_ids")[k].values
                ns = batch.column("ns")[k].values.to_numpy(zero_copy_only=False)
                d = len(ids)
                packed, hashes, tfs, starts = (
                    np.frombuffer(batch.column(c)[k].as_buffer(), dtype=t)
                    for c, t in (("slices", np.uint8), ("hashes", np.int64), ("tfs", np.int32), ("starts", np.int64)))
                packed = packed.reshape(bits, -1)
                m = 50 + (50 * ns * n_docs) // max(n_terms, 1)
                ceiling = (1_000_000_000 * ns) // (1000 * ns + 20 * m)
                id_values = ids.fill_null(0).to_numpy(zero_copy_only=False)
                id_null = ids.is_null().to_numpy(zero_copy_only=False)
                lengths = np.diff(starts)
                for item, (q_hashes, q_weights, q_probes) in queries.items():
                    places = (q_probes & np.uint64(bits - 1)).astype(np.int64)
                    bound = np.zeros(d, dtype=np.int64)
                    for at in range(0, len(places), 64):
                        present = np.unpackbits(np.bitwise_and.reduce(packed[places[at:at + 64]], axis=1), axis=1, count=d)
                        bound += q_weights[at:at + 64] @ present.astype(np.int64)
                    bound *= ceiling
                    kept = best.get(item)
                    floor = kept[2][-1] if kept is not None and len(kept[2]) == TOP else 1
                    order = np.flatnonzero(bound >= max(floor, 1))
                    order = order[np.argsort(-bound[order], kind="stable")]
                    done, size = 0, 64
                    while done < len(order):
                        chunk = order[done:done + size]
                        chunk = chunk[bound[chunk] >= floor]
                        if not len(chunk):
                            break  # bounds fall, so no later document can reach the task's best
                        done += size
                        size *= 2
                        rescored[item] += len(chunk)
                        scores = exact_scores(q_hashes, q_weights, hashes, tfs, starts, lengths, chunk, m)
                        chunk, scores = chunk[scores > 0], scores[scores > 0]
                        found = (id_values[chunk], id_null[chunk], scores)
                        if kept is not None:
                            found = tuple(np.concatenate(pair) for pair in zip(kept, found))
                        pick = np.lexsort((found[0], found[1], -found[2]))[:TOP]
                        kept = best[item] = tuple(x[pick] for x in found)
                        floor = kept[2][-1] if len(pick) == TOP else 1
        for item, (doc_ids, null, scores) in best.items():
            n = len(scores)
            yield pa.RecordBatch.from_pydict({
                "item_id": pa.array([item] * n, pa.int64()), "doc_id": pa.array(doc_ids, pa.int64(), mask=null),
                "score": pa.array(scores, pa.int64()), "block": pa.array([home] * n, pa.int64()),
                "rescored": pa.array([rescored[item]] * n, pa.int64())})
    return run


def _top(df: DataFrame, keys: list[str]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= TOP)


def search(index: DataFrame, queries: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The best ``TOP`` documents with a positive score for each query: item_id, rank, doc_id, score."""
    spark = index.sparkSession
    queries = queries.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
    totals = index.select(F.size("doc_ids").alias("d"), F.aggregate("ns", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    n_docs, n_terms, n_blocks = totals.agg(F.sum("d"), F.sum("n"), F.count(F.lit(1))).first()
    n_docs, n_terms = n_docs or 0, n_terms or 0
    wanted = stored(queries.mapInArrow(_query_terms, "item_id long, term_hash long"), "query_terms")
    distinct = wanted.select("term_hash").distinct()
    frequencies = []
    for part in _parts(distinct.count()):  # the query vocabulary in bounded groups
        group = np.array([r[0] for r in distinct.where(F.pmod("term_hash", F.lit(part[1])) == part[0]).collect()],
                         dtype=np.int64)
        shared = spark.sparkContext.broadcast(group)
        frequencies.append(index.select("hashes").mapInArrow(_doc_frequencies(shared), "term_hash long, df long"))
    df = frequencies[0]
    for more in frequencies[1:]:
        df = df.unionByName(more)
    df = df.groupBy("term_hash").agg(F.sum("df").alias("df"))
    weighted = stored(wanted.join(df, "term_hash").withColumn(
        "w", F.floor(F.lit(1000.0) * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")), "query_weights")
    n_items = weighted.select("item_id").distinct().count()
    found = []
    salts = max(1, math.isqrt(max(n_blocks, 1)))
    for part in _parts(n_items, ITEMS_PER_PASS):
        rows = weighted.where(F.pmod(F.xxhash64("item_id"), F.lit(part[1])) == part[0]).collect()
        grouped: dict[int, list] = {}
        for r in rows:
            grouped.setdefault(r["item_id"], []).append((r["term_hash"], r["w"]))
        plan = {}
        for item, pairs in grouped.items():
            hashes, weights = np.array(sorted(pairs), dtype=np.int64).T.copy()
            plan[item] = (hashes, weights, probe_bits(hashes))
        shared = spark.sparkContext.broadcast(plan)
        local = index.mapInArrow(_search(shared, n_docs, n_terms),
                                 "item_id long, doc_id long, score long, block long, rescored long")
        found.append(local)
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    grouped_best = _top(best.withColumn("salt", F.pmod("block", F.lit(salts))), ["item_id", "salt"]).drop("rank")
    return _top(grouped_best, ["item_id"]).select("item_id", "rank", "doc_id", "score")


def _parts(n: int, size: int = 1_000_000) -> list[tuple[int, int]]:
    """(remainder, modulus) pairs that cut ``n`` things into groups of about ``size``."""
    k = max(1, math.ceil(n / size))
    return [(r, k) for r in range(k)]


def rank(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """Index ``docs`` and search it with every row of ``queries`` (item_id, text)."""
    return search(build_index(docs), queries)
