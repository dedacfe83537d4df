"""Language of a text by multinomial naive Bayes over hashed character n-grams.

Method
    Lower-cased texts are cut into all runs of 1 to ``MAX_GRAM`` code points, with the text's borders as a
    character of their own, and hashed to ``2 ** BITS`` features. A language is the smoothed distribution of
    the features over its training texts together with its share of them. A text goes to the language with the
    largest posterior; the matrix of log probabilities (``2 ** BITS`` rows, one column a language) is
    broadcast and looked up in numpy for all grams of many texts at once.

Scale
    Training takes a bounded sample of the labelled rows: about ``train_docs`` of each language, picked by a
    hash of the id. Features are summed per task before they are shuffled. The matrix has a fixed number of
    rows, and ``MAX_LANGS`` bounds its columns. Prediction is one narrow pass over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certiscope.llm import textops

BITS = 16
MAX_GRAM = 3
TRAIN_DOCS = 5_000
MAX_LANGS = 200
UNKNOWN = "und"
_CHARS = 1 << 18
_TURNS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, text of each feature in rising order) in pieces of bounded size; border characters keep texts apart."""
    block, owner, size = [], [], 0
    for k, text in enumerate(texts):
        for start in range(0, max(1, len(text)), _CHARS):
            tail = text[max(0, start - MAX_GRAM + 1):start].lower()  # counted with the piece before
            body = ("" if start else "\0\0") + tail + text[start:start + _CHARS].lower() + ("\0\0" if start + _CHARS >= len(text) else "")
            block.append(body)
            owner.append((k, len(body), len(tail)))
            size += len(body)
            if size >= _CHARS:
                yield from _features(block, owner)
                block, owner, size = [], [], 0
    if block:
        yield from _features(block, owner)


def _features(block: list[str], owner: list[tuple[int, int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    codes = np.frombuffer("".join(block).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    text, size, tail = np.array(owner).T
    piece = np.repeat(np.arange(len(owner)), size)
    fresh = np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size) >= np.repeat(tail, size)
    total = np.zeros(len(codes), dtype=np.uint64)
    for n in range(min(MAX_GRAM, len(codes))):
        first, last = slice(0, len(codes) - n), slice(n, None)
        total = total[first] + (codes[last] + np.uint64(1)) * _TURNS[n]
        ok = (piece[last] == piece[first]) & fresh[last] & ~((codes[first] == 0) & (codes[last] == 0))
        yield (textops.mix(total[ok]) >> np.uint64(64 - BITS)).astype(np.int64), text[piece[first][ok]]


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages in order, log priors, log probabilities by feature and language).

    ``docs`` has doc_id, text and lang; rows without a text or a language are not used.
    """
    docs = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().limit(MAX_LANGS + 1).collect()}
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros(0), np.zeros((1 << BITS, 0), dtype=np.float32)
    share = F.element_at(F.create_map(*[x for la in langs for x in (F.lit(la), F.lit(min(1.0, train_docs / sizes[la])))]), F.col("lang"))
    picked = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < share * F.lit(1 << 30)).select("text", "lang")
    codes = {la: k for k, la in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(codes), 1 << BITS), dtype=np.int64)
        for batch in batches:
            for part in textops.slices(batch, "text"):
                lang = np.array([codes[la] for la in part.column("lang").to_pylist()], dtype=np.int64)
                for feature, text in grams(part.column("text").to_pylist()):
                    sums += np.bincount(lang[text] << BITS | feature, minlength=sums.size).reshape(sums.shape)
        lang, feature = np.nonzero(sums)
        yield pa.record_batch({"lang": pa.array(lang), "feature": pa.array(feature), "n": pa.array(sums[lang, feature])})

    counts = np.ones((1 << BITS, len(langs)))
    rows = picked.mapInArrow(count, "lang long, feature long, n long").groupBy("feature", "lang").agg(F.sum("n").alias("n"))
    table = rows.toArrow()  # at most 2 ** BITS rows a language
    counts[table["feature"].to_numpy(), table["lang"].to_numpy()] += table["n"].to_numpy()
    total = sum(sizes.values())
    return langs, np.log([sizes[la] / total for la in langs]), np.log(counts / counts.sum(axis=0)).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score, the posterior of the language.

    A text that is null or has no letter gets ``und`` and score 0; so does every text without a language to
    choose from. Equal posteriors go to the first language in order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, prior, weights = shared.value
        names = np.array([*langs, UNKNOWN], dtype=object)
        for batch in batches:
            for part in textops.slices(batch, "_text"):
                texts = [t or "" for t in part.column("_text").to_pylist()]
                best, score = np.full(len(texts), len(langs)), np.zeros(len(texts))
                lettered = np.array([next(filter(str.isalpha, t), None) is not None for t in texts])
                if langs and lettered.any():
                    sums = np.zeros((len(texts), len(langs)))
                    for feature, text in grams(texts):
                        first = np.flatnonzero(np.concatenate([[len(text) > 0], text[1:] != text[:-1]]))
                        if len(first):
                            sums[text[first]] += np.add.reduceat(weights[feature], first, axis=0, dtype=np.float64)
                    sums += prior
                    top = sums.max(axis=1)
                    best = np.where(lettered, sums.argmax(axis=1), best)
                    score = np.where(lettered, 1 / np.exp(sums - top[:, None]).sum(axis=1), 0.0)
                yield pa.record_batch([*part.columns[:-1], pa.array(names[best], pa.string()), pa.array(score)],
                                      names=[*part.schema.names[:-1], "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, f"{fields}, lang_pred string, score double")


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id, written as text, leaves 2 when divided by 4; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, train_docs: int = TRAIN_DOCS, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of ``docs``.

    The model learns from the labelled rows that are not held out and judges all rows by their text alone.
    Repeated rows are judged each; a row without an id is not held out. Other columns are not read.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    model = train(docs.where(~held_out()), train_docs)
    return predict(docs.withColumn("held_out", held_out()), model, ["doc_id", "held_out"])
