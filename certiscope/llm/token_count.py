"""Token counts by a unigram vocabulary without making the tokens.

Method
    An Aho-Corasick automaton of the vocabulary's pieces lists all pieces that end at each position. Dynamic
    programming carries, for each position, the best score of a segmentation that ends there and its number of
    pieces, and nothing else. Ties follow the tokenizer: among equal scores the piece that starts first stays.
    A character that is no piece of its own can be skipped at ``UNKNOWN_COST`` below the lowest score; it counts
    as its bytes where the vocabulary has byte pieces, otherwise a run of such characters counts as one.

    Blanks become U+2581 and one is put in front, as the vocabulary's own tokenizer does. No piece has that mark
    behind another character (checked on loading), so no piece reaches over the end of a word: words are
    solved one by one, and what was found for a word is remembered, up to ``MEMO_WORDS`` words.

Scale
    One narrow pass over the texts. Memory is bounded: the programme keeps as many positions as the longest
    piece has characters, however long a word is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certiscope.llm import textops

MARK = "▁"
UNKNOWN_COST = 10.0
MEMO_WORDS = 300_000
LONG_WORD = 200
_WORDS = re.compile(f"{MARK}+[^{MARK}]*")


class Vocabulary:
    """Pieces with scores, and whether unknown characters fall back to bytes."""

    def __init__(self, pieces: dict[str, float], byte_fallback: bool):
        import ahocorasick

        pieces = {p: s for p, s in pieces.items() if p}
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece reaches over the end of a word")
        self.byte_fallback, self.longest = byte_fallback, max(map(len, pieces), default=1)
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_COST
        self.single = {p for p in pieces if len(p) == 1}
        self.machine = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.machine.add_word(piece, (len(piece), score))
        self.machine.make_automaton()
        self.memo: dict[str, int] = {}

    @classmethod
    def from_model(cls, path: str) -> Vocabulary:
        """The ordinary pieces of a SentencePiece model file, taken as a unigram vocabulary."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        return cls({model.id_to_piece(i): model.get_score(i) for i in plain}, any(model.is_byte(i) for i in ids))

    def best(self, word: str) -> tuple[float, int]:
        """Score and number of pieces of the best segmentation."""
        size = self.longest + 1
        score, count, run = [0.0] * size, [0] * size, [False] * size
        ends = {} if not self.machine.kind else self.machine.iter(word)
        ends, ahead = iter(ends), None
        for at, char in enumerate(word):
            new_score, new_count, new_run = None, 0, False
            found = []
            while True:
                if ahead is None:
                    ahead = next(ends, (len(word), None))
                if ahead[0] != at:
                    break
                found.append(ahead[1])
                ahead = None
            found.sort(reverse=True)  # longest first: the one that starts first
            for length, value in found:
                k = (at + 1 - length) % size
                if new_score is None or score[k] + value > new_score:
                    new_score, new_count = score[k] + value, count[k] + 1
            if char not in self.single:
                k = at % size
                if new_score is None or score[k] + self.unknown > new_score:
                    cost = len(char.encode("utf-8", "surrogatepass")) if self.byte_fallback else 0 if run[k] else 1
                    new_score, new_count, new_run = score[k] + self.unknown, count[k] + cost, True
            k = (at + 1) % size
            score[k], count[k], run[k] = new_score, new_count, new_run
        k = len(word) % size
        return score[k], count[k]

    def count(self, text: str) -> int:
        """Pieces of a whole text."""
        if not text:
            return 0
        memo, total = self.memo, 0
        for word in _WORDS.findall(MARK + text.replace(" ", MARK)):
            n = memo.get(word)
            if n is None:
                n = self.best(word)[1]
                if len(word) <= LONG_WORD:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[word] = n
            total += n
        return total


_loaded: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary.from_model(path)
    return _loaded[path]


def count_tokens(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars and n_tokens for every row of ``docs``.

    ``model`` is the path of a SentencePiece file that every executor can read. A null or empty text has no
    tokens. Repeated rows are counted each; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _vocabulary(model)
        for batch in batches:
            for part in textops.slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                yield pa.record_batch({"doc_id": part.column("doc_id"), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                                       "n_tokens": pa.array([words.count(t) for t in texts], pa.int64())})

    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return docs.mapInArrow(run, "doc_id long, n_chars long, n_tokens long")
