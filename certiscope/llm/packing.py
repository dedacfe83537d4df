"""Packing documents into fixed windows whose sources keep given proportions.

Method
    Every source is a queue of tokens. A window of ``WINDOW`` tokens is filled by deficit round-robin: each
    source is credited its share of the window, is served as many whole tokens as its credit allows, and
    carries the rest, the deficit, to the next window; the tokens that rounding leaves over go to the largest
    deficits. Documents are cut wherever a source's turn ends. The target proportions are those of the
    corpus, which is what lets every window keep them while every token is packed.

Scale
    The queues are cut at the same fraction everywhere: block p of P takes the tokens from floor(n p / P) to
    floor(n (p + 1) / P) of a source with n tokens, so every block has the target proportions and the
    rounding carries over from block to block exactly. Blocks hold about ``BLOCK_TOKENS`` tokens, however
    large a source is. Texts are tokenized once and stored; a document's place in its queue comes from sums by
    input part and source and a running count inside the part, so nothing is sorted. Tokens move once, to
    their blocks. What is left of a block's last window is laid into sequences whose lengths are powers of
    two, which need no padding.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from certiscope.llm import textops
from certiscope.session import stored

WINDOW = 2048
END_ID = 1
BLOCK_TOKENS = 1 << 20
MEMO_PIECES = 300_000
LONG_PIECE = 200

#: Lower-case letters of Latin-1; together with ASCII and their capitals, NFC leaves them as they are.
_LATIN = "ß-öø-ÿ"
_PLAIN = bytes([*range(128), *(c for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))])
_SPLIT = re.compile(r"[^ \t\n\r]+")
_loaded: dict[str, Words] = {}


def _piece_rule(rules: dict) -> re.Pattern | None:
    """The tokenizer file's own splitting pattern for ASCII and Latin-1 letters in lower case.

    None unless the file is a byte-level model that lower-cases and keeps the matches of a single pattern.
    """
    normal, split = rules.get("normalizer") or {}, rules.get("pre_tokenizer") or {}
    lowers = any(n.get("type") == "Lowercase" for n in normal.get("normalizers", [normal]))
    steps = split.get("pretokenizers", [split])
    if not lowers or [p.get("type") for p in steps] != ["Split", "ByteLevel"] or steps[1].get("add_prefix_space") or steps[1].get("use_regex"):
        return None
    if steps[0]["behavior"] != "Removed" or not steps[0]["invert"]:
        return None
    pattern = steps[0]["pattern"].get("Regex", "")
    letters = f"a-z{_LATIN}"
    for unicode_class, own_class in (("[\\p{L}]", f"[{letters}]"), ("[\\p{N}]", "[0-9]"), ("\\p{L}", letters), ("\\p{N}", "0-9")):
        pattern = pattern.replace(unicode_class, own_class)
    return re.compile(pattern, re.ASCII) if pattern and "\\p" not in pattern else None


def is_plain(text: str) -> bool:
    """Whether a text has no characters but ASCII and Latin-1 letters."""
    try:
        return text.isascii() or not text.encode("latin-1").translate(None, _PLAIN)
    except UnicodeEncodeError:
        return False


class Memory(dict):
    """A bounded memory of a function; long arguments are not kept."""

    def __init__(self, function: Callable[[str], bytes]):
        super().__init__()
        self.function = function

    def __missing__(self, key: str) -> bytes:
        value = self.function(key)
        if len(key) <= LONG_PIECE:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[key] = value
        return value


class Words:
    """Ids of texts by a tokenizer file, with a bounded memory of the pieces that they consist of.

    Texts of ASCII and Latin-1 letters are cut into pieces by the file's own pattern, and the file's model
    gives each new piece its ids. Other texts are taken word by word: words with other characters go to the
    tokenizer as they are. A text that holds one of the file's added tokens goes there as a whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(Path(path).read_text())
        self.rule = _piece_rule(rules)
        self.added = [t["content"] for t in rules.get("added_tokens", [])]
        self.model = self.tokenizer.model
        if self.rule is not None:  # a character as the model sees it: its bytes, each written as one character
            written = self.tokenizer.pre_tokenizer.pre_tokenize_str
            plain = [c for c in _PLAIN.decode("latin-1") if self.rule.fullmatch(c)]
            self.letters = {ord(c): "".join(w for w, _ in written(c)) for c in plain}
        self.pieces = Memory(self.piece_ids)
        self.words = Memory(self.word_ids)

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()

    def piece_ids(self, piece: str) -> bytes:
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(piece.translate(self.letters))])

    def word_ids(self, word: str) -> bytes:
        return self.joined(word) if self.rule is not None and is_plain(word) else self.ids(word)

    def joined(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.rule.findall(text.lower())))

    def encode(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return self.ids(text)
        if self.rule is not None and is_plain(text):
            return self.joined(text)
        return b"".join(map(self.words.__getitem__, _SPLIT.findall(text)))


def word_tokenizer(path: str) -> Callable[[str], bytes]:
    """Ids of a text by a tokenizer file whose pieces never reach across white space.

    The tokenizer drops the white space itself, so the ids of the words between blanks, tabs and line ends are
    those of the whole text.
    """
    if path not in _loaded:
        _loaded[path] = Words(path)
    return _loaded[path].encode


def _tokenized(path: str):
    """Adds the ids and the place of each document's first token within the part's tokens of its source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokenizer(path)
        part_no, seen = TaskContext.get().partitionId(), {}
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            for part in textops.slices(batch, "text"):
                sources = part.column("source").to_pylist()
                ids, before = [], []
                for source, text in zip(sources, part.column("text").to_pylist(), strict=True):
                    own = encode(text or "") + end
                    ids.append(own)
                    before.append(seen.get(source, 0))
                    seen[source] = before[-1] + len(own) // 4
                n = len(ids)
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "source": part.column("source"), "part": pa.array([part_no] * n, pa.int32()),
                    "before": pa.array(before, pa.int64()), "doc_tokens": pa.array([len(b) // 4 for b in ids], pa.int64()),
                    "ids": pa.array([_narrow(b) for b in ids], pa.binary())})

    return run


def _narrow(ids: bytes) -> bytes:
    """Two bytes an id where they suffice, after a byte that tells which."""
    wide = np.frombuffer(ids, dtype="<u4")
    return b"2" + wide.astype("<u2").tobytes() if wide.max() < 65536 else b"4" + ids


def _wide(ids: bytes, start: int, stop: int) -> np.ndarray:
    width = ids[0] - 48
    return np.frombuffer(ids, dtype=f"<u{width}", count=stop - start, offset=1 + start * width).astype("<u4")


def _into_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts each document at the borders of the blocks."""
    for batch in batches:
        for at_row in range(0, batch.num_rows, 1000):
            part, out = batch.slice(at_row, 1000), []
            for doc, source, at, n, total, blocks, ids in zip(
                    *(part.column(c).to_pylist() for c in ("doc_id", "source", "at", "doc_tokens", "total", "blocks", "ids")), strict=True):
                block, start, width = at * blocks // total, 0, ids[0] - 48
                while start < n:
                    border = total * (block + 1) // blocks
                    if border <= at + start:
                        block += 1
                        continue
                    stop = min(n, border - at)
                    out.append((block, source, at + start, doc, start, n, ids[:1] + ids[1 + start * width:1 + stop * width]))
                    start = stop
            if out:
                block, source, at, doc, start, n, ids = zip(*out, strict=True)
                yield pa.record_batch({
                    "block": pa.array(block, pa.int64()), "source": pa.array(source, pa.string()), "at": pa.array(at, pa.int64()),
                    "doc_id": pa.array(doc, pa.int64()), "start": pa.array(start, pa.int64()),
                    "doc_tokens": pa.array(n, pa.int64()), "ids": pa.array(ids, pa.binary())})


def round_robin(lengths: np.ndarray, window: int = WINDOW) -> Iterator[np.ndarray]:
    """How many tokens each source gives to each window, given what its queue holds.

    Full windows follow the proportions of ``lengths``; what is left at the end goes to windows whose lengths
    are falling powers of two.
    """
    left = lengths.astype(np.int64)
    share = left / max(1, left.sum())
    deficit = np.zeros(len(left))
    while (rest := int(left.sum())) > 0:
        size = window if rest >= window else 1 << (rest.bit_length() - 1)
        deficit += share * size
        turn = np.minimum(np.maximum(np.floor(deficit), 0).astype(np.int64), left)
        while (over := int(turn.sum()) - size) > 0:
            k = int(np.argmin(np.where(turn > 0, deficit - turn, np.inf)))
            turn[k] -= min(over, turn[k])
        while (short := size - int(turn.sum())) > 0:
            room = left - turn
            order = np.argsort(turn - deficit, kind="stable")
            order = order[room[order] > 0][:short]
            turn[order] += 1
        deficit -= turn
        left -= turn
        yield turn


def _packed(window: int):
    def pieces(block: int, rows: list[tuple]) -> pa.RecordBatch:
        queues: dict = {}
        for row in sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[2])):
            queues.setdefault(row[1], []).append(row)
        queues = list(queues.values())
        totals = np.array([sum((len(r[6]) - 1) // (r[6][0] - 48) for r in q) for q in queues])
        head, done, out = [0] * len(queues), [0] * len(queues), []
        for k, turn in enumerate(round_robin(totals, window)):
            offset = 0
            for s in np.flatnonzero(turn):
                wanted = int(turn[s])
                while wanted:
                    _, _, _, doc, start, n, ids = queues[s][head[s]]
                    own = (len(ids) - 1) // (ids[0] - 48)
                    stop = min(own, done[s] + wanted)
                    part = _wide(ids, done[s], stop)
                    out.append((doc, start + done[s], stop - done[s], zlib.crc32(part.tobytes()), n, (block << 21) + k, offset))
                    offset += len(part)
                    wanted -= len(part)
                    done[s] = stop
                    if stop == own:
                        head[s] += 1
                        done[s] = 0
        return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=_PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = [], None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("block", "source", "at", "doc_id", "start", "doc_tokens", "ids")), strict=True):
                if row[0] != block and held:
                    yield pieces(block, held)
                    held = []
                block = row[0]
                held.append(row)
        if held:
            yield pieces(block, held)

    return run


_PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, block_tokens: int = BLOCK_TOKENS,
         doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    A document is its ids by the tokenizer file and then ``END_ID``; a null or empty text has only the latter.
    Rows without a source form a queue of their own. Repeated rows are packed each; a row without an id keeps
    a null doc_id. Each id lies in exactly one piece, and a sequence is either full or as long as a power of
    two. Other columns are not read.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))
    tokens = stored(docs.mapInArrow(
        _tokenized(tokenizer), "doc_id long, source string, part int, before long, doc_tokens long, ids binary"), "tokens")
    sums = tokens.groupBy("source", "part").agg(F.sum("doc_tokens").alias("tokens"))
    in_order = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = sums.groupBy("source").agg(F.sum("tokens").alias("total"))
    bases = stored(sums.withColumn("base", F.coalesce(F.sum("tokens").over(in_order), F.lit(0))).join(
        totals.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("source").alias("of"), F.col("part").alias("of_part"), "base", "total"), "queue-places")
    corpus = tokens.agg(F.sum("doc_tokens")).first()[0] or 0
    blocks = max(1, -(-corpus // block_tokens))
    placed = tokens.join(bases, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))).select(
        "doc_id", "source", (F.col("base") + F.col("before")).alias("at"), "doc_tokens", "total", F.lit(blocks).cast("long").alias("blocks"), "ids")
    cut = placed.mapInArrow(_into_blocks, "block long, source string, at long, doc_id long, start long, doc_tokens long, ids binary")
    return cut.repartition("block").sortWithinPartitions("block").mapInArrow(
        _packed(window), ", ".join(f"{c} long" for c in _PIECE))
