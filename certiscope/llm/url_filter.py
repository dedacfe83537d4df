"""Judging urls by rules with a cascade of Bloom filters.

Method
    Listed keys and the corpus's keys make a closed universe. Level 0 encodes the listed keys; level 1 the
    unlisted keys of the universe that level 0 lets through by mistake; level 2 the listed keys that level 1
    catches by mistake; and so on until no mistake is left. A key's first level that misses it decides: so
    membership is exact for every key of the universe, from a few bits a listed key, without a join.

Scale
    Building works on the distinct keys of the corpus and shuffles only them. Bits are set by a native bitmap
    aggregate. Judging is one narrow pass over the pages: the levels are broadcast, and their size is known
    from counts before they are collected; ``MAX_BYTES`` bounds it. A longer list is split into as many parts
    by key hash as the bound asks for, each with a cascade and a pass of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certiscope.llm.textops import mix
from certiscope.session import stored

MAX_BYTES = 64 << 20
MAX_LEVELS = 64
_BITMAP = 32768


@dataclass(frozen=True)
class Level:
    """One Bloom filter; ``body`` holds its bits, eight to a byte."""

    body: np.ndarray
    bits: int
    hashes: int

    def places(self, h1: np.ndarray, h2: np.ndarray, depth: int, k: int) -> np.ndarray:
        seed = np.uint64((depth * 64 + k) * 0x9E3779B97F4A7C15 % 2**64)
        return mix(mix(h1 + seed) ^ h2) % np.uint64(self.bits)

    def passes(self, h1: np.ndarray, h2: np.ndarray, depth: int) -> np.ndarray:
        found = np.ones(len(h1), dtype=bool)
        for k in range(self.hashes):
            at = self.places(h1, h2, depth, k)
            found &= (self.body[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


def members(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Exact membership of keys of the universe: the parity of the first level that misses a key."""
    member, open_ = np.zeros(len(h1), dtype=bool), np.arange(len(h1))
    for depth, level in enumerate(levels):
        passed = level.passes(h1[open_], h2[open_], depth)
        member[open_[~passed]] = depth % 2 == 1
        open_ = open_[passed]
    member[open_] = len(levels) % 2 == 1
    return member


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """All rules that could fit, longest first: the host's last labels with the path's starts, of the given sizes.

    A rule is written as its host and its path; a host fits its subdomains.
    """
    counts = F.filter(F.array(*[F.lit(n) for n in labels]), lambda n: n <= F.size(F.split(host, r"\.")))
    hosts = F.transform(counts, lambda n: F.call_function("substring_index", host, F.lit("."), -n))
    starts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(starts, lambda n: F.concat(h, F.substring(path, F.lit(1), n)))))
    longest = F.array_sort(keys, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a))
                           .when(a < b, -1).when(a > b, 1).otherwise(0))
    return F.when(host != "", longest).otherwise(F.array().cast("array<string>"))


def _hashed(df: DataFrame) -> DataFrame:
    return df.select("key", F.xxhash64("key", F.lit(1)).alias("h1"), F.xxhash64("key", F.lit(2)).alias("h2"))


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _shape(n: int, rate: float) -> tuple[int, int]:
    """(bits, hash functions) of a filter for n keys."""
    bits = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
    return -(-bits // 64) * 64, max(1, round(-math.log2(rate)))


def _encode(keys: DataFrame, n: int, rate: float, depth: int) -> Level:
    """A filter of the keys. Bits are set on the executors; only its ``bits / 8`` bytes come to the driver."""
    bits, hashes = _shape(n, rate)
    level = Level(np.zeros(-(-bits // _BITMAP) * (_BITMAP // 8), dtype=np.uint8), bits, hashes)
    blank = Level(np.zeros(0, dtype=np.uint8), bits, hashes)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = _numbers(batch.column("h1")), _numbers(batch.column("h2"))
            at = np.concatenate([blank.places(h1, h2, depth, k) for k in range(hashes)]).astype(np.int64)
            yield pa.record_batch({"part": pa.array(at // _BITMAP), "at": pa.array(at % _BITMAP)})

    maps = keys.mapInArrow(places, "part long, at long").groupBy("part").agg(F.bitmap_construct_agg("at").alias("map"))
    for row in maps.collect():
        start = row["part"] * (_BITMAP // 8)
        level.body[start:start + _BITMAP // 8] |= np.frombuffer(row["map"], dtype=np.uint8)
    return level


def _passing(keys: DataFrame, level: Level, depth: int) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.passes(_numbers(batch.column("h1")), _numbers(batch.column("h2")), depth)))

    return keys.mapInArrow(run, "key string, h1 long, h2 long")


def build_cascade(listed: DataFrame, others: DataFrame) -> list[Level]:
    """Levels that tell the listed keys from the others exactly; both have the columns key, h1 and h2."""
    here, there = listed, others
    n, m = here.count(), there.count()
    levels = []
    rate = min(0.5, max(2.0**-20, math.sqrt(0.5) * n / max(m, 1)))
    while n:
        if len(levels) == MAX_LEVELS:
            raise ValueError("a listed and an unlisted key share all hash values")
        level = _encode(here, n, rate, len(levels))
        there = stored(_passing(there, level, len(levels)), "passing")
        levels.append(level)
        here, there, n, rate = there, here, there.count(), 0.5
    return levels


def cascades(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> list[tuple[int, int, list[Level]]]:
    """(part, parts, levels): one cascade, or as many as keep each below ``max_bytes``.

    ``listed`` and ``universe`` have a column ``key``; keys that are null are left out.
    """
    listed = stored(_hashed(listed.where("key IS NOT NULL").distinct()), "listed")
    others = stored(_hashed(universe.join(listed, "key", "left_anti")), "unlisted")
    n, m = listed.count(), others.count()
    # level 0 takes 1.44 log2(1 / rate) bits a key, all others together less than 8 bits a key
    rate = min(0.5, max(2.0**-20, math.sqrt(0.5) * n / max(m, 1)))
    parts = max(1, math.ceil(n * (1.45 * -math.log2(rate) + 8) / 8 / max_bytes))
    mine = F.pmod("h1", F.lit(parts))
    return [(part, parts, build_cascade(listed.where(mine == part), others.where(mine == part))) for part in range(parts)]


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", page_id: str = "page_id", url: str = "url",
          max_bytes: int = MAX_BYTES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``.

    ``rules`` has the columns host, path and verdict. A rule fits its host and all subdomains when the url's
    path starts with the rule's; the longest rule wins, which gives its own text and verdict. Equal rules of
    both verdicts block. Without a rule, ``rule`` is null and the verdict is ``default``. A null url, or one
    without ``://``, has an empty host and path and no rule. Repeated rows are judged each; other columns are
    not read.
    """
    rules = stored(rules.select(F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host != ''"), "rules")
    sizes = rules.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()
    host, path = host_of(F.col(url)), path_of(F.col(url))
    asked = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path")).withColumn(
        "keys", rule_keys(F.col("host"), F.col("path"), sorted(sizes["labels"]), sorted(sizes["lengths"])))
    universe = stored(asked.select(F.explode("keys").alias("key")).distinct(), "universe")
    hashes = [F.transform("keys", lambda k: F.xxhash64(k, F.lit(1))), F.transform("keys", lambda k: F.xxhash64(k, F.lit(2)))]
    hits = {}
    for verdict in ("allow", "block"):
        keys = rules.where(F.col("verdict") == verdict).select(F.concat("host", "path").alias("key"))
        best = [_first_member(*hashes, part, parts, levels, pages.sparkSession)
                for part, parts, levels in cascades(keys, universe, max_bytes) if levels]
        hits[verdict] = F.least(*best, F.lit(_NONE)) if best else F.lit(_NONE)
    judged = asked.withColumns({"allow_at": hits["allow"], "block_at": hits["block"]})
    at = F.least("allow_at", "block_at")
    return judged.select(
        "page_id", "host", "path", F.when(at < _NONE, F.get("keys", at)).alias("rule"),
        F.when(at == _NONE, default).when(F.col("block_at") == at, "block").otherwise("allow").alias("verdict"))


_NONE = 2**31 - 1


def _first_member(h1: Column, h2: Column, part: int, parts: int, levels: list[Level], spark) -> Column:
    """The place of a page's first listed key, or ``_NONE``."""
    shared = spark.sparkContext.broadcast(levels)

    @F.arrow_udf("int")
    def first(h1: pa.Array, h2: pa.Array) -> pa.Array:
        sizes = h1.value_lengths().fill_null(0).to_numpy()
        a, b = _numbers(h1.flatten()), _numbers(h2.flatten())
        mine = np.flatnonzero((a.view(np.int64) % parts) == part)
        member = np.zeros(len(a), dtype=bool)
        member[mine] = members(shared.value, a[mine], b[mine])
        at = np.flatnonzero(member)
        owner = np.repeat(np.arange(len(sizes)), sizes)[at]
        starts = np.cumsum(sizes) - sizes
        out = np.full(len(sizes), _NONE, dtype=np.int32)
        out[owner[::-1]] = (at - starts[owner])[::-1]
        return pa.array(out)

    return first(h1, h2)
