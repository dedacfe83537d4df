import re
from collections import Counter

import numpy as np
import pandas as pd

from certiscope.llm import collocations


def plain(rows, threshold=10, top=2000):
    """The rule written out with Python strings and integers."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            for size in (1, 2, 3):
                for i in range(len(w) - size + 1):
                    f[lang, " ".join(w[i:i + size])] += 1
    cands = {k: a for k, a in f.items() if len(k[1].split(" ")) >= 2 and a >= threshold}
    out = []
    for (lang, phrase), a in cands.items():
        w = phrase.split(" ")
        if len(w) == 2 and any(len(q.split(" ")) == 3 and ql == lang and (q.split(" ")[:2] == w or q.split(" ")[1:] == w)
                               and 100 * fa >= 50 * a for (ql, q), fa in cands.items()):
            continue
        cuts = [((10**6 * a * a) // (f[lang, " ".join(w[:k])] * f[lang, " ".join(w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, phrase, a, f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])], n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(mine[:top])]
    return sorted(ranked, key=repr)


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 AS g", "2 AS code", "3 AS part", "4 AS phrase")
    return sorted((tuple(r) for r in collocations.collocations(df, **kw).collect()), key=repr)


def test_against_plain(spark):
    rows = [("en", "New York is big. new york city, NEW YORK CITY!\tthe big apple"), (None, "kind regards; kind regards")] * 12
    rows += [("fr", "le chat noir " * 30), ("fr", None), ("de", ""), ("en", "x" * 50_000), ("en", "Über straße über straße. " * 11)]
    rows += [("en", f"tie{k} word{k} " * 10) for k in range(5)]
    old = (collocations.PART_BYTES, collocations.BLOCK_KEYS, collocations.HELD_KEYS)
    collocations.PART_BYTES, collocations.BLOCK_KEYS, collocations.HELD_KEYS = 50, 7, 5  # many parts, blocks, hand-ons
    try:
        assert got(spark, rows) == plain(rows)
        assert got(spark, rows, top=3) == plain(rows, top=3)
    finally:
        collocations.PART_BYTES, collocations.BLOCK_KEYS, collocations.HELD_KEYS = old


def test_empty(spark):
    assert got(spark, []) == []


def test_summary_keeps_every_frequent_phrase(spark):
    """Mass 10,000 over 4,000 counters: the capacity is 1,001, and every counter of at least 10 survives."""
    rng = np.random.default_rng(5)
    counts = np.concatenate([np.full(300, 10), rng.integers(1, 3, 3700)])
    frame = pd.DataFrame({"code": 0, "part": 0, "g": np.arange(len(counts)), "c": counts})
    kept = {r["g"] for r in collocations.summary_survivors(spark.createDataFrame(frame), 10).collect()}
    assert kept == set(np.flatnonzero(counts >= 10).tolist())


def test_counters_travel_as_one_row_a_part():
    """The first pass gives a row of bytes a partition, not a row a phrase."""
    import pyarrow as pa
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3000, 500)) for _ in range(60)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 60, "text": texts})
    out = list(collocations._first_pass({"en": (0, 7)})(iter([batch])))
    assert sum(b.num_rows for b in out) <= 7
    counts = np.concatenate([np.frombuffer(x, dtype="<i8") for b in out for x in b.column("counts").to_pylist()])
    assert counts.sum() == 60 * (500 + 499 + 498)
    assert len(counts) > 50_000


def test_equal_first_hashes_are_told_apart():
    """Two phrases on one place: the second one's rows come back instead of being added to the first."""
    import pyarrow as pa
    exact = collocations._Exact(np.array([5, 9], dtype=np.uint64))
    second = np.array([1, 2, 1, 7], dtype=np.uint64)
    other = exact.add(2, np.array([0, 0, 0, 1]), second, lambda k: pa.array([f"t{x}" for x in k]))
    assert other.tolist() == [1]
    assert exact.add(3, np.array([0]), np.array([1], dtype=np.uint64), None).tolist() == [0]
    rows = [r for b in exact.rows("en") for r in b.to_pylist()]
    assert [(r["g"], r["g2"], r["words"], r["phrase"], r["f"]) for r in rows] == [(5, 1, 2, "t0", 2), (9, 7, 2, "t3", 1)]
