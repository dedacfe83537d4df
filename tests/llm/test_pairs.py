import random
import re

import numpy as np
import pytest

from certiscope.llm import minhash, textops

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text):
    words = WORD.findall((text or "").translate(SMALL))
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows, percent):
    """Components by comparing all texts."""
    sets = {}
    for i, text in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingle_set(text))
    ids = sorted(sets)
    comp = {i: i for i in ids}
    for x in ids:
        for y in ids:
            if x < y and any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[x] for b in sets[y]) and comp[x] != comp[y]:
                old, new = max(comp[x], comp[y]), min(comp[x], comp[y])
                comp = {i: new if c == old else c for i, c in comp.items()}
    return comp


def check(df, percent):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = brute(rows, percent)
    got = minhash.near_duplicates(df, percent).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])
    sizes = sorted((-1 if i is None else i, len(shingle_set(t))) for i, t in rows)
    assert sizes == sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_shingles"]) for r in got)


def test_odd_rows(docs):
    check(docs, 80)


@pytest.mark.parametrize("percent", [80, 85])
def test_chains_and_groups(spark, percent, monkeypatch):
    """Copies of copies: few pairs are links, all are candidates; small slices force the searches across blocks."""
    monkeypatch.setattr(minhash, "SLICE", 8)
    rng = random.Random(5)
    texts = [[f"base{k}" for k in range(150)]]
    for _ in range(70):
        words = list(rng.choice(texts))
        for _ in range(rng.choice([1, 1, 2, 3])):
            words[rng.randrange(150)] = f"new{rng.random()}"
        texts.append(words)
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(k, " ".join(texts[o])) for k, o in enumerate(order)] + [(1000 + k, " ".join(texts[0])) for k in range(30)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), percent)


def test_empty(empty):
    assert minhash.near_duplicates(empty).collect() == []


def test_sketches_estimate_and_parities_bound():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**64, 300, dtype=np.uint64)
    b = np.concatenate([a[:200], rng.integers(0, 2**64, 100, dtype=np.uint64)])
    sets = [np.unique(a), np.unique(b), a[:3]]
    sketch = minhash.fill_bins(np.concatenate(sets), np.repeat([0, 1, 2], [300, 300, 3]), 3, 180)
    assert (sketch != 2**64 - 1).all()
    assert abs((sketch[0] == sketch[1]).mean() - 0.5) < 0.15
    bits = minhash.parities(sets)
    assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= 200


def test_words_are_bytes_between_blanks():
    import pyarrow as pa

    texts = ["a bc\td", "", None, "é\u00a0é x\x0by", "  "]
    data, offsets = textops.utf8(pa.array(texts))
    starts, ends, bounds = textops.words(data, offsets)
    found = [[bytes(data[s:e]).decode() for s, e in zip(starts[i:j], ends[i:j])] for i, j in zip(bounds[:-1], bounds[1:])]
    assert found == [WORD.findall(t or "") for t in texts]
