import math
from collections import Counter

from certiscope.llm import lexical_search


def plain(docs, items, top=50):
    """The score written out over all documents."""
    terms = [(doc_id, lexical_search.terms_of(text)) for doc_id, text in docs]
    terms = [(d, t) for d, t in terms if t]
    big_n, big_l = len(terms), sum(len(t) for _, t in terms)
    df = Counter(x for _, t in terms for x in set(t))
    out = []
    for item_id, text in items:
        query = set(lexical_search.terms_of(text))
        scored = []
        for doc_id, t in terms:
            tf, m = Counter(t), 50 + (50 * len(t) * big_n) // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[x] + 1))) * ((10**9 * tf[x]) // (1000 * tf[x] + 20 * m))
                    for x in query if tf[x])
            if s > 0:
                scored.append((s, doc_id))
        scored.sort(key=lambda p: (-p[0], p[1] is None, p[1] or 0))
        out += [(item_id, k + 1, d, s) for k, (s, d) in enumerate(scored[:top])]
    return sorted(out, key=repr)


def ranked(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS score", "3 AS rank")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "4 AS doc_id")
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical_search.rank(d, q).collect()), key=repr)


def test_against_plain(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    docs = [(k, " ".join(words[(k * j) % 12] for j in range(k % 40 + 1)) + f". Note{k % 3}, ÜBER über.") for k in range(300)]
    docs += [(None, "alpha beta"), (500, None), (501, ""), (502, "...!!"), (7, docs[7][1]), (503, "Alpha " * 20_000)]
    docs += [(600 + k, "kappa lambda tie") for k in range(60)]
    items = [(1, "alpha beta"), (2, "Kappa, lambda; tie!"), (3, "über note1"), (4, None), (5, "nowhere term"), (6, "")]
    old = lexical_search.BLOCK_DOCS
    lexical_search.BLOCK_DOCS = 16
    try:
        assert ranked(spark, docs, items) == plain(docs, items)
    finally:
        lexical_search.BLOCK_DOCS = old


def test_empty(spark):
    assert ranked(spark, [], [(1, "alpha")]) == []
    assert ranked(spark, [(1, "alpha")], []) == []


def test_terms_match_the_pattern():
    texts = ["Über-straße, ÜBER 12ab\tx_y", None, "", "...", "日本語 and 🎉emoji"]
    n, bounds, hashes, counts = lexical_search.text_terms(__import__("pyarrow").array(texts))
    for k, text in enumerate(texts):
        terms = lexical_search.terms_of(text)
        assert n[k] == len(terms)
        assert sorted(hashes[bounds[k]:bounds[k + 1]].tolist()) == sorted({lexical_search.term_hash(t) for t in terms})
        assert sorted(counts[bounds[k]:bounds[k + 1]].tolist()) == sorted(Counter(terms).values())


def test_bound_prunes():
    """The bound is above every exact score."""
    import numpy as np
    hashes = np.array(sorted({lexical_search.term_hash(t) for t in ["rare", "common"]}), dtype=np.int64)
    tfs = np.array([3, 1], dtype=np.int32)
    weights = np.array([5000, 10], dtype=np.int64)
    score = lexical_search.exact_scores(hashes, weights, hashes, tfs, np.array([0]), np.array([2]), np.array([0]), np.array([80]))[0]
    assert 0 < score <= weights.sum() * ((10**9 * 4) // (1000 * 4 + 20 * 80))


def test_a_task_hands_on_its_best_once(monkeypatch):
    """The index leaves a task block by block, and however many blocks a task searches, it gives at most TOP rows a query."""
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 32)
    docs = [(k, "alpha " * (k % 9 + 1) + f"word{k % 5}") for k in range(400)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([d for d, _ in docs]), "text": pa.array([t for _, t in docs])})
    rows = list(lexical_search._index(iter([batch])))
    blocks = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
    blocks = blocks.append_column("block", pa.array(range(blocks.num_rows), pa.int64()))
    assert blocks.num_rows >= 12
    hashes = np.array([lexical_search.term_hash("alpha")])
    plan = SimpleNamespace(value={1: (hashes, np.array([700]), lexical_search.probe_bits(hashes))})
    total = sum(len(t.split()) for _, t in docs)
    out = pa.Table.from_batches(list(lexical_search._search(plan, len(docs), total)(iter([blocks]))))
    assert out.num_rows == lexical_search.TOP

    def score(text):
        n, tf = len(text.split()), text.split().count("alpha")
        return 700 * ((10**9 * tf) // (1000 * tf + 20 * (50 + (50 * n * len(docs)) // total)))

    want = sorted(((-score(t), d) for d, t in docs))[:lexical_search.TOP]
    assert sorted(zip((-s for s in out["score"].to_pylist()), out["doc_id"].to_pylist())) == want


def test_slices_bound_rows_and_bytes():
    import pyarrow as pa

    from certiscope.llm import textops
    texts = ["a"] * 5000 + ["b" * 300_000] * 5
    parts = list(textops.slices(pa.RecordBatch.from_pydict({"text": texts}), "text"))
    assert max(p.num_rows for p in parts) <= 1024 and max(p.nbytes for p in parts) < 1 << 20
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
