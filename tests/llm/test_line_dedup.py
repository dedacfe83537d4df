import hashlib

import numpy as np

from certiscope.llm import line_dedup

SHARED = "This boilerplate line is long enough to count as a key."


def plain(rows, min_chars=40, min_docs=5):
    """The rule written out: keys, documents holding them, owners."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars and doc_id is not None:
                holders.setdefault(key(line), set()).add(doc_id)
    owner = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        drop = [key(x) in owner and owner[key(x)] != doc_id for x in lines]
        out.append((doc_id, len(lines), sum(drop), "\n".join(x for x, d in zip(lines, drop) if not d)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in df.collect()), key=repr)


def test_mphf_is_a_bijection():
    for n in (0, 1, 2, 3, 7, 1000, 20_000):
        keys = np.unique(np.random.default_rng(n).integers(-2**63, 2**63 - 1, n, dtype=np.int64))
        offsets, slot = line_dedup.build_mphf(keys)
        assert sorted(slot.tolist()) == list(range(len(keys)))
        assert (line_dedup.mphf_lookup(offsets, len(keys), keys) == slot).all()


def test_odd_rows(spark):
    rows = [(k, f"intro {k}\n  {SHARED.upper()} \t\nshort\n{SHARED}") for k in range(1, 6)]
    rows += [(None, SHARED), (7, None), (8, ""), (9, SHARED), (9, SHARED), (10, "\n\n"), (11, "x" * 100_000 + "\n" + SHARED)]
    rows += [(12, "Another line held by four documents only, not enough.")] * 4
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS drops", "2 AS shard", "3 AS h1")
    got = rows_of(line_dedup.dedup_lines(df))
    assert got == plain(rows)
    by_id = {r[0]: r for r in got}
    assert by_id[11][2] == 0 and by_id[5][2] == 2 and by_id[7] == (7, 1, 0, "") and by_id[None][2] == 1


def test_blocks_agree(spark):
    """A probe budget of one byte puts every shard in its own block and passes the documents once per block."""
    base = "shared line number {} with enough characters to count"
    rows = [(d, "\n".join(base.format(k) for k in range(d % 7, 40))) for d in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    old = line_dedup.SHARD_KEYS
    line_dedup.SHARD_KEYS = 5
    try:
        assert rows_of(line_dedup.dedup_lines(df, probe_bytes=1)) == plain(rows)
    finally:
        line_dedup.SHARD_KEYS = old


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.dedup_lines(df).collect() == []


def test_digest_column(spark):
    df = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    row = line_dedup.dedup_lines(df).collect()[0]
    assert hashlib.sha256(row["kept_text"].encode()).hexdigest() == line_dedup.sha256_hex("a\nb")
