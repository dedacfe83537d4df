import pytest

from certiscope.sources.register import read_csv
from certiscope.sources.split_csv import read_split_csv

BODY = [
    'id,"note\nof the day",band',
    '1,plain,A', '2,"two\nlines",', '3,"quote ""inside""\nand, comma",N/A', '', '4,"café\r\nend",zz',
    '5,"\n\nblank lines\n",A', '6,"' + "x" * 120 + '",B', '7,"",C',
]


def write(tmp_path, name, lines, newline="\n"):
    path = tmp_path / name
    path.write_bytes((newline.join(lines) + newline).encode("latin-1"))
    return str(path)


def both(spark, path, split_bytes):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        mine = read_split_csv(spark, path)
        parts = mine.rdd.getNumPartitions()
        got = sorted(map(tuple, mine.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = read_csv(spark, path, multi_line=True)
    return got, sorted(map(tuple, want.collect())), mine.columns, want.columns, parts


@pytest.mark.parametrize("split_bytes", [1, 5, 13, 29, 64, 1 << 20])
def test_equal_to_multiline_at_any_cut(spark, tmp_path, split_bytes):
    path = write(tmp_path, "a.csv", BODY)
    got, want, names, want_names, parts = both(spark, path, split_bytes)
    assert got == want and names == want_names and len(got) == 7
    assert split_bytes > 1000 or parts > 1


def test_two_files_and_crlf(spark, tmp_path):
    """A folder equals its files one by one; a CRLF file equals Python's own CSV reader."""
    import csv
    import io
    folder = tmp_path / "many"
    folder.mkdir()
    a = write(folder, "a.csv", BODY)
    b = write(folder, "b.csv", [BODY[0], '8,"other\r\nfile",A', '9,x,B'], newline="\r\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "17")
    try:
        whole = sorted(map(tuple, read_split_csv(spark, str(folder)).collect()))
        one = sorted(map(tuple, read_split_csv(spark, a).collect()))
        other = sorted(map(tuple, read_split_csv(spark, b).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    plain = list(csv.reader(io.StringIO(open(b, encoding="latin-1", newline="").read(), newline="")))[1:]
    assert whole == sorted(one + other) and other == sorted(map(tuple, plain))


def test_wrong_width_stops(spark, tmp_path):
    path = write(tmp_path, "bad.csv", ["a,b", "1,2", '3,"4\n",5'])
    with pytest.raises(Exception, match="fields"):
        read_split_csv(spark, path).collect()


def test_header_only(spark, tmp_path):
    path = write(tmp_path, "empty.csv", ["a,b"])
    assert read_split_csv(spark, path).collect() == []


def test_records_are_handed_on_in_bounded_batches():
    """A range's records leave the task in many small batches, none of them lost."""
    import pyarrow as pa

    from certiscope.sources import split_csv
    n = 60_000
    lines = [b"a,b"] + [line for k in range(n) for line in (b'%d,"%s' % (k, b"x" * 60), b'line"')]
    size = len(lines)
    batch = pa.RecordBatch.from_pydict({
        "file": ["f"] * size, "range": [0] * size, "seq": list(range(size)), "line": pa.array(lines, pa.binary()),
        "start_parity": [0] * size, "carried": pa.array([None] * size, pa.int64()), "file_first": [0] * size})
    pieces = [batch.slice(k, 10_000) for k in range(0, size, 10_000)]
    out = list(split_csv._records("ISO-8859-1", 2)(iter(pieces)))
    assert max(b.nbytes for b in out) < 2 * split_csv.BATCH_BYTES and len(out) > 3
    fields = [f for b in out for f in b.column("fields").to_pylist()]
    assert fields == [[str(k), "x" * 60 + "\nline"] for k in range(n)]


def test_ranges_joined_by_shuffle(spark, tmp_path, monkeypatch):
    from certiscope.sources import split_csv
    path = write(tmp_path, "a.csv", BODY)
    monkeypatch.setattr(split_csv, "BROADCAST_RANGES", 0)
    got, want, *_ = both(spark, path, 13)
    assert got == want
