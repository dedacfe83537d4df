"""CSV files whose quoted values hold line breaks, read by many tasks a file.

Spark's own reader takes such files only with ``multiLine``, and then one task reads a whole file. Here
files are read as lines, split as Spark splits any text file, and records are put together again by the
parity of quote characters:

1. Every task reads the lines of its byte ranges (the raw bytes, whatever the encoding) and counts the
   quotes of each range. Per range it keeps the parity and, for either parity at the range's start, the last
   line that would begin a record. A line begins a record when the quotes before it in the file are even.
2. Per file, the ranges' parities are summed in order (one row a range): each range learns its parity at
   the start and the record that its first lines continue.
3. Every task reads its lines again, parses the records that lie inside its range and hands on the pieces of
   records that cross a range's edge. Only those pieces are shuffled, and put together by their record.

The first record of each file is its header. Empty lines between records are skipped. A record with
another number of fields than the header stops the query, as Spark's FAILFAST does. Values come out as
text; the texts that mean 'missing' become NULL as in :func:`certiscope.sources.register.read_csv`.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from certiscope.sources.register import null_missing

QUOTE = 0x22
#: Ranges of more rows than this are joined to their lines by a shuffle instead of being sent to every task.
BROADCAST_RANGES = 100_000
#: A task hands its parsed records on whenever they hold this many bytes, so it never keeps a whole range.
BATCH_BYTES = 1 << 20


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line with its file, range and place; the range is one task's, so places rise along the file."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").cast("binary").alias("line"))


def _rows(batches: Iterator[pa.RecordBatch], extra: tuple[str, ...] = ()) -> Iterator[tuple]:
    """(file, range, seq, line, *extra) of every row, in the order of the partition."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("file", "range", "seq", "line", *extra)]
        yield from zip(*columns)


def _range_parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state: dict[tuple, list] = {}  # (file, range) -> [parity, first seq, last line beginning a record if even, if odd]
    for file, start, seq, line in _rows(batches):
        own = state.setdefault((file, start), [0, seq, None, None])
        own[2 + own[0]] = seq
        own[0] ^= line.count(QUOTE) & 1
    keys = list(state)
    yield pa.RecordBatch.from_pydict({
        "file": pa.array([k[0] for k in keys], pa.string()), "range": pa.array([k[1] for k in keys], pa.int64()),
        "parity": pa.array([state[k][0] for k in keys], pa.int32()),
        "first_seq": pa.array([state[k][1] for k in keys], pa.int64()),
        "last_if_even": pa.array([state[k][2] for k in keys], pa.int64()),
        "last_if_odd": pa.array([state[k][3] for k in keys], pa.int64())})


def _range_table(lines: DataFrame) -> DataFrame:
    """Per range: the quote parity before it, the record its first lines continue, the file's first line."""
    pieces = lines.mapInArrow(_range_parities, "file string, range long, parity int, first_seq long, last_if_even long, "
                                                "last_if_odd long")
    in_file = Window.partitionBy("file").orderBy("range")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    start = pieces.withColumn("start_parity", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2)
    own = F.when(F.col("start_parity") == 0, F.col("last_if_even")).otherwise(F.col("last_if_odd"))
    marked = start.withColumn("own_start", own)
    return marked.select(
        "file", "range", "first_seq", "start_parity",
        F.last("own_start", ignorenulls=True).over(before).alias("carried"),
        F.min("first_seq").over(Window.partitionBy("file")).alias("file_first"))


def _decoder(encoding: str):
    def parse(data: bytes) -> list[str] | None:
        text = data.decode(encoding)
        if text.endswith("\r"):
            text = text[:-1]
        if text == "":
            return None
        rows = list(csv.reader(io.StringIO(text, newline=""), delimiter=",", quotechar='"', doublequote=True, strict=False))
        return rows[0] if rows else None
    return parse


def _records(encoding: str, width: int):
    parse = _decoder(encoding)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = {k: [] for k in ("fields", "file", "key", "order", "piece")}
        current, parity, key, here, buffer, header, held = None, 0, None, False, [], None, 0

        def flush(file):
            """A record that began and ended in this range is parsed; any other part of one is handed on."""
            nonlocal held
            if not buffer:
                return
            data = b"\n".join(line for _, line in buffer)
            held += len(data)
            if here and parity == 0:
                fields = None if key == header else _checked(parse(data), width)
                if fields is not None:
                    for name, value in zip(out, (fields, None, None, None, None)):
                        out[name].append(value)
            else:
                for name, value in zip(out, (None, file, key, buffer[0][0], data)):
                    out[name].append(value)

        def handed_on():
            nonlocal held
            batch = pa.RecordBatch.from_pydict({
                "fields": pa.array(out["fields"], pa.list_(pa.string())), "file": pa.array(out["file"], pa.string()),
                "key": pa.array(out["key"], pa.int64()), "order": pa.array(out["order"], pa.int64()),
                "piece": pa.array(out["piece"], pa.binary())})
            held = 0
            for values in out.values():
                values.clear()
            return batch

        for file, start, seq, line, start_parity, carried, file_first in _rows(
                batches, ("start_parity", "carried", "file_first")):
            if (file, start) != current:
                if current is not None:
                    flush(current[0])
                current, parity, key, here, buffer, header = (file, start), start_parity, carried, False, [], file_first
            if parity == 0:
                flush(file)
                key, here, buffer = seq, True, []
                if held >= BATCH_BYTES:
                    yield handed_on()
            buffer.append((seq, line))
            parity ^= line.count(QUOTE) & 1
        if current is not None:
            flush(current[0])
        yield handed_on()
    return run


def _checked(fields: list[str] | None, width: int) -> list[str] | None:
    if fields is not None and len(fields) != width:
        raise ValueError(f"a CSV record has {len(fields)} fields, the header {width}: {fields[:3]}")
    return fields


def _joined(encoding: str, width: int):
    parse = _decoder(encoding)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = []
            for pieces, header in zip(batch.column("pieces").to_pylist(), batch.column("header").to_pylist()):
                if header:
                    continue
                fields = _checked(parse(b"\n".join(p["piece"] for p in sorted(pieces, key=lambda p: p["order"]))), width)
                if fields is not None:
                    records.append(fields)
            yield pa.RecordBatch.from_pydict({"fields": pa.array(records, pa.list_(pa.string()))})
    return run


def read_split_csv(spark: SparkSession, path: str | list[str], encoding: str = "ISO-8859-1",
                   missing_values: bool = True) -> DataFrame:
    """All columns as text, names from the header of the files, any number of tasks a file (see the module)."""
    # the header may hold quoted line breaks too; Spark parses only the first record of a file for it
    names = spark.read.option("header", True).option("encoding", encoding).option("multiLine", True).csv(path).columns
    lines = _lines(spark, path)
    ranges = _range_table(lines)
    few = ranges.count() <= BROADCAST_RANGES
    ranges = F.broadcast(ranges) if few else ranges
    keyed = lines.join(ranges.drop("first_seq").withColumnRenamed("range", "r_range").withColumnRenamed("file", "r_file"),
                       (lines["file"] == F.col("r_file")) & (lines["range"] == F.col("r_range")))
    keyed = keyed.drop("r_file", "r_range")
    if not few:  # the shuffle mixes the lines; beside a broadcast they stay in the order they are read in
        keyed = keyed.sortWithinPartitions("file", "range", "seq")
    parts = keyed.mapInArrow(_records(encoding, len(names)),
                             "fields array<string>, file string, key long, order long, piece binary")
    whole = parts.where(F.col("piece").isNull()).select("fields")
    firsts = ranges.select(F.col("file").alias("h_file"), F.col("file_first").alias("h_key")).distinct()
    pending = parts.where(F.col("piece").isNotNull()).groupBy("file", "key").agg(
        F.collect_list(F.struct("order", "piece")).alias("pieces"))
    pending = pending.join(firsts, (F.col("file") == F.col("h_file")), "left").select(
        "pieces", (F.col("key") == F.col("h_key")).alias("header"))
    crossing = pending.mapInArrow(_joined(encoding, len(names)), "fields array<string>")
    records = whole.unionByName(crossing)
    df = records.select(*[F.col("fields")[k].alias(name) for k, name in enumerate(names)])
    return null_missing(df) if missing_values else df
