"""Loading new register files as they arrive.

Every micro-batch is cleaned, reduced to its newest certificate per property and added as one part of
the table; reading the table keeps the newest certificate over all parts. A part is named by its batch
and overwritten when the batch runs again, so a restart neither loses nor doubles rows. The state is
the table itself, not a per-property state store in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from certiscope.operators.cleaning import clean_register
from certiscope.operators.dedup import latest_per_key
from certiscope.sources.register import csv_options, normalise_year, null_missing


def watch_files(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1,
                file_format: str = "parquet", multi_line: bool = False) -> DataFrame:
    """New files under ``path`` as a stream; CSV files of a year are normalised as :func:`read_year` does."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if file_format == "csv":
        return normalise_year(null_missing(reader.options(**csv_options(multi_line=multi_line)).csv(path)))
    return reader.format(file_format).load(path)


def start_load(stream: DataFrame, out: str, checkpoint: str, file_year: str | None = None,
               ties: list[str] = ()) -> StreamingQuery:
    """Process what is there, then stop. Run again when new files have arrived."""

    def add(batch: DataFrame, number: int) -> None:
        newest = latest_per_key(clean_register(batch), file_year=file_year, ties=list(ties))
        newest.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def current(spark: SparkSession, out: str, file_year: str | None = None, ties: list[str] = ()) -> DataFrame:
    """The register as of the batches loaded so far."""
    parts = spark.read.parquet(out).drop("batch")
    return latest_per_key(parts, file_year=file_year, ties=list(ties))


def compact(spark: SparkSession, out: str, target: str, file_year: str | None = None, ties: list[str] = ()) -> None:
    """Write the current state as the single part of a new table, so that reading stays cheap."""
    current(spark, out, file_year, ties).write.parquet(f"{target}/batch=0")
