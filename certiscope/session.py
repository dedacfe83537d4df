"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(app: str = "certiscope", cores: int | str = "*", partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in LOCAL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may do without the setting: it gets one temporary folder per application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="certiscope-")
    return _LOCAL_ROOTS[context.applicationId]


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is created or overwritten."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """The table written once to the shared folder and read back.

    For tables that several passes read: the work behind them is done once, and neither a later pass
    nor the loss of an executor repeats it.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """Number of shuffle partitions, the yardstick for how finely an ordering is cut."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cores_from_env(default: str = "8") -> str:
    return os.environ.get("BENCH_CPUS", default)
