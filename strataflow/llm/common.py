"""Helpers shared by the operators: written stages, hashing tasks, text rules."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import scratch_path

#: Characters that separate words everywhere in this subpackage.
SPACES = r"[\x20\x09-\x0D]+"

#: Batch sizes that operators have set.
BATCHES: set[str] = set()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, stored once as Parquet in the shared folder.

    This cuts the lineage: a lost executor costs a read of these files and no
    recomputation, and each attempt of a task writes through Spark's committer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame, size: str = "8m") -> DataFrame:
    """``df``, in a session that hands texts to Python in batches of that size: Spark's
    default of 64 MB, held by the JVM and the worker, is much beside an executor's
    other memory. A session with a setting of its own keeps it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(key) in ("67108864b", *BATCHES):
        BATCHES.add(size)
        df.sparkSession.conf.set(key, size)
    return df


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of stages whose result is written. It does
    so when the driver collects its garbage, which can be long after the stage. What
    the first pass frees in Python and in listeners, the second one finds."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions the session is sized for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: bytes) -> list[bytes]:
    """Words of one UTF-8 text, A-Z in lower case. ``bytes`` methods know ASCII
    only, so both rules are exactly the ASCII ones of ``SPACES``."""
    return text.lower().split()
