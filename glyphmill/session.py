"""Session helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    A session inside one JVM (``local`` or ``local[n]``, never ``local-cluster``) may go
    without that setting: its driver is its only executor, and it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = f"file://{tempfile.gettempdir()}"
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def bounded_batches(df: DataFrame, most: int = 4 << 20) -> DataFrame:
    """``df``, after asking its session for Arrow batches of up to ``most`` bytes; one with a lower limit keeps it.

    Else a worker holds batches of thousands of texts, so the longer texts are the more memory it needs.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(key).rstrip("bB")
    if not now.isdigit() or not 0 < int(now) <= most:
        conf.set(key, str(most))
    return df


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store with all it holds."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
