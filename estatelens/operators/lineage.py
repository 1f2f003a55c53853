"""Lineage cuts: tables written to the folder that the whole cluster shares."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table (estimated bytes) that a job broadcasts by a hint.
BROADCAST_BYTES = 16 << 20


def scratch(spark: SparkSession) -> str:
    """A new folder name under the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder under the
    temporary directory; on a cluster the setting is required."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "estatelens-checkpoints")
    return f"{base.rstrip('/')}/cut-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` and read it back: later stages depend on files that
    outlive any executor, and on nothing that made them.  The files stay
    until the run's owner removes them."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_shuffled(table: DataFrame, bytes_per_row: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``table`` (a cut: its count is a metadata read) marked for broadcast
    if it stays within ``limit`` at ``bytes_per_row``, else as it is."""
    return F.broadcast(table) if table.count() * bytes_per_row <= limit else table
