"""Helpers of the operators: lineage cuts, size-checked joins, text keys."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Largest table (estimated bytes) sent to every executor.
BROADCAST_BYTES = 16 << 20


def scratch(spark: SparkSession) -> str:
    """A new folder name in the shared checkpoint folder of the cluster.

    A local session that names no ``spark.checkpoint.dir`` gets a folder
    under the temporary directory; a cluster session must name one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "estatelens-checkpoints")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages depend on the files alone, so a lost executor costs no
    recomputation, and the row count of the result is a metadata read."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_shuffled(table: DataFrame, bytes_per_row: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``table`` (a result of :func:`cut`) marked for broadcast if its rows,
    at ``bytes_per_row`` each, stay within ``limit``; else as it is, so that
    the planner shuffles both sides and splits skewed keys."""
    return F.broadcast(table) if table.count() * bytes_per_row <= limit else table


def shuffle_partitions(df: DataFrame) -> int:
    """How many parts a shuffle has, which is set by the size of the data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, everything else unchanged; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def replace_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add (matched as
    Spark resolves names, without regard to case)."""
    gone = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in gone])


def columns_of(docs: DataFrame, *needed: str) -> DataFrame:
    """The named columns under their exact names, whatever else there is."""
    return docs.select(*[F.col(f"`{c}`").alias(c) for c in needed])


def one_of_each(rows: DataFrame, *keys: Column) -> DataFrame:
    """Of the rows equal in ``keys`` that with the smallest hash of all columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    first = rows.groupBy(*[k.alias(f"__key{i}") for i, k in enumerate(keys)]).agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("__row"))
    return first.select(*[F.col("__row").getField(c).alias(c) for c in rows.columns])
