"""Membership of rows in a key set by a left join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flag_members(df: DataFrame, columns: Sequence[str], keys: DataFrame, name: str, spread_by: str) -> DataFrame:
    """``df`` plus ``name``: TRUE where ``columns`` equal a row of ``keys``
    (as many columns, in order, no repeated rows), else NULL.

    A row with a NULL in ``columns`` has no match.  Such rows may be most of
    the table; they are spread over the shuffle by ``spread_by`` instead of
    meeting in the partition of the NULL key."""
    ours = [F.col(c) for c in columns]
    theirs = [f"__key{i}" for i in range(len(columns))]
    right = keys.select(*[F.col(k).alias(t) for k, t in zip(keys.columns, theirs)])
    # always 0, but not a literal: a literal would leave the join keys
    right = right.withColumns({"__at": F.pmod(F.xxhash64(*theirs), F.lit(1)), name: F.lit(True)})
    missing = reduce(lambda a, b: a | b, [c.isNull() for c in ours])
    left = df.withColumn("__spread", F.when(missing, F.xxhash64(spread_by)).otherwise(F.lit(0).cast("bigint")))
    same = reduce(lambda a, b: a & b, [c == F.col(t) for c, t in zip(ours, theirs)])
    return left.join(right, same & (F.col("__spread") == F.col("__at")), "left").drop(*theirs, "__spread", "__at")
