"""N:1 joins that split the fact side's heavy keys off beforehand.

A key that holds more rows than a task should read is measured, not hoped
for: its parent row is broadcast and its fact rows stay where they are; all
other keys go through the ordinary shuffle.  Nothing depends on adaptive
execution, which leaves a skewed partition whole where splitting it would
need another exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.operators.lineage import BROADCAST_BYTES, cut


def heavy_keys(fact: DataFrame, key: Sequence[str], rows: int | None = None, most: int = 1 << 62) -> DataFrame:
    """The keys with more than ``rows`` fact rows, a cut table of at most
    ``most`` keys (heavier ones, if there are more).

    ``rows`` is by default half of what a shuffle task gets on average, so
    there are at most twice as many heavy keys as shuffle partitions.  Counts
    are combined before they move."""
    counts = cut(fact.select(*key).dropna().groupBy(*key).agg(F.count(F.lit(1)).alias("__n")))
    if rows is None:
        total = counts.agg(F.sum("__n")).first()[0] or 0
        rows = max(1, total // (2 * int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    while True:
        heavy = cut(counts.where(F.col("__n") > rows).select(*key))
        if heavy.count() <= most:
            return heavy
        rows *= 2


def split_join(fact: DataFrame, parent: DataFrame, key: Sequence[str], how: str = "inner", row_bytes: int = 256,
               rows: int | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``fact`` joined with ``parent`` (one row a key) on the columns ``key``.

    ``how`` is ``inner`` or ``left``.  Null keys match nothing and, in a left
    join, are not shuffled.  The parent rows of heavy keys are broadcast: at
    most ``limit`` bytes at ``row_bytes`` each, so that beyond it only the
    heaviest keys that fit count as heavy."""
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    key = list(key)
    heavy = heavy_keys(fact, key, rows, most=max(1, limit // row_bytes))
    filled = fact.dropna(subset=key)
    few = F.broadcast(heavy)
    out = filled.join(few, key, "left_anti").join(parent, key, how)
    if heavy.count():
        lookup = F.broadcast(parent.join(few, key, "left_semi"))
        out = out.unionByName(filled.join(few, key, "left_semi").join(lookup, key, how))
    if how == "left":
        missing = fact.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key]))
        out = out.unionByName(missing, allowMissingColumns=True)
    return out
