"""Exact distinct counts that can be merged: bitmaps over integer keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


def distinct_sets(rows: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """The distinct values of the integer ``key`` for each combination of
    ``by`` as bitmaps: (by, bucket, bits), 32,768 values a bitmap.

    Bitmaps of one group and bucket are or-ed, so sets of different loads,
    partitions or finer groups merge into exactly the set of all their rows.
    NULL keys are not counted."""
    k = F.col(key)
    return rows.where(k.isNotNull()).groupBy(*by, F.bitmap_bucket_number(k).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias("bits"))


def merge_sets(sets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sets of coarser groups, or of several loads, from finer ones."""
    return sets.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def set_sizes(sets: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    return sets.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))


def listed_properties(t: Tables, as_of=None) -> DataFrame:
    """Different properties listed by month and type, by month, by type and
    in all: four groupings of one scan.  ``level`` tells them apart."""
    rows = t["listings"].select(F.trunc("listing_date", "MM").alias("month"), "listing_type", "property_id")
    fine = distinct_sets(rows, ["month", "listing_type"], "property_id")
    month, kind = F.col("month"), F.col("listing_type")
    cube = fine.groupingSets([(month, kind, F.col("bucket")), (month, F.col("bucket")), (kind, F.col("bucket")), (F.col("bucket"),)],
                             month, kind, F.col("bucket"))
    merged = cube.agg(F.bitmap_or_agg("bits").alias("bits"), F.grouping("month").alias("all_months"), F.grouping("listing_type").alias("all_types"))
    return set_sizes(merged, ["month", "listing_type", "all_months", "all_types"], "properties").select(
        F.concat_ws("+", F.when(F.col("all_months") == 0, "month"), F.when(F.col("all_types") == 0, "type")).alias("level"),
        F.date_format("month", "yyyy-MM").alias("month"), "listing_type", "properties")
