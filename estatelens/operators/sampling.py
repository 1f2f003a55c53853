"""Exact-size random samples and picks of random parents.

A row's draw is the MD5 of a seed and its key, so it does not depend on
partitions, and any engine can repeat it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.operators.heavy import split_join
from estatelens.operators.lineage import cut
from estatelens.operators.ordered import with_ordinal

Tables = Mapping[str, DataFrame]

#: Hex digits of the draw that one histogram looks at.
DIGITS = 4
#: Rows of the boundary bucket that are ordered to find the exact cut.
EXACT = 100_000


def draw(key: Column, seed: str) -> Column:
    """128 random bits of a key, as hexadecimal digits."""
    return F.md5(F.concat_ws(":", F.lit(seed), key.cast("string")).cast("binary"))


def sample_bound(keys: DataFrame, key: str, size: int, seed: str) -> Column:
    """The condition on ``key`` that ``size`` of ``keys`` (unique, no NULL)
    meet: those with the smallest draws.

    A histogram of the draws' first digits tells which buckets belong to the
    sample as a whole and which one is cut; that one is looked at with more
    digits until it is small enough to be ordered.  Nothing else is sorted."""
    draws = cut(keys.select(draw(F.col(key), seed).alias("__draw"), F.col(key).cast("string").alias("__key")))
    if draws.count() <= size:
        return F.lit(True)
    prefix, left, bucket = "", max(0, size), draws  # draws below the prefix are in; `left` of those with it
    while bucket.count() > EXACT and len(prefix) < 32:
        sizes = bucket.groupBy(F.substring("__draw", 1, len(prefix) + DIGITS).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        for r in sizes.orderBy("p").collect():  # 16 ** DIGITS rows at most
            if r["n"] > left:
                prefix = r["p"]
                break
            left -= r["n"]
        bucket = draws.where(F.col("__draw").startswith(prefix))
    # the first draw that is out: its place in the bucket is `left`
    edge = bucket.orderBy("__draw", "__key").limit(left + 1).orderBy(F.desc("__draw"), F.desc("__key")).first()
    own = draw(F.col(key), seed)
    return (own < edge["__draw"]) | ((own == edge["__draw"]) & (F.col(key).cast("string") < edge["__key"]))


def sample_exact(rows: DataFrame, key: str, size: int, seed: str) -> DataFrame:
    """Exactly ``size`` of ``rows`` (all, if there are fewer) without
    replacement, by the draws of the unique ``key``.  No row moves."""
    return rows.where(sample_bound(rows.select(key), key, size, seed))


def pick_parent(rows: DataFrame, key: str, parents: DataFrame, parent_key: str, seed: str, name: str) -> DataFrame:
    """``rows`` plus ``name``: a parent key drawn uniformly with replacement
    for each value of ``key``; NULL if there is no parent.

    Parent keys need not be dense: they are numbered in order, and the
    drawn number selects one."""
    numbered = cut(with_ordinal(parents.select(F.col(parent_key).alias(name)), [name], "__rank"))
    n = numbered.count()
    number = F.conv(F.substring(draw(F.col(key), seed), 1, 15), 16, 10).cast("bigint") % max(n, 1) + 1
    return split_join(rows.withColumn("__rank", number), numbered, ["__rank"], "left").drop("__rank")


def offer_sample(t: Tables, as_of=None) -> DataFrame:
    """A random sample of the offers, as many as thirty for each agent (all
    offers, if there are fewer)."""
    offers = t["offers"].select("offer_id", "listing_id")
    return sample_exact(offers, "offer_id", min(30 * t["agents"].count(), offers.count()), "offers")


def interaction_sold_listing(t: Tables, as_of=None) -> DataFrame:
    """Every interaction with a random one of the Sold listings, whose keys
    are not dense."""
    sold = t["listings"].where(F.col("listing_status") == "Sold")
    picked = pick_parent(t["customer_interactions"].select("interaction_id"), "interaction_id", sold, "listing_id", "sold", "listing_id")
    return picked.select("interaction_id", "listing_id")
