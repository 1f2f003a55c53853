"""Jobs over price changes row by row: windows and the inequality join,
without a task for a listing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.functions import asc
from estatelens.operators.ordered import segmented_scan

Tables = Mapping[str, DataFrame]


def price_change_context(t: Tables, as_of=None) -> DataFrame:
    """Every price change with its listing's first old price, its latest new
    price and the new price of the change before (NULL for the first one).
    NULL dates are the latest; changes of one moment are ordered by id."""
    rows = t["property_price_history"].select("price_history_id", "listing_id", "change_date", "old_price", "new_price")
    found = segmented_scan(rows, ["listing_id"], [asc("change_date"), asc("price_history_id")],
                           first={"first_price": "old_price"}, last={"last_price": "new_price"}, previous={"previous_price": "new_price"})
    return found.select("price_history_id", "listing_id", "first_price", "last_price", "previous_price")


def sold_listing_cuts(t: Tables, as_of=None) -> DataFrame:
    """Per Sold listing with a close date: number and sum of the price cuts
    dated on or before the close (midnight), and the price after the last of
    them (of cuts of one moment the one with the largest id).

    Cuts and closes are put in one order (listing, moment, cuts first), and
    what has run up when a close comes is its answer: no cut is compared with
    a close, whatever the number of cuts a listing has."""
    moment = F.col("close_date").cast("timestamp_ntz")
    closes = t["listings"].where((F.col("listing_status") == "Sold") & F.col("close_date").isNotNull()).select(
        "listing_id", moment.alias("at"), F.lit(1).alias("kind"), F.lit(0).cast("bigint").alias("id"),
        F.lit(0).cast("bigint").alias("cut"), F.lit(0).cast("decimal(15,2)").alias("amount"), F.lit(None).cast("decimal(14,2)").alias("price"))
    cuts = t["property_price_history"].where((F.col("new_price") < F.col("old_price")) & F.col("change_date").isNotNull()).select(
        "listing_id", F.col("change_date").alias("at"), F.lit(0).alias("kind"), F.col("price_history_id").alias("id"),
        F.lit(1).cast("bigint").alias("cut"), (F.col("old_price") - F.col("new_price")).cast("decimal(15,2)").alias("amount"),
        F.col("new_price").alias("price"))
    run = segmented_scan(cuts.unionByName(closes), ["listing_id"], ["at", "kind", "id"], previous={"last_cut_price": "price"},
                         running={"cuts": "cut", "cut_total": "amount"})
    return run.where(F.col("kind") == 1).select("listing_id", "cuts", "cut_total", "last_cut_price")
