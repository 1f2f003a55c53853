"""Row-level jobs for the semantic building blocks the analytical queries
rely on, so each can be checked over whole tables on its own:

* first and latest price of every listing (FIRST_VALUE over change_date
  ascending / descending with PostgreSQL NULL order, ties by id);
* the AGE() day component from listing to close, per closed listing;
* whole elapsed days from an interaction to its listing's close;
* the rounding INTEGER cast of bedroom counts;
* the equi join with a residual inequality (a price cut dated on or before
  the close date) behind the sold-with-reduction percentage;
* the cleaning of text, dates and amounts that loading does (phone strip,
  truncation, licence pattern, defaults, date windows, rounding).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.functions import age_day_part, elapsed_days, pg_int
from estatelens.functions.text import clean_phone, truncate
from estatelens.operators.inventory import listing_price_span, sold_reduction_flags
from estatelens.operators.quality import apply_defaults
from estatelens.schemas import TABLES

Tables = Mapping[str, DataFrame]


def listing_first_last_price(t: Tables, as_of=None) -> DataFrame:
    """listing_id, first_price, last_price for every listing with history."""
    return listing_price_span(t["property_price_history"])


def listing_days_on_market(t: Tables, as_of=None) -> DataFrame:
    """listing_id, days_on_market = EXTRACT(DAY FROM AGE(close, listed))."""
    return t["listings"].where(F.col("close_date").isNotNull()).select(
        "listing_id", age_day_part("close_date", "listing_date").alias("days_on_market")
    )


def interaction_days_to_close(t: Tables, as_of=None) -> DataFrame:
    """interaction_id, days_to_close = EXTRACT(DAY FROM close - interaction_dt)
    for interactions on listings with a close date."""
    closed = t["listings"].where(F.col("close_date").isNotNull()).select("listing_id", "close_date")
    return (
        t["customer_interactions"]
        .select("interaction_id", "listing_id", "interaction_dt")
        .join(closed, "listing_id")
        .select("interaction_id", elapsed_days("close_date", "interaction_dt").alias("days_to_close"))
    )


def bedroom_rounding_counts(t: Tables, as_of=None) -> DataFrame:
    """Properties per CAST(bedroom AS INTEGER) (rounds half away from zero)."""
    return (
        t["properties"]
        .groupBy(pg_int("bedroom").alias("bedroom_int"))
        .agg(F.count("property_id").alias("property_count"))
    )


def sold_listing_reductions(t: Tables, as_of=None) -> DataFrame:
    """listing_id, reduced (0/1) for every Sold listing with a close date."""
    return sold_reduction_flags(t).select("listing_id", F.col("reduced").cast("bigint").alias("reduced"))


def customer_contacts(t: Tables, as_of=None) -> DataFrame:
    """Customers with the phone characters of their email and address kept
    (20 at most) and the address cut to eight characters."""
    return t["customers"].select(
        "customer_id", clean_phone(F.concat("email", F.lit(" (x) "), "address")).alias("phone_like"), truncate("address", 8).alias("short_address"))


def agent_licenses(t: Tables, as_of=None) -> DataFrame:
    """Agents with the licence pattern of their id (five digits at least)."""
    return t["agents"].select("agent_id", F.format_string("LIC-%05d", "agent_id").alias("license_number"))


def filled_defaults(t: Tables, as_of=None) -> DataFrame:
    """Per table and column with a default: rows, rows that had no value,
    and rows that have the default's date (the as-of date) afterwards.

    Every third key's value is taken away first, so that there are gaps."""
    parts = []
    for tb in TABLES.values():
        columns = [c for c in tb.columns if c.default]
        if not columns:
            continue
        gap = F.col(tb.primary_key) % 3 == 0
        df = t[tb.name].select(tb.primary_key, *[F.when(~gap, F.col(c.name)).alias(c.name) for c in columns])
        filled = apply_defaults(df.select("*", *[F.col(c.name).alias(f"old_{c.name}") for c in columns]), tb, load_ts=f"{as_of} 00:00:00")
        for c in columns:
            is_default = F.col(c.name).cast("date") == F.lit(str(as_of)).cast("date")
            parts.append(filled.agg(
                F.lit(tb.name).alias("table_name"), F.lit(c.name).alias("column_name"), F.count(F.lit(1)).alias("row_count"),
                F.count_if(F.col(f"old_{c.name}").isNull()).alias("missing"), F.count_if(is_default).alias("at_default")))
    return reduce(DataFrame.unionByName, parts)


def listing_date_windows(t: Tables, as_of=None) -> DataFrame:
    """Listings with their close clamped to the listing date or later (the
    listing date if there is none), the ninety days after it, and the
    midnight of the last update."""
    end = F.greatest(F.coalesce(F.date_sub("close_date", 60), "listing_date"), "listing_date")
    return t["listings"].select("listing_id", end.alias("end_date"), F.date_add(end, 90).alias("expires"),
                                F.date_format(F.date_trunc("day", F.col("last_updated")), "yyyy-MM-dd HH:mm").alias("updated_day"))


def commission_roundings(t: Tables, as_of=None) -> DataFrame:
    """Per commission status: sums of float shares rounded to cents and to
    one digit, each rounded row by row."""
    share = F.col("commission_amount").cast("double") * 0.25
    return t["commissions"].groupBy("status").agg(
        F.sum(F.round(share.cast("decimal(18,6)"), 2)).alias("cents"), F.sum(F.round(share.cast("decimal(18,6)"), 1)).alias("tenths"))
