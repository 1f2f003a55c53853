"""Market-analysis and pricing analytics (6 queries)."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelens.functions import (
    age_day_part,
    asc,
    count_if,
    count_pct,
    desc,
    mean_of_parts,
    months_before,
    pct_change,
    pg_int,
    pg_round,
)

Tables = Mapping[str, DataFrame]


def _to_geo(per_property: DataFrame, props: DataFrame, nbhds: DataFrame) -> DataFrame:
    """Attach property and neighborhood attributes (inner, N:1 each) to rows
    that are already aggregated to property grain.

    Listing-grained jobs first reduce listings to (property_id, group key)
    partials: the property join then shuffles property-grained rows, the
    neighborhood join sees one row per property and group, and a property
    holding a third of all listings is combined map-side."""
    return per_property.join(props, "property_id").join(nbhds, "neighborhood_id")


def ny_ppsf_state(t: Tables) -> DataFrame:
    """What :func:`ny_ppsf_by_property_type` needs of the listings: their
    number per property and price, so distinct properties stay countable."""
    return t["listings"].where(F.col("listing_status").isin("Sold", "Rented")).groupBy("property_id", "listing_price").agg(
        F.count(F.lit(1)).cast("decimal(10,0)").alias("n"))


def ny_ppsf_by_property_type(t: Tables, as_of=None, state: DataFrame | None = None) -> DataFrame:
    """NY Sold/Rented listings of three property types: distinct properties
    and mean price per sqft per (type, neighborhood name, listing price).

    The listing price is a grouping key that is not output, so one
    (type, neighborhood) pair can appear on several rows.
    """
    per_property = ny_ppsf_state(t) if state is None else state
    props = t["properties"].where(
        F.col("property_type").isin("Single-family", "Condo", "Townhouse") & (F.col("sqft") > 0)
    ).select("property_id", "neighborhood_id", "property_type", "sqft")
    nb = t["neighborhoods"].where(F.col("state") == "NY").select(
        "neighborhood_id", "neighborhood_name"
    )
    ppsf = F.col("listing_price") / F.col("sqft")  # per listing row, NUMERIC
    return (
        _to_geo(per_property, props, nb)
        .groupBy("property_type", "neighborhood_name", "listing_price")
        .agg(
            F.count("property_id").alias("property_count"),
            pg_round(
                F.sum(ppsf * F.col("n")) / F.sum(F.when(ppsf.isNotNull(), F.col("n"))), 2
            ).alias("avg_price_per_sqft"),
        )
        .orderBy(asc("property_type"), desc("avg_price_per_sqft"), "neighborhood_name",
                 asc("listing_price"))
        .drop("listing_price")
    )


def two_bedroom_price_trend(t: Tables, as_of=None) -> DataFrame:
    """Listings of the last 12 months whose bedroom count rounds to 2: per
    month and neighborhood, distinct properties, mean price and the change
    (%) against the previous month present for that neighborhood."""
    per_property = (
        t["listings"]
        .where(F.col("listing_date") >= months_before(as_of, 12))
        .groupBy("property_id", F.trunc("listing_date", "month").alias("listing_month"))
        .agg(F.sum("listing_price").alias("price_sum"), F.count("listing_price").alias("price_n"))
    )
    props = t["properties"].where(pg_int("bedroom") == 2).select(
        "property_id", "neighborhood_id"
    )
    nb = t["neighborhoods"].select("neighborhood_id", "neighborhood_name")
    # an aggregate right after the property join: its exchange spreads a hot
    # neighborhood before names and the window meet it
    monthly = (
        per_property.join(props, "property_id")
        .groupBy("neighborhood_id", "listing_month")
        .agg(
            F.count("property_id").alias("total_2br_properties"),
            mean_of_parts(F.sum("price_sum"), F.sum("price_n")).alias("avg_price"),
        )
        .join(nb, "neighborhood_id")
    )
    # One row per (neighborhood, month) after the aggregate, so the window
    # partitions are bounded by the number of months.
    w = Window.partitionBy("neighborhood_id").orderBy("listing_month")
    prev = F.lag("avg_price", 1).over(w)
    return (
        monthly.withColumn("prev_avg", prev)
        .select(
            "listing_month",
            "neighborhood_name",
            "neighborhood_id",
            "total_2br_properties",
            pg_round("avg_price", 2).alias("avg_listing_price"),
            pg_round(pct_change("avg_price", "prev_avg"), 2).alias("month_over_month_pct_change"),
        )
        .orderBy(desc("listing_month"), asc("neighborhood_name"), "neighborhood_id")
        .drop("neighborhood_id")
    )


def asking_vs_accepted_offer(t: Tables, as_of=None) -> DataFrame:
    """Accepted offers per neighborhood (name, city): count, mean asking and
    offer price, the % gap of the means, and three price bands."""
    offers = t["offers"].where(F.col("status") == "accepted").select(
        "offer_id", "listing_id", "offer_price"
    )
    listings = t["listings"].select("listing_id", "property_id", "listing_price")
    o, lp = F.col("offer_price"), F.col("listing_price")
    floor90 = lp * F.lit(Decimal("0.9"))
    rows = offers.join(listings, "listing_id")
    # Partial sums per property before the property/neighborhood joins.
    per_property = rows.groupBy("property_id").agg(
        F.count("offer_id").alias("n"),
        F.sum(lp).alias("l_sum"),
        F.count(lp).alias("l_n"),
        F.sum(o).alias("o_sum"),
        F.count(o).alias("o_n"),
        count_if((o >= floor90) & (o <= lp)).alias("within"),
        count_if(o < floor90).alias("below"),
        count_if(o > lp).alias("above"),
    )
    sums = ("n", "l_sum", "l_n", "o_sum", "o_n", "within", "below", "above")
    props = t["properties"].select("property_id", "neighborhood_id")
    nb = t["neighborhoods"].select("neighborhood_id", "neighborhood_name", "city")
    per_nb = (
        per_property.join(props, "property_id")
        .groupBy("neighborhood_id")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .join(nb, "neighborhood_id")
        .groupBy("neighborhood_name", "city")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )
    avg_l = mean_of_parts("l_sum", "l_n")
    avg_o = mean_of_parts("o_sum", "o_n")
    # (name, city) tie-break: unique sort key for a balanced global sort
    return per_nb.select(
        "neighborhood_name",
        "city",
        F.col("n").alias("total_completed_sales"),
        pg_round(avg_l, 2).alias("avg_asking_price"),
        pg_round(avg_o, 2).alias("avg_final_sale_price"),
        pg_round(pct_change(avg_o, avg_l), 2).alias("avg_price_variance_pct"),
        F.col("within").alias("within_10pct_of_asking"),
        F.col("below").alias("below_10pct_discount"),
        F.col("above").alias("above_asking"),
    ).orderBy(desc("total_completed_sales"), "neighborhood_name", "city").drop("city")


def _inquiries_per_listing(t: Tables) -> DataFrame:
    return (
        t["customer_interactions"]
        .where(F.col("listing_id").isNotNull())
        .groupBy("listing_id")
        .agg(F.count("interaction_id").alias("n_inquiries"))
    )


def rental_vs_sale_demand(t: Tables, as_of=None) -> DataFrame:
    """Per neighborhood: listings, rental and sale inquiries, and closure
    rates (Rented / Rent listings, Sold / Sale listings); neighborhoods
    without Rent listings are dropped (the rental rate would be NULL)."""
    per_listing = t["listings"].select(
        "listing_id", "property_id", "listing_type", "listing_status"
    ).join(_inquiries_per_listing(t), "listing_id", "left")
    inq = F.coalesce(F.col("n_inquiries"), F.lit(0))
    typ, st = F.col("listing_type"), F.col("listing_status")
    per_property = per_listing.groupBy("property_id").agg(
        F.count("listing_id").alias("n_listings"),
        F.sum(F.when(typ == "Rent", inq).otherwise(0)).alias("rent_inq"),
        F.sum(F.when(typ == "Sale", inq).otherwise(0)).alias("sale_inq"),
        count_if(st == "Rented").alias("rented"),
        count_if(typ == "Rent").alias("rent_listings"),
        count_if(st == "Sold").alias("sold"),
        count_if(typ == "Sale").alias("sale_listings"),
    )
    sums = ("n_listings", "rent_inq", "sale_inq", "rented", "rent_listings", "sold", "sale_listings")
    per_nb = (
        per_property.join(t["properties"].select("property_id", "neighborhood_id"), "property_id")
        .groupBy("neighborhood_id")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )
    nb = t["neighborhoods"].select("neighborhood_id", "neighborhood_name", "city")
    rental_rate = pg_round(count_pct("rented", "rent_listings"), 2)
    return (
        per_nb.join(nb, "neighborhood_id")
        .select(
            "neighborhood_id",
            "neighborhood_name",
            "city",
            F.col("n_listings").alias("total_rental_sale_listings"),
            F.col("rent_inq").alias("rental_inquiries"),
            F.col("sale_inq").alias("sale_inquiries"),
            rental_rate.alias("rental_closure_rate"),
            pg_round(count_pct("sold", "sale_listings"), 2).alias("sale_closure_rate"),
        )
        .where(F.col("rental_closure_rate").isNotNull())
        # few cities: neighborhood_id makes the global sort key unique
        .orderBy(asc("city"), "neighborhood_id")
        .drop("city", "neighborhood_id")
    )


def offer_outcomes(t: Tables) -> DataFrame:
    """Offers with their contract's status (a contract belongs to one offer,
    so nothing fans out); the stored table of that name, if there is one."""
    if "offer_outcomes" in t:
        return t["offer_outcomes"]
    return t["offers"].select("offer_id", "listing_id", "status").join(
        t["contracts"].select("offer_id", "contract_status"), "offer_id", "left")


def listing_stage_conversion(t: Tables, as_of=None) -> DataFrame:
    """Listings of the last 12 months per (listing type, city): how many
    reached each pipeline stage (inquiry, offer, accepted offer, closed
    contract) and closed deals as % of inquired listings."""
    listings = t["listings"].where(F.col("listing_date") >= months_before(as_of, 12)).select(
        "listing_id", "property_id", "listing_type"
    )
    inquired = (
        t["customer_interactions"]
        .where(F.col("listing_id").isNotNull())
        .select("listing_id")
        .distinct()
        .withColumn("has_inquiry", F.lit(True))
    )
    # Stage flags per listing from its offers
    offer_stages = (
        offer_outcomes(t)
        .groupBy("listing_id")
        .agg(
            F.lit(True).alias("has_offer"),
            F.max(F.col("status") == "accepted").alias("has_accepted"),
            F.max(F.coalesce(F.col("contract_status") == "closed", F.lit(False))).alias(
                "has_closed"
            ),
        )
    )
    flagged = listings.join(inquired, "listing_id", "left").join(
        offer_stages, "listing_id", "left"
    )
    stages = ("total_listings", "with_inquiries", "with_offers", "offers_accepted", "deals_closed")
    per_property = flagged.groupBy("property_id", "listing_type").agg(
        F.count("listing_id").alias("total_listings"),
        count_if(F.col("has_inquiry")).alias("with_inquiries"),
        count_if(F.col("has_offer")).alias("with_offers"),
        count_if(F.col("has_accepted")).alias("offers_accepted"),
        count_if(F.col("has_closed")).alias("deals_closed"),
    )
    props = t["properties"].select("property_id", "neighborhood_id")
    nb = t["neighborhoods"].select("neighborhood_id", "city")
    return (
        _to_geo(per_property, props, nb)
        .groupBy("listing_type", "city")
        .agg(*[F.sum(c).alias(c) for c in stages])
        .withColumn(
            "inquiry_to_closure_pct", pg_round(count_pct("deals_closed", "with_inquiries"), 2)
        )
        .orderBy(asc("listing_type"), desc("inquiry_to_closure_pct"))
    )


def time_on_market_state(t: Tables, *more: str) -> DataFrame:
    """What :func:`time_on_market` needs of the listings, per property, type
    and the columns ``more``."""
    d = age_day_part("close_date", "listing_date")
    return t["listings"].where(F.col("close_date").isNotNull()).withColumn("d", d).groupBy("property_id", "listing_type", *more).agg(
        F.count("listing_id").alias("n"),
        F.sum(F.col("d").cast("decimal(20,0)")).alias("d_sum"),
        F.count("d").alias("d_n"),
        F.min("d").alias("d_min"),
        F.max("d").alias("d_max"),
    )


def time_on_market(t: Tables, as_of=None, state: DataFrame | None = None) -> DataFrame:
    """Closed listings of the last 12 months per (listing type, city): count
    and mean / min / max AGE day component from listing to close.  A
    ``state`` kept per listing date serves every ``as_of``."""
    recent = F.col("listing_date") >= months_before(as_of, 12)
    if state is None:
        per_property = time_on_market_state({"listings": t["listings"].where(recent)})
    else:
        per_property = state.where(recent)
    props = t["properties"].select("property_id", "neighborhood_id")
    nb = t["neighborhoods"].select("neighborhood_id", "city")
    return (
        _to_geo(per_property, props, nb)
        .groupBy("listing_type", "city")
        .agg(
            F.sum("n").alias("total_listings"),
            pg_round(mean_of_parts(F.sum("d_sum"), F.sum("d_n"), 0), 1).alias("avg_days_on_market"),
            F.min("d_min").alias("min_days"),
            F.max("d_max").alias("max_days"),
        )
        .orderBy(asc("listing_type"), asc("avg_days_on_market"))
    )
