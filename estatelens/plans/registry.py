"""The catalogue of analytical jobs: name -> job, grouped as in the reference
(customer, inventory, operations, market)."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelens.operators import (
    building_blocks,
    customer,
    distinct_sets,
    history,
    inventory,
    market,
    operations,
    quality,
    ranked,
    referential,
    sampling,
)
from estatelens.plans import incremental
from estatelens.sources import bucketed

Job = Callable[..., DataFrame]

ANALYTICS: dict[str, Job] = {
    # customer management
    "interactions_to_close_buckets": customer.interactions_to_close_buckets,
    "pending_contract_timeline": customer.pending_contract_timeline,
    "customer_lead_activity": customer.customer_lead_activity,
    # property & inventory
    "active_inventory_ppsf": inventory.active_inventory_ppsf,
    "units_near_grade_a_high_school": inventory.units_near_grade_a_high_school,
    "neighborhood_price_appreciation": inventory.neighborhood_price_appreciation,
    "walkability_split": inventory.walkability_split,
    "sold_with_price_reduction_pct": inventory.sold_with_price_reduction_pct,
    # corporate operations
    "agent_commissions": operations.agent_commissions,
    "office_revenue_past_quarter": operations.office_revenue_past_quarter,
    "commission_split_by_type": operations.commission_split_by_type,
    "team_sales_performance": operations.team_sales_performance,
    # market analysis & pricing
    "ny_ppsf_by_property_type": market.ny_ppsf_by_property_type,
    "two_bedroom_price_trend": market.two_bedroom_price_trend,
    "asking_vs_accepted_offer": market.asking_vs_accepted_offer,
    "rental_vs_sale_demand": market.rental_vs_sale_demand,
    "listing_stage_conversion": market.listing_stage_conversion,
    "time_on_market": market.time_on_market,
}

# Data-quality reports: declared integrity rules over all 14 tables.  As
# queries they read the tables with broken rows (sources.dirty_tables).
QUALITY: dict[str, Job] = {
    "quality_row_rules": quality.row_rule_report,
    "quality_key_rules": quality.key_rule_report,
    "quality_foreign_keys": quality.foreign_key_report,
    "quality_violations": quality.violation_report,
}

# Referential actions (ON DELETE CASCADE / SET NULL, ON UPDATE CASCADE).
REFERENTIAL: dict[str, Job] = {
    "withdrawn_listing_purge": referential.withdrawn_listing_purge,
    "renter_customer_purge": referential.renter_customer_purge,
    "withdrawn_listing_purge_survivors": referential.withdrawn_listing_purge_survivors,
    "renter_customer_purge_survivors": referential.renter_customer_purge_survivors,
    "agent_renumbering": referential.agent_renumbering,
}

# Row-level checks of the semantic building blocks (windows, dates, casts).
BUILDING_BLOCKS: dict[str, Job] = {
    "listing_first_last_price": building_blocks.listing_first_last_price,
    "listing_days_on_market": building_blocks.listing_days_on_market,
    "interaction_days_to_close": building_blocks.interaction_days_to_close,
    "bedroom_rounding_counts": building_blocks.bedroom_rounding_counts,
    "sold_listing_reductions": building_blocks.sold_listing_reductions,
    "customer_contacts": building_blocks.customer_contacts,
    "agent_licenses": building_blocks.agent_licenses,
    "filled_defaults": building_blocks.filled_defaults,
    "listing_date_windows": building_blocks.listing_date_windows,
    "commission_roundings": building_blocks.commission_roundings,
}

# Jobs whose rows depend on the order, or on all rows of a key, without a
# task for the whole order or key.
ROW_ORDER: dict[str, Job] = {
    "price_change_context": history.price_change_context,
    "sold_listing_cuts": history.sold_listing_cuts,
    "commission_lines": operations.commission_lines,
    "listed_properties": distinct_sets.listed_properties,
    "offer_sample": sampling.offer_sample,
    "interaction_sold_listing": sampling.interaction_sold_listing,
    "ranked_leads": ranked.ranked_leads,
    "ranked_paid_commissions": ranked.ranked_paid_commissions,
    "ranked_open_leads": ranked.ranked_open_leads,
    "ranked_properties_by_city": ranked.ranked_properties_by_city,
    "ranked_price_changes": ranked.ranked_price_changes,
}

# Marts finished from the merged states of three loads.
INCREMENTAL: dict[str, Job] = {
    f"incremental_{name}": partial(incremental.from_batches, name) for name in incremental.MARTS
}

def _from_stored(name: str, tables, as_of=None) -> DataFrame:
    return ANALYTICS[name](bucketed.stored(tables), as_of)


# Jobs over tables that are stored co-partitioned by listing.
STORED: dict[str, Job] = {
    f"stored_{name}": partial(_from_stored, name) for name in ("rental_vs_sale_demand", "listing_stage_conversion")
}

# Results that are not rounded by the query itself; compared at 6 dp.
UNROUNDED = {"sold_with_price_reduction_pct": 6}


def oracle_types(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Cast for engine-neutral comparison: decimals and floats -> DOUBLE
    (optionally rounded), integral types -> BIGINT, others unchanged."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DecimalType, T.FloatType, T.DoubleType)):
            if digits is not None:
                c = F.round(c, digits)
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(cols)
