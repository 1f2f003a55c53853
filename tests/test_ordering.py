"""Each analytical job returns rows in its ORDER BY, with PostgreSQL NULL
placement (ASC: NULLs last, DESC: NULLs first).  The correctness gate
compares results order-insensitively, so ordering is checked here."""

import pytest

from estatelens.plans.registry import ANALYTICS
from estatelens.schemas import TABLES
from helpers import frame
from test_random_oracle import _tables

# job -> ORDER BY (column, direction); keys that are not output are omitted
ORDER = {
    "customer_lead_activity": [("leads_in_pipeline", "desc")],
    "active_inventory_ppsf": [("listing_type", "asc"), ("avg_price_per_sqft", "desc")],
    "units_near_grade_a_high_school": [("housing_units_within_zipcode", "desc")],
    "neighborhood_price_appreciation": [("avg_price_appreciation_pct", "desc")],
    "walkability_split": [("walkability_category", "asc")],
    "agent_commissions": [("agent_id", "asc"), ("total_commission", "desc")],
    "office_revenue_past_quarter": [("total_revenue_past_quarter", "desc")],
    "commission_split_by_type": [("commission_type", "asc")],
    "team_sales_performance": [("avg_sales_price", "desc"), ("avg_days_on_market", "asc")],
    "ny_ppsf_by_property_type": [("property_type", "asc"), ("avg_price_per_sqft", "desc")],
    "two_bedroom_price_trend": [("listing_month", "desc"), ("neighborhood_name", "asc")],
    "asking_vs_accepted_offer": [("total_completed_sales", "desc")],
    "listing_stage_conversion": [("listing_type", "asc"), ("inquiry_to_closure_pct", "desc")],
    "time_on_market": [("listing_type", "asc"), ("avg_days_on_market", "asc")],
}




def _is_sorted(rows, spec):
    for a, b in zip(rows, rows[1:]):
        for col, direction in spec:
            x, y = a[col], b[col]
            if x == y:
                continue
            if direction == "asc":
                ok = y is None or (x is not None and x < y)
            else:
                ok = x is None or (y is not None and x > y)
            assert ok, f"{col} {direction}: {x!r} before {y!r}"
            break


@pytest.fixture(scope="module")
def random_tables(spark):
    rows = _tables(7)
    return {name: frame(spark, name, rows[name]) for name in TABLES}


@pytest.mark.parametrize("name", sorted(ORDER))
def test_rows_follow_order_by(random_tables, name):
    rows = [r.asDict() for r in ANALYTICS[name](random_tables, "2024-02-01").collect()]
    _is_sorted(rows, ORDER[name])


def test_every_sorted_job_is_listed():
    unsorted = {"interactions_to_close_buckets", "pending_contract_timeline",
                "sold_with_price_reduction_pct", "rental_vs_sale_demand"}  # one row / key not output
    assert set(ANALYTICS) - unsorted == set(ORDER)
