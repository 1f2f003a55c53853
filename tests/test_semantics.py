"""Query semantics on tiny literal tables (edge cases of FIXTURES.md §3)."""

from decimal import Decimal

from estatelens.operators import customer, inventory, market
from helpers import D, d, tables, ts

AS_OF = "2024-02-01"


def nb(i, score=80, state="NY", city="C", name=None):
    return dict(neighborhood_id=i, neighborhood_name=name or f"N{i}", city=city, state=state,
                zip_code="10001", walkability_score=score)


def prop(i, n, bedroom="2.0", sqft=1000, ptype="Condo"):
    return dict(property_id=i, address="a", neighborhood_id=n, property_type=ptype,
                rooms=D("5.0"), bedroom=D(bedroom), bathroom=D("1.0"), sqft=sqft, price=D(1))


def lst(i, p, ltype="Sale", status="Active", price="100.00", date="2023-06-01", close=None):
    return dict(listing_id=i, property_id=p, agent_id=1, listing_type=ltype,
                listing_date=d(date), listing_price=D(price), listing_status=status,
                close_date=d(close))


def test_customer_lead_activity_no_fanout_and_lost_only_absent(spark):
    t = tables(
        spark,
        customers=[dict(customer_id=i, first_name="f", last_name="l", email=f"e{i}",
                        customer_type="buyer", created_date=d("2023-01-01")) for i in (1, 2)],
        leads=[dict(lead_id=1, customer_id=1, lead_date=d("2023-01-01"), lead_status="active"),
               dict(lead_id=2, customer_id=1, lead_date=d("2023-01-01"), lead_status="active"),
               dict(lead_id=3, customer_id=2, lead_date=d("2023-01-01"), lead_status="lost")],
        offers=[dict(offer_id=i, customer_id=1, listing_id=1, offer_price=D(1),
                     offer_date=d("2023-01-01"), status="submitted") for i in (1, 2, 3)],
        contracts=[dict(contract_id=1, offer_id=1, contract_type="purchase",
                        contract_date=d("2023-02-01"), contract_status="closed")],
    )
    rows = customer.customer_lead_activity(t).collect()
    assert [(r.email, r.leads_in_pipeline, r.offers_submitted, r.contracts, r.deals_closed)
            for r in rows] == [("e1", 2, 3, 1, 1)]


def test_interaction_buckets(spark):
    t = tables(
        spark,
        listings=[lst(1, 1, status="Sold", close="2024-01-10"),
                  lst(2, 1, status="Expired", close="2024-01-10"),
                  lst(3, 1, status="Sold", close="2024-03-20")],
        customer_interactions=[
            dict(interaction_id=1, customer_id=1, listing_id=1, interaction_dt=ts("2024-01-15 10:00:00")),
            dict(interaction_id=2, customer_id=1, listing_id=2, interaction_dt=ts("2024-01-01 00:00:00")),
            dict(interaction_id=3, customer_id=1, listing_id=3, interaction_dt=ts("2024-01-15 10:00:00")),
            dict(interaction_id=4, customer_id=1, listing_id=None, interaction_dt=ts("2024-01-15 10:00:00")),
        ],
    )
    r = customer.interactions_to_close_buckets(t).first()
    # 1: -5 days -> first bucket; 2: Expired -> total only; 3: 64 days -> third bucket
    assert tuple(r) == (3, 1, 0, 1)


def test_grade_a_schools_counted_once(spark):
    school = lambda i, n: dict(school_id=i, school_name="s", grade_level="High",
                               school_rating="A", neighborhood_id=n)
    t = tables(spark, neighborhoods=[nb(1), nb(2)], schools=[school(1, 1), school(2, 1)],
               properties=[prop(1, 1), prop(2, 1), prop(3, 2)])
    rows = inventory.units_near_grade_a_high_school(t).collect()
    assert [(r.neighborhood_name, r.housing_units_within_zipcode) for r in rows] == [("N1", 2)]


def test_walkability_boundaries(spark):
    scores = [49, 50, 69, 70, None]
    t = tables(spark, neighborhoods=[nb(i + 1, s) for i, s in enumerate(scores)],
               properties=[prop(i + 1, i + 1) for i in range(5)])
    rows = inventory.walkability_split(t).collect()
    assert [(r.walkability_category, r.property_count) for r in rows] == [
        ("Car-dependent", 1), ("Walkable", 1)]


def hist(i, listing, old, new, when):
    return dict(price_history_id=i, listing_id=listing, old_price=D(old), new_price=D(new),
                change_date=ts(when) if when else None)


def test_price_span_null_date_is_latest_and_ties_by_id(spark):
    t = tables(spark, property_price_history=[
        hist(1, 1, "100", "90", "2024-01-01 00:00:00"),
        hist(2, 1, "90", "80", None),
        hist(3, 1, "80", "85", "2024-02-01 00:00:00"),
        hist(4, 2, "50", "60", "2024-01-01 00:00:00"),
        hist(5, 2, "70", "75", "2024-01-01 00:00:00"),
    ])
    got = {r.listing_id: (r.first_price, r.last_price)
           for r in inventory.listing_price_span(t["property_price_history"]).collect()}
    assert got == {1: (Decimal("100.00"), Decimal("80.00")), 2: (Decimal("50.00"), Decimal("75.00"))}


def test_appreciation_drops_zero_first_price(spark):
    t = tables(spark, neighborhoods=[nb(1)], properties=[prop(1, 1)],
               listings=[lst(1, 1), lst(2, 1)],
               property_price_history=[hist(1, 1, "100", "110", "2024-01-01 00:00:00"),
                                       hist(2, 2, "0", "10", "2024-01-01 00:00:00")])
    r = inventory.neighborhood_price_appreciation(t).collect()
    assert [(x.avg_price_appreciation_pct, x.listings_with_price_changes) for x in r] == [
        (Decimal("10.00"), 1)]


def test_reduction_on_close_day_counts_only_at_midnight(spark):
    t = tables(spark,
               listings=[lst(1, 1, status="Sold", close="2024-01-10"),
                         lst(2, 1, status="Sold", close="2024-01-10"),
                         lst(3, 1, status="Sold", close="2024-01-10"),
                         lst(4, 1, status="Sold", close="2024-01-10")],
               property_price_history=[hist(1, 1, "100", "90", "2024-01-10 00:00:00"),
                                       hist(2, 2, "100", "90", "2024-01-10 00:00:01"),
                                       hist(3, 3, "100", "110", "2024-01-01 00:00:00")])
    r = inventory.sold_with_price_reduction_pct(t).first()
    assert r.pct_sold_with_reduction == Decimal("25")


def test_ny_ppsf_keeps_listing_price_groups(spark):
    t = tables(spark, neighborhoods=[nb(1)], properties=[prop(1, 1)],
               listings=[lst(1, 1, status="Sold", price="100000.00"),
                         lst(2, 1, status="Sold", price="200000.00")])
    rows = market.ny_ppsf_by_property_type(t).collect()
    assert [(r.property_type, r.avg_price_per_sqft) for r in rows] == [
        ("Condo", Decimal("200.00")), ("Condo", Decimal("100.00"))]


def test_two_bedroom_trend_lags_previous_present_month(spark):
    t = tables(spark, neighborhoods=[nb(1)], properties=[prop(1, 1, "2.4"), prop(2, 1, "2.5")],
               listings=[lst(1, 1, price="100.00", date="2023-06-03"),
                         lst(2, 1, price="150.00", date="2023-08-09"),
                         lst(3, 2, price="999.00", date="2023-08-09")])
    rows = market.two_bedroom_price_trend(t, AS_OF).collect()
    assert [(str(r.listing_month), r.avg_listing_price, r.month_over_month_pct_change)
            for r in rows] == [("2023-08-01", Decimal("150.00"), Decimal("50.00")),
                               ("2023-06-01", Decimal("100.00"), None)]


def test_offer_bands_are_inclusive(spark):
    offer = lambda i, price: dict(offer_id=i, customer_id=1, listing_id=1, offer_price=D(price),
                                  offer_date=d("2023-01-01"), status="accepted")
    t = tables(spark, neighborhoods=[nb(1)], properties=[prop(1, 1)],
               listings=[lst(1, 1, price="100.00")],
               offers=[offer(1, "90.00"), offer(2, "100.00"), offer(3, "89.99"), offer(4, "100.01")])
    r = market.asking_vs_accepted_offer(t).first()
    assert (r.total_completed_sales, r.within_10pct_of_asking, r.below_10pct_discount,
            r.above_asking) == (4, 2, 1, 1)
    assert r.avg_price_variance_pct == Decimal("-5.00")


def test_rental_demand_drops_sale_only_neighborhoods(spark):
    t = tables(spark, neighborhoods=[nb(1), nb(2), nb(3)],
               properties=[prop(1, 1), prop(2, 2)],
               listings=[lst(1, 1, "Rent", "Active"), lst(2, 2, "Sale", "Sold")],
               customer_interactions=[dict(interaction_id=1, customer_id=1, listing_id=1,
                                           interaction_dt=ts("2024-01-01 00:00:00"))])
    rows = market.rental_vs_sale_demand(t).collect()
    assert [(r.neighborhood_name, r.total_rental_sale_listings, r.rental_inquiries,
             r.rental_closure_rate, r.sale_closure_rate) for r in rows] == [
        ("N1", 1, 1, Decimal("0.00"), None)]


def test_stage_conversion_without_inquiries_has_null_pct(spark):
    t = tables(spark, neighborhoods=[nb(1)], properties=[prop(1, 1)],
               listings=[lst(1, 1, date="2023-06-01")],
               offers=[dict(offer_id=1, customer_id=1, listing_id=1, offer_price=D(1),
                            offer_date=d("2023-06-02"), status="accepted")],
               contracts=[dict(contract_id=1, offer_id=1, contract_type="purchase",
                               contract_date=d("2023-06-03"), contract_status="closed")])
    r = market.listing_stage_conversion(t, AS_OF).first()
    assert (r.total_listings, r.with_inquiries, r.with_offers, r.offers_accepted,
            r.deals_closed, r.inquiry_to_closure_pct) == (1, 0, 1, 1, 1, None)


def test_price_span_orders_by_wall_clock_in_any_session_zone(spark):
    # 02:30 does not exist in New York on 2024-03-10; wall-clock order must
    # still put it before 03:00, and sub-second differences must count.
    t = tables(spark, property_price_history=[
        hist(1, 1, "100", "90", "2024-03-10 03:00:00"),
        hist(2, 1, "95", "85", "2024-03-10 02:30:00"),
        hist(3, 2, "10", "11", "2024-01-01 00:00:00.000002"),
        hist(4, 2, "20", "21", "2024-01-01 00:00:00.000001"),
    ])
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = {r.listing_id: (r.first_price, r.last_price)
               for r in inventory.listing_price_span(t["property_price_history"]).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {1: (Decimal("95.00"), Decimal("90.00")), 2: (Decimal("20.00"), Decimal("11.00"))}


def test_reduction_pct_without_sold_listings_raises(spark):
    import pytest

    t = tables(spark, listings=[lst(1, 1, status="Active")])
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        inventory.sold_with_price_reduction_pct(t).collect()


def test_null_listing_price_is_ignored_by_averages_but_counted(spark):
    t = tables(spark, neighborhoods=[nb(1)], properties=[prop(1, 1, sqft=1000), prop(2, 1, sqft=1000)],
               listings=[lst(1, 1, price="200000.00"), lst(2, 2, price=None)])
    (r,) = inventory.active_inventory_ppsf(t).collect()
    assert (r.property_count, r.avg_price_per_sqft) == (2, Decimal("200.00"))
    offer = lambda i, lid, price: dict(offer_id=i, customer_id=1, listing_id=lid, offer_price=D(price),
                                       offer_date=d("2023-01-01"), status="accepted")
    t = tables(spark, neighborhoods=[nb(1)], properties=[prop(1, 1)],
               listings=[lst(1, 1, price="100.00"), lst(2, 1, price=None)],
               offers=[offer(1, 1, "95.00"), offer(2, 2, "50.00")])
    (r,) = market.asking_vs_accepted_offer(t).collect()
    assert (r.total_completed_sales, r.avg_asking_price, r.avg_final_sale_price) == (
        2, Decimal("100.00"), Decimal("72.50"))
    assert (r.within_10pct_of_asking, r.below_10pct_discount, r.above_asking) == (1, 0, 0)
