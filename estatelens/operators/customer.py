"""Customer-management analytics (3 queries).

Each job takes a mapping of table name -> DataFrame (see
:mod:`estatelens.sources`) and returns a lazily planned DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.functions import age_day_part, asc, count_if, desc, elapsed_days, int_mean, pg_round

Tables = Mapping[str, DataFrame]

CLOSED_STATUSES = ("Sold", "Rented")
OPEN_LEAD_STATUSES = ("active", "qualified", "pending")


def interactions_to_close_buckets(t: Tables, as_of=None) -> DataFrame:
    """Interactions on listings with a close date, and how many of those on
    Sold/Rented listings closed <=30, 31-60 and 61-90 whole days after the
    interaction (days may be negative: they fall in the first bucket)."""
    ci = t["customer_interactions"].select("interaction_id", "listing_id", "interaction_dt")
    closed = t["listings"].where(F.col("close_date").isNotNull()).select(
        "listing_id", "listing_status", "close_date"
    )
    days = elapsed_days("close_date", "interaction_dt")
    done = F.col("listing_status").isin(*CLOSED_STATUSES)
    # interaction_id is the key of the probe side and the join is N:1, so a
    # plain count equals COUNT(DISTINCT interaction_id): no extra shuffle.
    return (
        ci.join(closed, "listing_id")
        .withColumn("days", days)
        .agg(
            F.count("interaction_id").alias("total_interactions"),
            count_if(done & (F.col("days") <= 30)).alias("closed_within_30_days"),
            count_if(done & (F.col("days") > 30) & (F.col("days") <= 60)).alias(
                "closed_within_60_days"
            ),
            count_if(done & (F.col("days") > 60) & (F.col("days") <= 90)).alias(
                "closed_within_90_days"
            ),
        )
    )


def pending_contract_timeline(t: Tables, as_of=None) -> DataFrame:
    """Pending/active contracts with an expected close date: count and the
    average / min / max day component of AGE(expected_close, contract_date)."""
    c = t["contracts"].where(
        F.col("contract_status").isin("pending", "active")
        & F.col("expected_close_date").isNotNull()
    )
    d = age_day_part("expected_close_date", "contract_date")
    return c.withColumn("d", d).agg(
        F.count("contract_id").alias("active_contracts_pending"),
        pg_round(int_mean("d"), 1).alias("avg_days_to_closing"),
        F.min("d").alias("min_days_to_closing"),
        F.max("d").alias("max_days_to_closing"),
    )


def customer_lead_activity(t: Tables, as_of=None) -> DataFrame:
    """Per customer with at least one lead in an open pipeline status: leads
    in the pipeline, all offers, their contracts and closed contracts.

    Leads and offers are independent children of a customer; instead of
    joining them (a leads x offers blow-up repaired by COUNT DISTINCT) each
    is aggregated to the customer first and the results joined 1:1.
    """
    leads = (
        t["leads"]
        .where(F.col("lead_status").isin(*OPEN_LEAD_STATUSES))
        .groupBy("customer_id")
        .agg(F.count("lead_id").alias("leads_in_pipeline"))
    )
    # offer_id is UNIQUE in contracts, so this left join never fans out.
    offers = (
        t["offers"]
        .select("offer_id", "customer_id")
        .join(t["contracts"].select("offer_id", "contract_id", "contract_status"), "offer_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count("offer_id").alias("offers_submitted"),
            F.count("contract_id").alias("contracts"),
            count_if(F.col("contract_status") == "closed", "contract_id").alias("deals_closed"),
        )
    )
    cu = t["customers"].select("customer_id", "first_name", "last_name", "email")
    # The sort key has few distinct values; customer_id (a group key, ties
    # are unordered in the reference) makes it unique so the range
    # partitioner of the global sort can balance the output.
    return (
        cu.join(leads, "customer_id")
        .join(offers, "customer_id", "left")
        .select(
            "customer_id",
            "first_name",
            "last_name",
            "email",
            "leads_in_pipeline",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("offers_submitted", "contracts", "deals_closed")],
        )
        .orderBy(desc("leads_in_pipeline"), asc("customer_id"))
        .drop("customer_id")
    )
