"""Corporate-operations analytics (4 queries).

Commissions and listings are the large tables; offices, teams and agents are
lookups.  Every job aggregates the large table to the lookup key first and
joins the (much smaller) aggregate, so the join input shrinks from one row
per fact to one row per key, and a hot agent or office is combined map-side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.functions import (
    age_day_part,
    asc,
    desc,
    mean_of_parts,
    months_before,
    pg_round,
)
from estatelens.operators.heavy import split_join

Tables = Mapping[str, DataFrame]


def _paid(t: Tables) -> DataFrame:
    return t["commissions"].where(F.col("status") == "paid")


def agent_commission_state(t: Tables) -> DataFrame:
    """What :func:`agent_commissions` needs of the commissions in ``t``."""
    return _paid(t).groupBy("agent_id", "commission_type").agg(
        F.count("commission_id").alias("commission_count"), F.sum("commission_amount").alias("total"))


def agent_commissions(t: Tables, as_of=None, state: DataFrame | None = None) -> DataFrame:
    """Paid commissions per agent and commission type: count and total.
    ``state`` stands for the commissions where they were summed up before."""
    per_agent = agent_commission_state(t) if state is None else state
    agents = t["agents"].select("agent_id", "first_name", "last_name", "email")
    return (
        per_agent.join(agents, "agent_id")
        .select(
            "agent_id",
            "first_name",
            "last_name",
            "email",
            "commission_type",
            "commission_count",
            pg_round("total", 2).alias("total_commission"),
        )
        .orderBy(asc("agent_id"), desc("total_commission"))
    )


def office_revenue_past_quarter(t: Tables, as_of=None) -> DataFrame:
    """Paid commissions per office since as_of minus 3 months (no upper bound)."""
    recent = _paid(t).where(F.col("paid_date") >= months_before(as_of, 3))
    per_office = recent.groupBy("office_id").agg(
        F.sum("commission_amount").alias("total"),
        F.count("commission_id").alias("commission_count"),
    )
    offices = t["offices"].select("office_id", "office_name", "city", "state")
    return (
        per_office.join(offices, "office_id")
        .select(
            "office_id",
            "office_name",
            "city",
            "state",
            pg_round("total", 2).alias("total_revenue_past_quarter"),
            "commission_count",
        )
        .orderBy(desc("total_revenue_past_quarter"))
    )


_SPLIT_MEANS = ("commission_amount", "commission_rate", "split_percentage")


def commission_split_state(t: Tables) -> DataFrame:
    """What :func:`commission_split_by_type` needs of the commissions."""
    return _paid(t).groupBy("commission_type").agg(
        F.count("commission_id").alias("commission_count"),
        *[x for c in _SPLIT_MEANS for x in (F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n"))])


def commission_split_by_type(t: Tables, as_of=None, state: DataFrame | None = None) -> DataFrame:
    """Paid commissions per type: count and mean amount, rate and split, and
    the implied company share 100 - mean split."""
    per_type = commission_split_state(t) if state is None else state
    amount, rate, split = (mean_of_parts(f"{c}_sum", f"{c}_n") for c in _SPLIT_MEANS)
    return per_type.select(
        "commission_type",
        "commission_count",
        pg_round(amount, 2).alias("avg_commission_amount"),
        pg_round(rate, 2).alias("avg_commission_rate_pct"),
        pg_round(split, 2).alias("avg_agent_split_pct"),
        pg_round(F.lit(100) - split, 2).alias("avg_company_split_pct"),
    ).orderBy(asc("commission_type"))


def commission_lines(t: Tables, as_of=None) -> DataFrame:
    """Every commission with its agent's name, team and office.

    An agent with many commissions is split off before the join
    (:func:`estatelens.operators.heavy.split_join`), so the join does not
    rely on adaptive execution."""
    agents = t["agents"].select(F.col("agent_id"), "last_name", F.col("team_id").alias("agent_team"))
    lines = split_join(t["commissions"].select("commission_id", "agent_id", "office_id", "commission_amount"), agents, ["agent_id"])
    lines = lines.join(t["teams"].select(F.col("team_id").alias("agent_team"), "team_name"), "agent_team", "left")
    return lines.join(t["offices"].select("office_id", "office_name"), "office_id", "left").select(
        "commission_id", "last_name", "team_name", "office_name", "commission_amount")


def team_sales_performance(t: Tables, as_of=None) -> DataFrame:
    """Sold/Rented listings with a close date per team: count, mean price and
    mean AGE day component from listing to close."""
    closed = t["listings"].where(
        F.col("listing_status").isin("Sold", "Rented") & F.col("close_date").isNotNull()
    )
    days = age_day_part("close_date", "listing_date")
    # Partial sums per agent, then per team: exact, and the listings never
    # travel to the (small) agents/teams join.
    per_agent = closed.groupBy("agent_id").agg(
        F.count("listing_id").alias("n"),
        F.sum("listing_price").alias("price_sum"),
        F.count("listing_price").alias("price_n"),
        F.sum(days.cast("decimal(20,0)")).alias("days_sum"),
        F.count(days).alias("days_n"),
    )
    per_team = (
        per_agent.join(t["agents"].select("agent_id", "team_id"), "agent_id")
        .groupBy("team_id")
        .agg(*[F.sum(c).alias(c) for c in ("n", "price_sum", "price_n", "days_sum", "days_n")])
    )
    teams = t["teams"].select("team_id", "team_name", "region")
    return (
        per_team.join(teams, "team_id")
        .select(
            "team_id",
            "team_name",
            "region",
            F.col("n").alias("total_sales"),
            pg_round(mean_of_parts("price_sum", "price_n"), 2).alias("avg_sales_price"),
            pg_round(mean_of_parts("days_sum", "days_n", 0), 1).alias("avg_days_on_market"),
        )
        .orderBy(desc("avg_sales_price"), asc("avg_days_on_market"))
    )
