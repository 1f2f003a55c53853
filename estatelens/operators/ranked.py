"""Results with their place in a total order.

The ordinal equals ``row_number()`` over the whole result.  It is put
together from range-partitioned rows and the number of rows before each
partition, so no task sees all rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.functions import asc, desc
from estatelens.operators.customer import OPEN_LEAD_STATUSES
from estatelens.operators.ordered import with_ordinal

Tables = Mapping[str, DataFrame]


def ranked_leads(t: Tables, as_of=None) -> DataFrame:
    """Every lead by its key (one key, ascending)."""
    return with_ordinal(t["leads"].select("lead_id"), [asc("lead_id")])


def ranked_paid_commissions(t: Tables, as_of=None) -> DataFrame:
    """Paid commissions by agent (ascending), amount (descending) and id;
    NULLs are last ascending and first descending, as in PostgreSQL."""
    paid = t["commissions"].where(F.col("status") == "paid").select("commission_id", "agent_id", "commission_amount")
    return with_ordinal(paid, [asc("agent_id"), desc("commission_amount"), asc("commission_id")])


def ranked_open_leads(t: Tables, as_of=None) -> DataFrame:
    """Customers by the number of their leads in the pipeline, an output
    alias (descending), then id."""
    open_ = t["leads"].where(F.col("lead_status").isin(*OPEN_LEAD_STATUSES)).groupBy("customer_id").agg(
        F.count("lead_id").alias("leads_in_pipeline"))
    return with_ordinal(open_, [desc("leads_in_pipeline"), asc("customer_id")])


def ranked_properties_by_city(t: Tables, as_of=None) -> DataFrame:
    """Properties by the city of their neighborhood, which is not output,
    then id."""
    placed = t["properties"].select("property_id", "neighborhood_id").join(
        t["neighborhoods"].select("neighborhood_id", "city"), "neighborhood_id", "left")
    return with_ordinal(placed.select("property_id", "city"), [asc("city"), asc("property_id")]).drop("city")


def ranked_price_changes(t: Tables, as_of=None) -> DataFrame:
    """Price changes by date, latest first and NULL dates before them, then
    id; and their place with NULL dates last in ascending order."""
    rows = t["property_price_history"].select("price_history_id", "change_date")
    down = with_ordinal(rows, [desc("change_date"), asc("price_history_id")], "latest_first")
    return with_ordinal(down, [asc("change_date"), asc("price_history_id")], "earliest_first").drop("change_date")
