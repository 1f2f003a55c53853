"""Marts kept up to date load by load.

Each load is reduced to a partial state (sums, counts, extremes, and keys
where distinct values are counted), stored under its batch number.  States
of the same group merge by adding, so a mart is finished from the merged
states and the small tables, and no load is read twice.  A replayed batch
replaces its own state.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.operators import market, operations

Tables = Mapping[str, DataFrame]
BATCH = "state_batch"


@dataclass(frozen=True)
class IncrementalMart:
    """``facts`` is the table that loads append to; ``keys`` identify a row
    of a state; other columns are added up unless named in ``least`` or
    ``most``."""

    facts: str
    keys: tuple[str, ...]
    state: Callable[[Tables], DataFrame]
    finish: Callable[..., DataFrame]
    least: tuple[str, ...] = ()
    most: tuple[str, ...] = ()

    def merge(self, states: DataFrame) -> DataFrame:
        """One state from the rows of several, with the columns' types."""
        out = []
        for f in states.schema.fields:
            if f.name in self.keys:
                continue
            how = F.min if f.name in self.least else F.max if f.name in self.most else F.sum
            out.append(how(f.name).cast(f.dataType).alias(f.name))
        return states.groupBy(*self.keys).agg(*out)


MARTS: dict[str, IncrementalMart] = {
    "agent_commissions": IncrementalMart(
        "commissions", ("agent_id", "commission_type"), operations.agent_commission_state, operations.agent_commissions),
    "commission_split_by_type": IncrementalMart(
        "commissions", ("commission_type",), operations.commission_split_state, operations.commission_split_by_type),
    "ny_ppsf_by_property_type": IncrementalMart(
        "listings", ("property_id", "listing_price"), market.ny_ppsf_state, market.ny_ppsf_by_property_type),
    "time_on_market": IncrementalMart(
        "listings", ("property_id", "listing_type", "listing_date"), lambda t: market.time_on_market_state(t, "listing_date"),
        market.time_on_market, ("d_min",), ("d_max",)),
}


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_states/{name}"


def add_batch(root: str, name: str, facts: DataFrame, batch: int) -> None:
    """Store the state of one load; again with the same number replaces it."""
    mart = MARTS[name]
    state = mart.state({mart.facts: facts}).withColumn(BATCH, F.lit(batch).cast("long"))
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(_path(root, name))


def merged_state(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The state of all loads together."""
    return MARTS[name].merge(spark.read.parquet(_path(root, name)).drop(BATCH))


def finish(spark: SparkSession, root: str, name: str, tables: Tables, as_of=None) -> DataFrame:
    """The mart as of ``as_of`` from the stored states."""
    return MARTS[name].finish(tables, as_of, state=merged_state(spark, root, name))


def from_batches(name: str, tables: Tables, as_of=None, batches: int = 3) -> DataFrame:
    """The mart from the merged states of ``batches`` parts of the facts, by
    primary key, without storing them: what ``batches`` loads would give."""
    from estatelens.schemas import TABLES

    mart = MARTS[name]
    facts = tables[mart.facts]
    part = F.pmod(F.xxhash64(TABLES[mart.facts].primary_key), F.lit(batches))
    states = [mart.state({mart.facts: facts.where(part == b)}) for b in range(batches)]
    union = states[0]
    for s in states[1:]:
        union = union.unionByName(s)
    return mart.finish(tables, as_of, state=mart.merge(union))
