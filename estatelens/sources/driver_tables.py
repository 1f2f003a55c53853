"""Derive the 14 brokerage tables from the driver's TPC-H-style Parquet.

The test harness only ships TPC-H-like tables (``region nation customer
supplier part orders lineitem events``).  This module re-shapes them into the
brokerage model with plain DataFrame column expressions and equi-joins, so
every query's work grows with the driver data.  The same rules are written
as DuckDB SQL in :mod:`estatelens.plans.oracle` for the correctness oracle.

Everything is lazy: a query that touches three tables only plans (and only
scans the columns of) the driver tables behind those three.
"""

from __future__ import annotations

import datetime as dt
import weakref
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estatelens.schemas import conform

# Fixed value: the date the derived data is anchored to; queries run "as of" it.
AS_OF = dt.date(2024, 2, 1)

#: Rows that one part of a sort by listing gets on average.
ROWS_A_PART = 500_000


def cycle(x: Column, values: tuple[str, ...]) -> Column:
    """values[x mod len(values)] - a deterministic categorical column."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(x, F.lit(len(values))) + 1).cast("int"))


def fdiv(x: Column, n: int) -> Column:
    """floor(x / n) as BIGINT."""
    return F.floor(x / F.lit(n)).cast("bigint")


def plus_days(base: str, n: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), n.cast("int"))


def txt(x: Column) -> Column:
    return x.cast("string")


def dec_frac(num: Column, den: int, p: int, s: int, num_prec: int = 6) -> Column:
    """cast(cast(num as decimal(num_prec,0)) / den as decimal(p,s))."""
    return (num.cast(f"decimal({num_prec},0)") / F.lit(den)).cast(f"decimal({p},{s})")


_STATES = ("NY", "NJ", "CT")


class DriverTables(Mapping[str, DataFrame]):
    """Read-only mapping ``table name -> DataFrame`` over one driver directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    # -- Mapping protocol -------------------------------------------------
    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            builder = getattr(self, "_" + name, None)
            if builder is None:
                raise KeyError(name)
            self._cache[name] = conform(builder(), name)
        return self._cache[name]

    def __iter__(self) -> Iterator[str]:
        from estatelens.schemas import TABLE_NAMES

        return iter(TABLE_NAMES)

    def __len__(self) -> int:
        return 14

    def src(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _dealt(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` dealt by listing.  The parts follow the number of rows of
        the driver table ``name``, so that what a task sorts stays as small
        on any input (counting a table's rows reads its footers)."""
        return rows.repartition(1 + self.src(name).count() // ROWS_A_PART, "listing_id")

    # -- the 14 tables ----------------------------------------------------
    def _offices(self) -> DataFrame:
        r = self.src("region")
        k = F.col("r_regionkey")
        return r.select(
            (k + 1).cast("bigint").alias("office_id"),
            F.concat(F.lit("Office "), "r_name").alias("office_name"),
            F.concat(F.lit("1"), txt(k), F.lit(" Main St")).alias("address"),
            F.col("r_name").alias("city"),
            cycle(k, _STATES).alias("state"),
            txt(k + 10000).alias("zip_code"),
            F.lit(None).cast("string").alias("phone"),
        )

    def _teams(self) -> DataFrame:
        n = self.src("nation")
        k = F.col("n_nationkey")
        return n.select(
            (k + 1).cast("bigint").alias("team_id"),
            F.concat("n_name", F.lit(" Group")).alias("team_name"),
            F.lit(None).cast("bigint").alias("team_lead_id"),
            (F.col("n_regionkey") + 1).cast("bigint").alias("office_id"),
            plus_days("2019-02-01", k * 60).alias("established_date"),
            cycle(k, _STATES).alias("region"),
        )

    def _agents(self) -> DataFrame:
        # nation has 25 rows at every scale factor (TPC-H), so the
        # planner's size check always broadcasts it.
        s = self.src("supplier").join(
            self.src("nation").select("n_nationkey", "n_regionkey"),
            F.col("s_nationkey") == F.col("n_nationkey"),
        )
        k = F.col("s_suppkey")
        return s.select(
            (k + 1).alias("agent_id"),
            (F.col("n_regionkey") + 1).cast("bigint").alias("office_id"),
            (F.col("s_nationkey") + 1).cast("bigint").alias("team_id"),
            F.concat(F.lit("First"), txt(k)).alias("first_name"),
            F.col("s_name").alias("last_name"),
            F.concat(F.lit("agent"), txt(k), F.lit("@example.com")).alias("email"),
            F.lit(None).cast("string").alias("phone"),
            F.concat(F.lit("LIC-"), txt(k + 10000)).alias("license_number"),
            plus_days("2018-02-01", F.pmod(k, F.lit(2190))).alias("hire_date"),
            cycle(k, ("Active", "Inactive", "Retired")).alias("status"),
            cycle(k, ("Standard", "Premium", "Executive")).alias("commission_tier"),
        )

    def _neighborhoods(self) -> DataFrame:
        p = self.src("part").where(F.col("p_partkey") % 10 == 0)
        nk = fdiv(F.col("p_partkey"), 10)
        return p.select(
            (nk + 1).alias("neighborhood_id"),
            F.concat(F.lit("Nbhd "), txt(nk)).alias("neighborhood_name"),
            F.concat(F.lit("City "), txt(nk % 7)).alias("city"),
            cycle(nk, _STATES).alias("state"),
            txt(nk % 50 + 10000).alias("zip_code"),
            (F.col("p_size") % 61 + 40).alias("walkability_score"),
        )

    def _schools(self) -> DataFrame:
        p = self.src("part")
        k = F.col("p_partkey")
        return p.select(
            (k + 1).alias("school_id"),
            F.concat("p_name", F.lit(" Academy")).alias("school_name"),
            cycle(F.col("p_size"), ("Elementary", "Middle", "High", "K12", "Other")).alias(
                "grade_level"
            ),
            cycle(k, ("A", "B", "C")).alias("school_rating"),
            (fdiv(k, 10) + 1).alias("neighborhood_id"),
            F.concat(txt(k), F.lit(" School St")).alias("address"),
        )

    def _properties(self) -> DataFrame:
        p = self.src("part")
        k = F.col("p_partkey")
        return p.select(
            (k + 1).alias("property_id"),
            F.concat(txt(k), F.lit(" Elm St")).alias("address"),
            (fdiv(k, 10) + 1).alias("neighborhood_id"),
            cycle(k, ("Single-family", "Condo", "Townhouse", "Multi-unit")).alias(
                "property_type"
            ),
            dec_frac(k % 70 + 30, 10, 2, 1, 4).alias("rooms"),
            dec_frac((k * 7) % 41 + 10, 10, 2, 1, 4).alias("bedroom"),
            dec_frac((k * 3) % 31 + 10, 10, 2, 1, 4).alias("bathroom"),
            F.when(k % 23 != 0, F.col("p_size") * 75 + 450).alias("sqft"),
            (F.col("p_retailprice") * 1000).cast("decimal(14,2)").alias("price"),
        )

    @staticmethod
    def _listing_cols(o: Column, custkey: Column, totalprice: Column) -> list[Column]:
        prop = fdiv(o * 2, 15)
        # every fifth neighborhood has no rental
        is_rent = (prop % 4 == 3) & (fdiv(prop, 10) % 5 != 0)
        listing_date = plus_days("2022-02-01", (o * 13) % 730)
        status = (
            F.when(custkey % 5 == 0, "Active")
            .when(custkey % 5 == 1, "Pending")
            .when(custkey % 5 == 2, F.when(is_rent, "Rented").otherwise("Sold"))
            .when(custkey % 5 == 3, "Expired")
            .otherwise("Withdrawn")
        )
        return [
            (o + 1).alias("listing_id"),
            (prop + 1).alias("property_id"),
            (fdiv(custkey, 15) + 1).alias("agent_id"),
            F.when(is_rent, "Rent").otherwise("Sale").alias("listing_type"),
            listing_date.alias("listing_date"),
            totalprice.cast("decimal(14,2)").alias("listing_price"),
            status.alias("listing_status"),
            F.when(o % 5 < 2, F.date_add(listing_date, (o % 150).cast("int"))).alias(
                "close_date"
            ),
            F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("last_updated"),
        ]

    def _listings(self) -> DataFrame:
        return self.src("orders").select(
            *self._listing_cols(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice"))
        )

    def _property_price_history(self) -> DataFrame:
        # One price change per line item.  The surrogate key is the line's
        # rank inside its order, offset by a multiple of the key range:
        # unique and ordered like (listing, line) without a global sort.
        li = self.src("lineitem")
        li = self._dealt(li.withColumn("listing_id", F.col("l_orderkey") + 1), "lineitem")
        w = Window.partitionBy("listing_id").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"
        )
        key_range = self.src("orders").select(F.max("o_orderkey") + 1).scalar()
        old = F.col("l_extendedprice").cast("decimal(14,2)")
        # a discount of 5 % would leave the price as it is: those are cut by 10 %
        factor = F.when(F.round(F.col("l_discount") * 100) == 5, F.lit(0.9)).otherwise(
            F.col("l_discount") + 0.95).cast("decimal(4,2)")
        listings = self["listings"].select("listing_id", "listing_date")
        return (
            li.withColumn("rn", F.row_number().over(w))
            .join(listings, "listing_id")
            .select(
                (F.col("listing_id") - 1 + (F.col("rn") - 1) * key_range).alias(
                    "price_history_id"
                ),
                "listing_id",
                old.alias("old_price"),
                (old * factor).cast("decimal(14,2)").alias("new_price"),
                F.when(F.col("l_partkey") % 37 != 0, F.timestamp_add(
                    "HOUR",
                    (F.col("l_partkey") % 2400).cast("int"),
                    F.col("listing_date").cast("timestamp_ntz"),
                )).alias("change_date"),
                F.lit("Market feedback").alias("reason_for_change"),
            )
        )

    def _customers(self) -> DataFrame:
        c = self.src("customer")
        k = F.col("c_custkey")
        return c.select(
            (k + 1).alias("customer_id"),
            F.concat(F.lit("First"), txt(k)).alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.concat(F.lit("cust"), txt(k), F.lit("@example.com")).alias("email"),
            F.lit(None).cast("string").alias("phone"),
            F.concat(txt(k), F.lit(" Oak St")).alias("address"),
            cycle(k, ("buyer", "seller", "renter")).alias("customer_type"),
            plus_days("2021-02-01", k % 1095).alias("created_date"),
            F.lit(None).cast("date").alias("updated_date"),
        )

    def _leads(self) -> DataFrame:
        o = self.src("orders")
        k = F.col("o_orderkey")
        return o.select(
            (k + 1).alias("lead_id"),
            (F.col("o_custkey") + 1).alias("customer_id"),
            plus_days("2021-02-01", k % 1095).alias("lead_date"),
            cycle(k, ("email", "digital", "print", "event", "referral", "cold_call")).alias(
                "lead_source"
            ),
            cycle(fdiv(k, 3), ("active", "converted", "lost", "archived")).alias("lead_status"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("est_value"),
            F.lit("note").alias("notes"),
        )

    def _customer_interactions(self) -> DataFrame:
        e = self.src("events")
        k = F.col("event_id")
        return e.select(
            (k + 1).alias("interaction_id"),
            (F.col("user_id") * 10 + k % 10 + 1).alias("customer_id"),
            F.when(k % 10 < 8, fdiv(k, 2) * 3 + 1).alias("lead_id"),
            F.timestamp_add("DAY", -(k % 365).cast("int"), F.col("ts").cast("timestamp_ntz")).alias(
                "interaction_dt"
            ),
            cycle(k, ("call", "email", "text", "meeting", "showing", "other")).alias("channel"),
            F.col("event_type").alias("subject"),
            F.col("props").alias("details"),
            F.when(k % 10 < 7, fdiv(k * 3, 2) + 1).alias("listing_id"),
            cycle(
                k, ("positive", "neutral", "negative", "follow_up_needed", "no_response")
            ).alias("outcome"),
        )

    def _offers(self) -> DataFrame:
        o = self.src("orders")
        k = F.col("o_orderkey")
        o = self._dealt(o.withColumn("listing_id", k - k % 3 + 1), "orders")
        listings = self["listings"].select("listing_id", "listing_price", "listing_date")
        factor = dec_frac(k % 31 + 85, 100, 4, 2, 5)
        return o.join(listings, "listing_id").select(
            (k + 1).alias("offer_id"),
            (F.col("o_custkey") + 1).alias("customer_id"),
            "listing_id",
            F.when(k % 10 < 9, fdiv(F.col("o_custkey"), 15) + 1).alias("agent_id"),
            (F.col("listing_price") * factor).cast("decimal(12,2)").alias("offer_price"),
            F.date_add("listing_date", (k % 30).cast("int")).alias("offer_date"),
            cycle(k, ("submitted", "counter", "accepted", "rejected", "expired")).alias("status"),
            F.lit("none").alias("contingencies"),
        )

    def _contracts(self) -> DataFrame:
        o = self["offers"].where(F.col("offer_id") % 2 == 0)
        k = F.col("offer_id")
        base = F.col("offer_date")
        return o.select(
            k.alias("contract_id"),
            k.alias("offer_id"),
            cycle(k, ("purchase", "lease", "listing")).alias("contract_type"),
            F.date_add(base, (k % 20).cast("int")).alias("contract_date"),
            F.when(k % 10 != 0, F.date_add(base, (k % 20 + k % 91).cast("int"))).alias(
                "expected_close_date"
            ),
            F.when(k % 7 != 0, F.date_add(base, (k % 20 + k % 5).cast("int"))).alias(
                "signed_date"
            ),
            cycle(k, ("pending", "active", "closed", "expired", "terminated")).alias(
                "contract_status"
            ),
            F.lit("terms").alias("terms"),
        )

    def _commissions(self) -> DataFrame:
        o = self.src("orders").withColumn("agent_id", fdiv(F.col("o_custkey"), 15) + 1)
        agents = self["agents"].select("agent_id", "team_id", "office_id")
        k = F.col("o_orderkey")
        return o.join(agents, "agent_id").select(
            (k + 1).alias("commission_id"),
            (k % 200 + 1).alias("transaction_id"),
            "agent_id",
            "team_id",
            "office_id",
            (F.col("o_totalprice").cast("decimal(14,2)") * F.lit(0.03).cast("decimal(3,2)"))
            .cast("decimal(12,2)")
            .alias("commission_amount"),
            dec_frac(k % 501 + 100, 100, 5, 2).alias("commission_rate"),
            cycle(k, ("Buyer", "Seller")).alias("commission_type"),
            dec_frac(k % 5001, 100, 5, 2).alias("split_percentage"),
            plus_days("2023-02-01", k % 366).alias("paid_date"),
            cycle(k, ("pending", "paid", "disputed")).alias("status"),
        )


_SESSIONS: "weakref.WeakKeyDictionary[SparkSession, dict[str, DriverTables]]" = weakref.WeakKeyDictionary()


def driver_tables(spark: SparkSession, sf_dir: str) -> DriverTables:
    """The (lazily built, reusable) derived tables of one driver directory.

    DataFrames are immutable plans, so one set per session and directory is
    shared by every query; only plan construction is saved - each query
    still scans the files when it runs."""
    per_session = _SESSIONS.setdefault(spark, {})
    key = sf_dir.rstrip("/")
    if key not in per_session:
        per_session[key] = DriverTables(spark, key)
    return per_session[key]
