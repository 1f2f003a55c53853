"""Typed schemas and declared integrity rules for the 14 brokerage tables.

Every table is a plain Spark ``StructType``.  The integrity rules that a
relational database would enforce row by row (primary keys, NOT NULL,
CHECK domains and ranges, UNIQUE, foreign keys with their delete actions,
VARCHAR lengths, NUMERIC precision, defaults) are kept here as data so the
data-quality jobs in :mod:`estatelens.operators.quality` and
:mod:`estatelens.operators.referential` can run them as set-based Spark jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

ID = T.LongType()
INT = T.IntegerType()
STR = T.StringType()
DATE = T.DateType()
TS = T.TimestampNTZType()  # TIMESTAMP WITHOUT TIME ZONE


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    nullable: bool = True
    max_len: int | None = None  # VARCHAR(n)
    domain: tuple[str, ...] | None = None  # CHECK (col IN (...))
    default: str | None = None  # 'now' | 'today'


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str
    on_delete: str  # 'cascade' | 'set_null'


@dataclass(frozen=True)
class Check:
    """A row predicate written in Spark SQL; the row violates it when the
    predicate is FALSE (NULL passes, as in SQL CHECK constraints)."""

    rule_id: str
    predicate: str


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    primary_key: str
    foreign_keys: tuple[ForeignKey, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    checks: tuple[Check, ...] = ()
    role: str = "fact"  # 'dim' tables are small lookups, 'fact' grow with volume

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.dtype, c.nullable) for c in self.columns]
        )

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.name}.{name}")


def C(name, dtype, nullable=True, max_len=None, domain=None, default=None):
    return Column(name, dtype, nullable, max_len, domain, default)


# --- fixed values: the allowed values of every CHECK (... IN (...)) domain ---
STATES = ("NY", "NJ", "CT")
AGENT_STATUS = ("Active", "Inactive", "Retired")
COMMISSION_TYPES = ("Buyer", "Seller")
COMMISSION_STATUS = ("pending", "paid", "disputed")
GRADE_LEVELS = ("Elementary", "Middle", "High", "K12", "Other")
SCHOOL_RATINGS = ("A", "B", "C")
PROPERTY_TYPES = ("Single-family", "Condo", "Townhouse", "Multi-unit")
LISTING_TYPES = ("Sale", "Rent")
LISTING_STATUS = ("Active", "Pending", "Sold", "Rented", "Expired", "Withdrawn")
CUSTOMER_TYPES = ("buyer", "seller", "renter")
LEAD_SOURCES = ("email", "digital", "print", "event", "referral", "cold_call")
LEAD_STATUS = ("active", "converted", "lost", "archived")
CHANNELS = ("call", "email", "text", "meeting", "showing", "other")
OFFER_STATUS = ("submitted", "counter", "accepted", "rejected", "expired")
CONTRACT_TYPES = ("purchase", "lease", "listing")
CONTRACT_STATUS = ("pending", "active", "closed", "expired", "terminated")


OFFICES = Table(
    "offices",
    (
        C("office_id", ID, False),
        C("office_name", STR, False, 100),
        C("address", STR, False, 255),
        C("city", STR, False, 100),
        C("state", STR, False, 2, STATES),
        C("zip_code", STR, False, 10),
        C("phone", STR, True, 20),
    ),
    "office_id",
    role="dim",
)

TEAMS = Table(
    "teams",
    (
        C("team_id", ID, False),
        C("team_name", STR, False, 100),
        C("team_lead_id", ID),
        C("office_id", ID),
        C("established_date", DATE),
        C("region", STR, True, 20),
    ),
    "team_id",
    (ForeignKey("office_id", "offices", "office_id", "set_null"),),
    role="dim",
)

AGENTS = Table(
    "agents",
    (
        C("agent_id", ID, False),
        C("office_id", ID),
        C("team_id", ID),
        C("first_name", STR, False, 50),
        C("last_name", STR, False, 50),
        C("email", STR, False, 100),
        C("phone", STR, True, 20),
        C("license_number", STR, False, 50),
        C("hire_date", DATE, False),
        C("status", STR, True, 20, AGENT_STATUS),
        C("commission_tier", STR, True, 50),
    ),
    "agent_id",
    (
        ForeignKey("office_id", "offices", "office_id", "set_null"),
        ForeignKey("team_id", "teams", "team_id", "set_null"),
    ),
    unique=(("email",), ("license_number",)),
    role="dim",
)

COMMISSIONS = Table(
    "commissions",
    (
        C("commission_id", ID, False),
        C("transaction_id", ID),
        C("agent_id", ID, False),
        C("team_id", ID),
        C("office_id", ID),
        C("commission_amount", dec(12, 2)),
        C("commission_rate", dec(5, 2)),
        C("commission_type", STR, True, 20, COMMISSION_TYPES),
        C("split_percentage", dec(5, 2)),
        C("paid_date", DATE),
        C("status", STR, True, 20, COMMISSION_STATUS),
    ),
    "commission_id",
    (
        ForeignKey("agent_id", "agents", "agent_id", "cascade"),
        ForeignKey("team_id", "teams", "team_id", "set_null"),
        ForeignKey("office_id", "offices", "office_id", "set_null"),
    ),
    checks=(
        Check("commission_amount_nonneg", "commission_amount >= 0"),
        Check("commission_rate_range", "commission_rate BETWEEN 0 AND 100"),
    ),
)

NEIGHBORHOODS = Table(
    "neighborhoods",
    (
        C("neighborhood_id", ID, False),
        C("neighborhood_name", STR, False, 120),
        C("city", STR, False, 120),
        C("state", STR, False, 2, STATES),
        C("zip_code", STR, False, 10),
        C("walkability_score", INT),
    ),
    "neighborhood_id",
    unique=(("neighborhood_name", "city", "state", "zip_code"),),
    checks=(Check("walkability_range", "walkability_score BETWEEN 0 AND 100"),),
    role="dim",
)

SCHOOLS = Table(
    "schools",
    (
        C("school_id", ID, False),
        C("school_name", STR, False, 160),
        C("grade_level", STR, False, 20, GRADE_LEVELS),
        C("school_rating", STR, True, 1, SCHOOL_RATINGS),
        C("neighborhood_id", ID),
        C("address", STR, True, 240),
    ),
    "school_id",
    (ForeignKey("neighborhood_id", "neighborhoods", "neighborhood_id", "set_null"),),
    role="dim",
)

PROPERTIES = Table(
    "properties",
    (
        C("property_id", ID, False),
        C("address", STR, False, 240),
        C("neighborhood_id", ID),
        C("property_type", STR, False, 40, PROPERTY_TYPES),
        C("rooms", dec(2, 1), False),
        C("bedroom", dec(2, 1), False),
        C("bathroom", dec(2, 1), False),
        C("sqft", INT),
        C("price", dec(14, 2)),
    ),
    "property_id",
    (ForeignKey("neighborhood_id", "neighborhoods", "neighborhood_id", "set_null"),),
    checks=(
        Check("sqft_positive", "sqft > 0"),
        Check("price_nonneg", "price >= 0"),
    ),
)

LISTINGS = Table(
    "listings",
    (
        C("listing_id", ID, False),
        C("property_id", ID, False),
        C("agent_id", ID),
        C("listing_type", STR, False, 10, LISTING_TYPES),
        C("listing_date", DATE, False),
        C("listing_price", dec(14, 2)),
        C("listing_status", STR, False, 20, LISTING_STATUS),
        C("close_date", DATE),
        C("last_updated", TS, True, default="now"),
    ),
    "listing_id",
    (
        ForeignKey("property_id", "properties", "property_id", "cascade"),
        ForeignKey("agent_id", "agents", "agent_id", "set_null"),
    ),
    checks=(
        Check("listing_price_nonneg", "listing_price >= 0"),
        Check("close_after_listing", "close_date IS NULL OR close_date >= listing_date"),
    ),
)

PRICE_HISTORY = Table(
    "property_price_history",
    (
        C("price_history_id", ID, False),
        C("listing_id", ID, False),
        C("old_price", dec(14, 2)),
        C("new_price", dec(14, 2)),
        C("change_date", TS, True, default="now"),
        C("reason_for_change", STR, True, 160),
    ),
    "price_history_id",
    (ForeignKey("listing_id", "listings", "listing_id", "cascade"),),
    checks=(
        Check("old_price_nonneg", "old_price >= 0"),
        Check("new_price_nonneg", "new_price >= 0"),
        Check("price_changed", "old_price IS NULL OR new_price <> old_price"),
    ),
)

CUSTOMERS = Table(
    "customers",
    (
        C("customer_id", ID, False),
        C("first_name", STR, False, 50),
        C("last_name", STR, False, 50),
        C("email", STR, True, 100),
        C("phone", STR, True, 20),
        C("address", STR, True, 255),
        C("customer_type", STR, False, 10, CUSTOMER_TYPES),
        C("created_date", DATE, False, default="today"),
        C("updated_date", DATE),
    ),
    "customer_id",
    unique=(("email",),),
)

LEADS = Table(
    "leads",
    (
        C("lead_id", ID, False),
        C("customer_id", ID, False),
        C("lead_date", DATE, False),
        C("lead_source", STR, True, 20, LEAD_SOURCES),
        C("lead_status", STR, False, 10, LEAD_STATUS),
        C("est_value", dec(12, 2)),
        C("notes", STR),
    ),
    "lead_id",
    (ForeignKey("customer_id", "customers", "customer_id", "cascade"),),
)

INTERACTIONS = Table(
    "customer_interactions",
    (
        C("interaction_id", ID, False),
        C("customer_id", ID, False),
        C("lead_id", ID),
        C("interaction_dt", TS, False, default="now"),
        C("channel", STR, True, 15, CHANNELS),
        C("subject", STR, True, 120),
        C("details", STR),
        C("listing_id", ID),
        C("outcome", STR, True, 20),
    ),
    "interaction_id",
    (
        ForeignKey("customer_id", "customers", "customer_id", "cascade"),
        ForeignKey("lead_id", "leads", "lead_id", "set_null"),
        ForeignKey("listing_id", "listings", "listing_id", "set_null"),
    ),
)

OFFERS = Table(
    "offers",
    (
        C("offer_id", ID, False),
        C("customer_id", ID, False),
        C("listing_id", ID, False),
        C("agent_id", ID),
        C("offer_price", dec(12, 2), False),
        C("offer_date", DATE, False),
        C("status", STR, False, 16, OFFER_STATUS),
        C("contingencies", STR),
    ),
    "offer_id",
    (
        ForeignKey("customer_id", "customers", "customer_id", "cascade"),
        ForeignKey("listing_id", "listings", "listing_id", "cascade"),
        ForeignKey("agent_id", "agents", "agent_id", "set_null"),
    ),
    checks=(Check("offer_price_positive", "offer_price > 0"),),
)

CONTRACTS = Table(
    "contracts",
    (
        C("contract_id", ID, False),
        C("offer_id", ID, False),
        C("contract_type", STR, False, 10, CONTRACT_TYPES),
        C("contract_date", DATE, False),
        C("expected_close_date", DATE),
        C("signed_date", DATE),
        C("contract_status", STR, False, 12, CONTRACT_STATUS),
        C("terms", STR),
    ),
    "contract_id",
    (ForeignKey("offer_id", "offers", "offer_id", "cascade"),),
    unique=(("offer_id",),),
)

# Parents before children: the order tables are generated, checked and loaded.
LOAD_ORDER: tuple[Table, ...] = (
    OFFICES,
    TEAMS,
    AGENTS,
    COMMISSIONS,
    NEIGHBORHOODS,
    SCHOOLS,
    PROPERTIES,
    LISTINGS,
    PRICE_HISTORY,
    CUSTOMERS,
    LEADS,
    INTERACTIONS,
    OFFERS,
    CONTRACTS,
)

TABLES: dict[str, Table] = {t.name: t for t in LOAD_ORDER}
TABLE_NAMES: tuple[str, ...] = tuple(TABLES)


def children_of(parent: str) -> list[tuple[Table, ForeignKey]]:
    """(child table, foreign key) pairs that reference ``parent``, in load order."""
    return [
        (t, fk) for t in LOAD_ORDER for fk in t.foreign_keys if fk.parent == parent
    ]


def conform(df, table: str | Table):
    """Select and cast ``df``'s columns to the declared schema of ``table``
    (returns ``df`` itself when names, order and types already match)."""
    from pyspark.sql import functions as F

    t = TABLES[table] if isinstance(table, str) else table
    have = [(f.name, f.dataType) for f in df.schema.fields]
    if have == [(c.name, c.dtype) for c in t.columns]:
        return df
    return df.select([F.col(c.name).cast(c.dtype).alias(c.name) for c in t.columns])
