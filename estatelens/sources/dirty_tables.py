"""The derived tables with broken rows, for the integrity jobs.

Every declared rule of a table breaks the rows of one residue class of the
clean primary key, so all rows of the source tables are read, the number of
broken rows grows with them, and each rule finds some once the table has
``MODULUS`` rows.  The expressions are plain SQL that Spark and DuckDB read
alike; :mod:`estatelens.plans.oracle` puts them over its own derivation.

Decimals arrive wider than declared, so that values over their NUMERIC
precision exist; columns may be NULL and keys may repeat.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from estatelens.schemas import LOAD_ORDER, Table

#: Residue classes of a table's key; the two small tables have fewer rows.
MODULUS = {"offices": 3, "teams": 11}
DEFAULT_MODULUS = 31

#: How a decimal column arrives.
RAW_DECIMAL = "DECIMAL(20,4)"

#: CHECK rule -> the column to change and a value that breaks the rule.
CHECK_BREAKS = {
    "commission_amount_nonneg": ("commission_amount", "-1"),
    "commission_rate_range": ("commission_rate", "100.5"),
    "walkability_range": ("walkability_score", "101"),
    "sqft_positive": ("sqft", "0"),
    "price_nonneg": ("price", "-1"),
    "listing_price_nonneg": ("listing_price", "-1"),
    "close_after_listing": ("close_date", "CAST(listing_date - INTERVAL '1' DAY AS DATE)"),
    "old_price_nonneg": ("old_price", "-1"),
    "new_price_nonneg": ("new_price", "-1"),
    "price_changed": ("new_price", "old_price"),
    "offer_price_positive": ("offer_price", "0"),
}


def _breaks(table: Table) -> list[tuple[str, str, bool]]:
    """(columns, broken value, is it a key rule) for every rule of the
    table; two rows of a block of keys share the value of a key rule."""
    key, m = table.primary_key, MODULUS.get(table.name, DEFAULT_MODULUS)
    block = f"({key} - {key} % {m})"
    out = [(key, block, True)]
    for columns in table.unique:
        out.append(("+".join(columns), f"'twin ' || CAST({block} AS STRING)", True))
    for fk in table.foreign_keys:
        out.append((fk.column, f"-{key} - 1", False))
    for c in table.columns:
        if not c.nullable:
            out.append((c.name, "NULL", False))
        if c.domain:
            out.append((c.name, "'?'", False))
        if c.max_len:
            out.append((c.name, f"repeat('x', {c.max_len + 1})", False))
        if isinstance(c.dtype, T.DecimalType):
            out.append((c.name, f"{10 ** (c.dtype.precision - c.dtype.scale)}", False))
    for check in table.checks:
        out.append((*CHECK_BREAKS[check.rule_id], False))
    return out


def dirty_columns(table: Table) -> list[str]:
    """One SQL select item for each column, over the clean table."""
    key, m = table.primary_key, MODULUS.get(table.name, DEFAULT_MODULUS)
    raw = {c.name: RAW_DECIMAL for c in table.columns if isinstance(c.dtype, T.DecimalType)}
    cases: dict[str, list[str]] = {}
    residue = 0
    for columns, value, is_key in _breaks(table):
        # a key rule's two rows lie two apart: contracts have even keys only
        rows = f"{key} % {m} IN ({residue % m}, {(residue + 2) % m})" if is_key else f"{key} % {m} = {residue % m}"
        residue += 4 if is_key else 1
        for name in columns.split("+"):
            text = isinstance(table.column(name).dtype, T.StringType)
            new = f"{key} - {key} % {m}" if is_key and not text else value
            cases.setdefault(name, []).append(f"WHEN {rows} THEN " + (f"CAST({new} AS {raw[name]})" if name in raw else new))
    items = []
    for c in table.columns:
        value = f"CAST({c.name} AS {raw[c.name]})" if c.name in raw else c.name
        if c.name in cases:
            value = f"CASE {' '.join(cases[c.name])} ELSE {value} END"
        items.append(f"{value} AS {c.name}")
    return items


def dirty_tables(clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The 14 tables of ``clean`` with rows that break every rule."""
    return {t.name: clean[t.name].selectExpr(*dirty_columns(t)) for t in LOAD_ORDER}
