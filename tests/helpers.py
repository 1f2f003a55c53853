"""Build tiny brokerage tables from literal rows (unit tests only)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from estatelens.schemas import TABLES


def D(x) -> Decimal | None:
    return None if x is None else Decimal(str(x))


def d(s: str | None) -> dt.date | None:
    return None if s is None else dt.date.fromisoformat(s)


def ts(s: str | None) -> dt.datetime | None:
    return None if s is None else dt.datetime.fromisoformat(s)


def frame(spark, table: str, rows: list[dict]):
    """DataFrame of ``table``'s schema; missing columns are NULL."""
    from pyspark.sql import types as T

    t = TABLES[table]
    data = [tuple(r.get(c) for c in t.column_names) for r in rows]
    # raw input: NOT NULL is a rule to check, not a property of the frame
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in t.schema.fields])
    return spark.createDataFrame(data, schema)


def tables(spark, **rows):
    """Mapping of all 14 tables; unspecified ones are empty."""
    return {name: frame(spark, name, rows.get(name, [])) for name in TABLES}
