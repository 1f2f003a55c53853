"""String cleaning used when loading raw contact data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters kept in a phone number.
PHONE_KEEP = r"[^0-9+()-]"


def truncate(x: Column | str, n: int) -> Column:
    """First ``n`` characters (VARCHAR(n) fit)."""
    c = F.col(x) if isinstance(x, str) else x
    return F.substring(c, 1, n)


def clean_phone(x: Column | str, max_len: int = 20) -> Column:
    """Keep digits, '+', '(', ')' and '-' only, then cut to ``max_len``."""
    c = F.col(x) if isinstance(x, str) else x
    return truncate(F.regexp_replace(c, PHONE_KEEP, ""), max_len)
