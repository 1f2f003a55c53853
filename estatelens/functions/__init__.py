"""PostgreSQL-compatible column functions (dates, rounding, averages, NULL order)."""

from estatelens.functions.pg import (  # noqa: F401
    age_day_part,
    as_of_date,
    asc,
    count_if,
    count_pct,
    dec_mean,
    desc,
    elapsed_days,
    int_mean,
    mean_of_parts,
    months_before,
    pct_change,
    pg_int,
    pg_round,
    ratio,
)
from estatelens.functions.text import clean_phone, truncate  # noqa: F401,E402
