"""Column expressions with PostgreSQL semantics.

All helpers return plain ``Column`` expressions built from
``pyspark.sql.functions``; they stay inside whole-stage codegen and need no
UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_of_date(as_of: _dt.date | str | Column | None) -> Column:
    """The query date that stands in for CURRENT_DATE (pinned in tests)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def months_before(as_of, n: int) -> Column:
    """``CURRENT_DATE - INTERVAL 'n months'`` with month-end clamping."""
    return F.add_months(as_of_date(as_of), -n)


def age_day_part(end: ColumnOrName, start: ColumnOrName) -> Column:
    """``EXTRACT(DAY FROM AGE(end, start))``: the day *field* (0..30) of the
    symbolic years/months/days difference, not the total number of days.

    A negative day difference borrows the length of the start date's month;
    when ``end < start`` the result is the negated age of the swapped pair.
    """
    e, s = _c(end), _c(start)

    def forward(later: Column, earlier: Column) -> Column:
        d = F.dayofmonth(later) - F.dayofmonth(earlier)
        return F.when(d >= 0, d).otherwise(d + F.dayofmonth(F.last_day(earlier)))

    return F.when(e >= s, forward(e, s)).otherwise(-forward(s, e))


def elapsed_days(end_date: ColumnOrName, start_ts: ColumnOrName) -> Column:
    """``EXTRACT(DAY FROM date - timestamp)``: whole elapsed days, truncated
    toward zero (the date is promoted to midnight)."""
    return F.extract(
        F.lit("DAY"), _c(end_date).cast("timestamp_ntz") - _c(start_ts).cast("timestamp_ntz")
    )


def pg_int(x: ColumnOrName) -> Column:
    """``CAST(numeric AS INTEGER)``: rounds half away from zero (Spark's bare
    cast truncates)."""
    return F.round(_c(x), 0).cast("int")


def dec_mean(x: ColumnOrName) -> Column:
    """Exact ``AVG`` of a NUMERIC/INTEGER column: ``sum / count`` in decimal.

    Spark's ``avg(decimal(p,s))`` rounds to scale ``s+4`` before the caller's
    ROUND, which can round twice; ``sum/count`` keeps 16 fractional digits.
    Returns NULL on an empty or all-NULL group, like AVG.
    """
    c = _c(x)
    return F.sum(c) / F.count(c)


def int_mean(x: ColumnOrName) -> Column:
    """Exact ``AVG`` of an integer expression (e.g. day counts) in decimal."""
    c = _c(x)
    return F.sum(c.cast("decimal(20,0)")) / F.count(c)


def mean_of_parts(total: ColumnOrName, count: ColumnOrName, scale: int = 2) -> Column:
    """AVG rebuilt from partial sums and counts (after aggregating below a
    join).  Summing sums widens the decimal so far that Spark would cut the
    quotient to 6 fractional digits; casting the total to decimal(28,scale)
    first keeps at least 10."""
    return _c(total).cast(f"decimal(28,{scale})") / _c(count).cast("decimal(20,0)")


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """NUMERIC division that keeps 12 fractional digits whatever the operand
    scales are.  (Spark sizes a decimal quotient from the operand types and
    cuts the scale to 6 when both carry many digits.)"""
    return _c(num).cast("decimal(38,18)") / _c(den).cast("decimal(24,6)")


def _times_100(x: Column) -> Column:
    # decimal(30,12) * decimal(3,0) -> decimal(34,12): no precision is lost
    return x.cast("decimal(30,12)") * F.lit(100).cast("decimal(3,0)")


def pct_change(new: ColumnOrName, old: ColumnOrName) -> Column:
    """``(new - old) / old * 100`` in NUMERIC."""
    return _times_100(ratio(_c(new) - _c(old), old))


def count_pct(part: ColumnOrName, whole: ColumnOrName, guard: bool = True) -> Column:
    """``part::NUMERIC / NULLIF(whole, 0) * 100`` for two counts.

    With ``guard=False`` there is no NULLIF and a zero ``whole`` raises
    DIVIDE_BY_ZERO (ANSI mode), as the unguarded SQL division does."""
    hundred_part = _c(part).cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
    den = F.nullif(_c(whole), F.lit(0)) if guard else _c(whole)
    return hundred_part / den.cast("decimal(20,0)")


def pg_round(x: ColumnOrName, k: int) -> Column:
    """``ROUND(numeric, k)``: half away from zero on decimals."""
    return F.round(_c(x), k)


def asc(x: ColumnOrName) -> Column:
    """PostgreSQL ``ASC``: NULLs sort last."""
    return _c(x).asc_nulls_last()


def desc(x: ColumnOrName) -> Column:
    """PostgreSQL ``DESC``: NULLs sort first."""
    return _c(x).desc_nulls_first()


def count_if(cond: Column, value: ColumnOrName | None = None) -> Column:
    """``COUNT(CASE WHEN cond THEN value END)``; counts rows when ``value`` is
    omitted."""
    return F.count(F.when(cond, F.lit(1) if value is None else _c(value)))
