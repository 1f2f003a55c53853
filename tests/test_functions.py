"""PostgreSQL semantics of the column helpers (edge cases of FIXTURES.md §3)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from estatelens.functions import (
    age_day_part, asc, count_pct, dec_mean, desc, elapsed_days, months_before, pg_int, pg_round,
)
from helpers import d, ts


@pytest.mark.parametrize(
    "end,start,expected",
    [
        ("2024-03-30", "2024-01-31", 30),
        ("2024-05-16", "2024-03-02", 14),
        ("2024-02-15", "2024-01-15", 0),
        ("2023-03-01", "2023-01-31", 1),
        ("2024-01-10", "2024-02-15", -5),
        ("2024-03-01", "2024-02-29", 1),
        ("2024-03-29", "2024-02-29", 0),
        (None, "2024-01-01", None),
        ("2024-01-01", None, None),
    ],
)
def test_age_day_part(spark, end, start, expected):
    df = spark.createDataFrame([(d(end), d(start))], "e date, s date")
    assert df.select(age_day_part("e", "s").alias("x")).first().x == expected


def test_age_day_part_matches_duckdb_on_many_pairs(spark):
    import duckdb

    rows = duckdb.sql(
        """select a, b, extract(day from age(a, b)) x from (
             select DATE '2022-12-01' + cast(i as int) a, DATE '2023-01-15' + cast(j*7 as int) b
             from range(0, 500, 3) t(i), range(0, 60) u(j))"""
    ).fetchall()
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "a date, b date")
    got = df.select("a", "b", age_day_part("a", "b").alias("x")).collect()
    want = {(a, b): x for a, b, x in rows}
    assert all(want[(r.a, r.b)] == r.x for r in got)


def test_elapsed_days_truncates_toward_zero(spark):
    df = spark.createDataFrame(
        [(d("2024-03-01"),), (d("2024-01-10"),), (d("2024-01-15"),)], "c date"
    ).withColumn("t", F.lit(ts("2024-01-15 10:00:00")).cast("timestamp_ntz"))
    assert [r.x for r in df.select(elapsed_days("c", "t").alias("x")).collect()] == [45, -5, 0]


def test_pg_int_rounds_half_away(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in ("1.4", "1.5", "2.4", "2.5")], "b decimal(2,1)")
    assert [r.x for r in df.select(pg_int("b").alias("x")).collect()] == [1, 2, 2, 3]


def test_dec_mean_rounds_once(spark):
    rows = [(Decimal("1.00"),)] * 10001 + [(Decimal("1.01"),)] * 9999
    df = spark.createDataFrame(rows, "x decimal(14,2)")
    exact = df.agg(pg_round(dec_mean("x"), 2).alias("m")).first().m
    assert exact == Decimal("1.00")


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("1.005"), Decimal("-2.5"))], "a decimal(10,3), b decimal(10,1)")
    r = df.select(pg_round("a", 2).alias("a"), pg_round("b", 0).alias("b")).first()
    assert (r.a, r.b) == (Decimal("1.01"), Decimal("-3"))


def test_months_before_clamps_month_end(spark):
    r = spark.range(1).select(months_before(dt.date(2024, 5, 31), 3).alias("x")).first()
    assert r.x == dt.date(2024, 2, 29)


def test_count_pct_guard(spark):
    df = spark.createDataFrame([(1, 0), (1, 8)], "a bigint, b bigint")
    got = [r.x for r in df.select(pg_round(count_pct("a", "b"), 2).alias("x")).collect()]
    assert got == [None, Decimal("12.50")]


def test_unguarded_division_by_zero_raises(spark):
    df = spark.createDataFrame([(1, 0)], "a bigint, b bigint")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        df.select(count_pct("a", "b", guard=False)).collect()


def test_null_order_is_postgres(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    assert [r.v for r in df.orderBy(desc("v")).collect()] == [None, 2, 1]
    assert [r.v for r in df.orderBy(asc("v")).collect()] == [1, 2, None]


def test_clean_phone_strips_and_truncates(spark):
    from estatelens.functions import clean_phone

    df = spark.createDataFrame([("+1 (212) 555-01.99x123456789",)], "p string")
    assert df.select(clean_phone("p").alias("x")).first().x == "+1(212)555-019912345"


def test_cluster_conf_sizes_partitions_for_the_largest_shuffle():
    from estatelens.session import cluster_conf

    assert cluster_conf(4e12, 4000)["spark.sql.shuffle.partitions"] == "14902"
    assert cluster_conf(1e6, 16)["spark.sql.shuffle.partitions"] == "48"
