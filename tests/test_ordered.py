"""Ordinals, segmented scans, heavy-key joins, exact samples and mergeable
distinct sets, against plain Python over tables with one hot key."""

import contextlib
import io
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from estatelens.operators import distinct_sets, heavy, ordered, sampling

SF = "/root/testdata/sf0.001"


def hot_rows(n=4000):
    r = random.Random(4)
    rows = [(7 if i % 3 == 0 else r.choice([None, *range(40)]), r.choice([None, *range(50)]), i, r.choice([None, *range(9)])) for i in range(n)]
    r.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return hot_rows()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, at long, id long, v long").repartition(6).cache()


@pytest.fixture(params=["true", "false"])
def adaptive(request, spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", request.param)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield request.param
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_ordinal(frame, rows, adaptive):
    out = ordered.with_ordinal(frame, [F.col("at").desc_nulls_first(), "id"]).collect()
    want = sorted(rows, key=lambda r: (r[1] is not None, -(r[1] or 0), r[2]))
    assert [r["id"] for r in sorted(out, key=lambda r: r["ordinal"])] == [r[2] for r in want]
    assert sorted(r["ordinal"] for r in out) == list(range(1, len(rows) + 1))
    assert ordered.with_ordinal(frame.where("id < 0"), ["id"]).count() == 0


def test_segmented_scan(frame, rows, adaptive):
    out = ordered.segmented_scan(frame, ["k"], [F.col("at").asc_nulls_last(), "id"], first={"f": "v"}, last={"l": "v"},
                                 previous={"p": "v"}, number="n", running={"s": "v"})
    by = {}
    for r in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2])):
        by.setdefault(r[0], []).append(r)
    want = set()
    for part in by.values():
        total = None
        for i, r in enumerate(part):
            total = total if r[3] is None else (total or 0) + r[3]
            want.add((r[2], part[0][3], part[-1][3], part[i - 1][3] if i else None, i + 1, total))
    assert {(r["id"], r["f"], r["l"], r["p"], r["n"], r["s"]) for r in out.collect()} == want
    assert ordered.segmented_scan(frame.where("id < 0"), ["k"], ["id"], number="n").count() == 0


def _plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_hot_key_is_in_many_buckets(spark, frame, rows, adaptive):
    buckets = ordered.range_buckets(frame, ["k", "at", "id"])
    assert buckets.where("k = 7").select("__bucket").distinct().count() > (4 if adaptive == "false" else 0)
    plan = _plan(E.queries()["price_change_context"](spark, SF))
    rows_dealt = [line for line in plan.splitlines() if "hashpartitioning(listing_id" in line]
    assert not rows_dealt and "hashpartitioning(__bucket" in plan


def test_split_join_balances(spark, frame, rows):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(keep, ("false", "8", "-1")):
            spark.conf.set(k, v)
        fact = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400).alias("k"), "id")
        parent = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
        out = heavy.split_join(fact, parent, ["k"])
        assert out.count() == 40_000 and out.where("twice <> 2 * k").count() == 0
        # the rows that were shuffled, without the heavy key, are even
        light = fact.join(heavy.heavy_keys(fact, ["k"]).hint("broadcast"), "k", "left_anti").repartition(8, "k")
        sizes = sorted(r["count"] for r in light.groupBy(F.spark_partition_id()).count().collect())
        plain = sorted(r["count"] for r in fact.repartition(8, "k").groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2] and plain[-1] > 3 * plain[len(plain) // 2]
        both = heavy.split_join(frame, parent.where("k < 20"), ["k"], "left")
        assert sorted((r["id"], r["k"], r["twice"]) for r in both.where("k is not null").collect()) == sorted(
            (r[2], r[0], 2 * r[0] if r[0] < 20 else None) for r in rows if r[0] is not None)
        assert both.where("k is null and twice is null").count() == sum(r[0] is None for r in rows)
        assert heavy.split_join(frame, parent, ["k"], limit=1, row_bytes=1).count() == sum(r[0] is not None for r in rows)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("size", [0, 1, 137, 4000, 9999])
def test_sample(spark, frame, size, monkeypatch):
    monkeypatch.setattr(sampling, "EXACT", 50)
    monkeypatch.setattr(sampling, "DIGITS", 1)
    draws = sorted((r["d"], str(r["id"])) for r in frame.select("id", sampling.draw(F.col("id"), "s").alias("d")).collect())
    got = sampling.sample_exact(frame, "id", size, "s")
    assert got.columns == frame.columns
    assert {str(r["id"]) for r in got.collect()} == {i for _, i in draws[:size]} and got.count() == min(size, 4000)


def test_pick_parent(spark, frame):
    parents = spark.createDataFrame([(i * i + 3,) for i in range(50)], "p long")
    got = Counter(r["p"] for r in sampling.pick_parent(frame, "id", parents, "p", "x", "p").collect())
    assert set(got) == {i * i + 3 for i in range(50)} and sum(got.values()) == 4000 and max(got.values()) < 160
    none = sampling.pick_parent(frame, "id", parents.where("p < 0"), "p", "x", "p")
    assert none.where("p is null").count() == 4000


def test_sets_merge(frame, rows):
    wide = frame.withColumn("v", F.col("id") * 1001)
    parts = [distinct_sets.distinct_sets(wide.where(F.col("id") % 3 == i), ["k"], "v") for i in range(3)]
    merged = distinct_sets.merge_sets(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["k"])
    got = {r["k"]: r["n"] for r in distinct_sets.set_sizes(merged, ["k"], "n").collect()}
    assert got == Counter(r[0] for r in rows)


def test_incremental_marts(spark, tmp_path):
    from estatelens.plans import incremental
    from estatelens.plans.registry import ANALYTICS
    from estatelens.sources.driver_tables import AS_OF, driver_tables

    t = driver_tables(spark, SF)
    for name, mart in incremental.MARTS.items():
        for b in (0, 1, 2, 1):  # batch 1 is replayed
            part = F.pmod(F.hash(*t[mart.facts].columns), F.lit(3)) == b
            incremental.add_batch(str(tmp_path), name, t[mart.facts].where(part), b)
        got = incremental.finish(spark, str(tmp_path), name, t, AS_OF)
        want = ANALYTICS[name](t, AS_OF)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
