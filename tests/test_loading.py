"""Checked load, typed read-back, marts and the streaming append sink."""

import os

from pyspark.sql import functions as F

from estatelens.plans import marts
from estatelens.sources import catalog
from estatelens.sources.generator import generate
from estatelens.streaming import checked_append_stream
from estatelens.streaming.checked_append import raw_schema


def test_load_read_back_and_marts(spark, tmp_path):
    root = str(tmp_path / "tables")
    gen = generate(spark, scale=1.0, seed=5)
    rejected = catalog.load_tables(spark, gen, root)
    assert all(v == 0 for v in rejected.values())
    stored = catalog.read_tables(spark, root)
    for name, df in gen.items():
        # file sources read every column as nullable; names and types must match
        assert [(f.name, f.dataType) for f in stored[name].schema] == \
            [(f.name, f.dataType) for f in df.schema]
        assert stored[name].exceptAll(df).count() == 0
    paths = marts.build_marts(stored, str(tmp_path / "marts"), "2024-02-01",
                              names=["walkability_split", "listing_stage_conversion"])
    assert spark.read.parquet(paths["listing_stage_conversion"]).count() > 0


def test_append_rejects_bad_rows_and_replay_is_idempotent(spark, tmp_path):
    root = str(tmp_path / "tables")
    gen = generate(spark, scale=1.0, seed=6)
    catalog.load_tables(spark, gen, root)
    n_before = catalog.read_table(spark, root, "leads").count()
    new = spark.createDataFrame(
        [(10_001, 1, "2024-01-05", "email", "active"),      # good
         (10_002, 99_999, "2024-01-05", "email", "active"),  # orphan customer
         (10_003, 1, "2024-01-05", "fax", "active"),         # bad domain
         (1, 1, "2024-01-05", "email", "active")],           # duplicate primary key
        "lead_id long, customer_id long, lead_date string, lead_source string, lead_status string",
    ).select(F.col("lead_id"), "customer_id", F.to_date("lead_date").alias("lead_date"),
             "lead_source", "lead_status", F.lit(None).cast("decimal(12,2)").alias("est_value"),
             F.lit(None).cast("string").alias("notes"))
    for _ in range(2):  # the second run replays batch 1 and must not duplicate it
        rejected = catalog.load_tables(spark, {"leads": new}, root, batch=1, append=True)
    assert rejected["leads"] == 3
    assert catalog.read_table(spark, root, "leads").count() == n_before + 1
    rules = sorted(r.failed_rules[0] for r in catalog.read_rejected(
        spark, root, "leads").where("load_batch = 1").collect())
    assert rules == ["domain:lead_source", "foreign_key:customer_id->customers", "primary_key:lead_id"]


def test_streaming_checked_append(spark, tmp_path):
    root = str(tmp_path / "tables")
    landing = str(tmp_path / "landing")
    gen = generate(spark, scale=1.0, seed=8)
    catalog.load_tables(spark, {k: v for k, v in gen.items() if k != "offers"}, root)
    offers = gen["offers"]
    ids = [r.offer_id for r in offers.select("offer_id").orderBy("offer_id").collect()]
    half = ids[len(ids) // 2]
    offers.where(F.col("offer_id") <= half).write.parquet(os.path.join(landing, "f1"))
    bad = offers.where(F.col("offer_id") > half).withColumn(
        "listing_id", F.when(F.col("offer_id") == ids[-1], F.lit(10**9)).otherwise(F.col("listing_id")))
    bad.write.parquet(os.path.join(landing, "f2"))
    q = checked_append_stream(spark, "offers", landing + "/*", root, str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    stored = catalog.read_table(spark, root, "offers")
    assert stored.count() == len(ids) - 1
    assert stored.where(F.col("offer_id") == ids[-1]).count() == 0
    assert raw_schema("offers")["offer_id"].nullable


def test_full_rebuild_drops_earlier_batches(spark, tmp_path):
    root = str(tmp_path / "tables")
    gen = generate(spark, scale=1.0, seed=9)
    catalog.load_tables(spark, gen, root)
    extra = gen["customers"].withColumn("customer_id", F.col("customer_id") + 10_000) \
        .withColumn("email", F.concat(F.lit("x"), F.col("email")))
    catalog.load_tables(spark, {"customers": extra}, root, batch=1, append=True)
    assert catalog.read_table(spark, root, "customers").count() == 2 * gen["customers"].count()
    catalog.load_tables(spark, {"customers": gen["customers"]}, root)  # rebuild
    assert catalog.read_table(spark, root, "customers").count() == gen["customers"].count()


def test_command_line_load_query_check(spark, tmp_path, capsys):
    from estatelens.__main__ import main

    root = str(tmp_path / "tables")
    assert main(["load", "--tables", root, "--scale", "1", "--seed", "3"]) == 0
    out = str(tmp_path / "q")
    assert main(["query", "walkability_split", "--tables", root, "--out", out]) == 0
    assert spark.read.parquet(out).count() == 2
    assert main(["check", "--tables", root, "--out", str(tmp_path / "c")]) == 0
    assert spark.read.parquet(str(tmp_path / "c")).where("violations > 0").count() == 0
    assert main(["list"]) == 0
    assert "listing_stage_conversion" in capsys.readouterr().out


def test_date_filtered_tables_are_laid_out_by_date(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    root = str(tmp_path / "tables")
    # small data: keep AQE from merging the range partitions into one file
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        catalog.load_tables(spark, generate(spark, scale=20.0, seed=4), root)
    finally:
        spark.conf.set(key, old)
    files = sorted(glob.glob(f"{root}/listings/load_batch=0/*.parquet"))
    assert len(files) > 1
    ranges = []
    for f in files:
        md = pq.ParquetFile(f).metadata
        col = [md.row_group(0).column(i).path_in_schema for i in range(md.num_columns)].index("listing_date")
        stats = [md.row_group(g).column(col).statistics for g in range(md.num_row_groups)]
        ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
    ranges.sort()
    # files cover increasing date ranges that overlap at most at a boundary
    # date (ties are split by listing_id): a date window skips whole files
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_run_end_to_end_builds_every_mart(spark, tmp_path):
    from estatelens.plans.registry import ANALYTICS

    out = marts.run_end_to_end(spark, str(tmp_path), scale=1.0, seed=12)
    assert all(v == 0 for v in out["rejected"].values())
    assert set(out["marts"]) == set(ANALYTICS)
    stored = catalog.read_tables(spark, str(tmp_path / "tables"))
    for name in ("walkability_split", "listing_stage_conversion", "agent_commissions"):
        got = spark.read.parquet(out["marts"][name])
        assert got.exceptAll(ANALYTICS[name](stored, "2024-02-01")).count() == 0


def test_checked_rows_join_once_for_each_rule(spark):
    """Three key rules and two references of agents: the joins grow with
    the rules, and NULL references are spread by a second join key."""
    from estatelens.schemas import TABLES

    # rows as literals, so that only the check's own joins are counted
    gen = generate(spark, scale=1.0, seed=3)
    t = {n: spark.createDataFrame(gen[n].collect(), gen[n].schema) for n in ("offices", "teams", "agents")}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tagged = catalog.check_rows(t["agents"], TABLES["agents"], {"offices": t["offices"], "teams": t["teams"]})
        plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # two reference joins on the way to each of the three key frames and the rows, and one for each key
    assert plan.count("Join LeftOuter") == 2 * 4 + 3
    assert "__spread" in plan and "__at" in plan
    assert tagged.where("size(failed_rules) > 0").count() == 0
