"""Exact sample sizes, orphan checks in every load mode, refused mappings."""

import pytest
from pyspark.sql import functions as F

from estatelens.operators import referential
from estatelens.sources import catalog
from estatelens.sources.generator import generate, row_counts


@pytest.fixture(scope="module")
def tables(spark):
    return generate(spark, scale=1, seed=3, as_of="2024-02-01")


@pytest.mark.parametrize("seed", [1, 2, 3, 5, 42])
def test_contract_count_is_the_drawn_one(spark, seed):
    t, n = generate(spark, scale=1, seed=seed, as_of="2024-02-01"), row_counts(1, seed)
    ids = t["contracts"].select("offer_id")
    assert ids.distinct().count() == ids.count() == min(n["contracts"], n["offers"])


def test_child_only_load_rejects_orphans(spark, tables, tmp_path):
    lead = tables["leads"].limit(1).withColumn("customer_id", F.lit(99).cast("long"))
    assert catalog.load_tables(spark, {"leads": lead}, str(tmp_path)) == {"leads": 1}


def test_an_orphan_rejects_no_valid_row(spark, tables, tmp_path):
    lead = tables["leads"].where("customer_id is not null").limit(1)
    pair = lead.unionByName(lead.withColumn("customer_id", F.lit(10**9).cast("long")))
    load = {n: tables[n] for n in ("offices", "teams", "agents", "neighborhoods", "properties", "listings", "customers")}
    rejected = catalog.load_tables(spark, {**load, "leads": pair}, str(tmp_path))
    assert rejected["leads"] == 1
    rules = catalog.read_rejected(spark, str(tmp_path), "leads").first()["failed_rules"]
    assert all(r.startswith("foreign_key:") for r in rules)


def test_ambiguous_mappings_are_refused(spark, tables):
    two = spark.createDataFrame([(1, 1001), (1, 1002)], "old_key long, new_key long")
    taken = spark.createDataFrame([(1, 2)], "old_key long, new_key long")
    for m in (two, taken):
        with pytest.raises(ValueError):
            referential.rekey(tables, "agents", m)


def test_delete_report_counts_rows_that_exist(spark, tables):
    some = tables["listings"].select("listing_id").limit(1).union(spark.createDataFrame([(10**9,)], "listing_id long"))
    got = {r["table_name"]: r["deleted_rows"] for r in referential.delete_report(referential.delete_cascade(tables, "listings", some)).collect()}
    assert got["listings"] == 1
