"""Tables stored by listing join and aggregate on it without an exchange."""

import pytest

from estatelens.operators import market
from estatelens.sources import bucketed
from estatelens.sources.driver_tables import AS_OF, driver_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    bucketed.store(driver_tables(spark, SF), str(tmp_path_factory.mktemp("bucketed")), "test_bucketed", buckets=6)
    return bucketed.read(spark, "test_bucketed", driver_tables(spark, SF))


@pytest.mark.parametrize("job", [market.rental_vs_sale_demand, market.listing_stage_conversion])
def test_no_exchange_by_listing(spark, stored, job):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(keep, ("-1", "false")):
            spark.conf.set(k, v)
        plan = job(stored, AS_OF)._jdf.queryExecution().executedPlan().toString()
        fresh = job(driver_tables(spark, SF), AS_OF)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(listing_id" not in plan and "hashpartitioning(listing_id" in fresh
        assert "SelectedBucketsCount: 6 out of 6" in job(stored, AS_OF)._jdf.queryExecution().toString() or "Bucketed: true" in plan
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert sorted(map(str, job(stored, AS_OF).collect())) == sorted(map(str, job(driver_tables(spark, SF), AS_OF).collect()))


def test_crowded(spark, stored):
    found = {r["listing_id"]: r["rows"] for r in bucketed.crowded(stored["customer_interactions"], 6).collect()}
    assert set(found) == {None} or not found
