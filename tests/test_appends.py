"""Appends that cost the batch, and parents that are built again."""

import pytest
from pyspark.sql import functions as F

from estatelens.schemas import TABLES
from estatelens.sources import catalog
from estatelens.sources.generator import generate
from estatelens.streaming import checked_append_stream


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("appends") / "tables")
    catalog.load_tables(spark, generate(spark, scale=1.0, seed=11), path)
    return path


def _children(node):
    kids = node.children()
    return [kids.apply(i) for i in range(kids.size())]


def _stored_rows_dealt(node, root, dealt=False, found=None):
    """Scans of the tables under ``root`` below an exchange of their rows."""
    found = [] if found is None else found
    name = node.nodeName()
    if name == "Exchange":
        dealt = True
    if name == "BroadcastHashJoin" and "LeftSemi" in node.toString().split("\n")[0]:
        dealt = False  # only keys of the batch come out of it
    if name.startswith("Scan") and root in node.toString():
        found += [node.toString().split("\n")[0]] if dealt else []
    for c in _children(node):
        _stored_rows_dealt(c, root, dealt, found)
    return found


def _plan(df):
    return df._jdf.queryExecution().executedPlan()


def test_append_shuffles_only_the_batch(spark, root):
    t = TABLES["offers"]
    stored = {name: catalog.read_table(spark, root, name) for name in TABLES}
    batch = stored["offers"].limit(1000).withColumn("offer_id", F.col("offer_id") + 10_000_000).select(*t.column_names)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(keep, ("false", "-1")):  # no help from the planner's own size estimates
            spark.conf.set(k, v)
        parents = {fk.parent: stored[fk.parent] for fk in t.foreign_keys}
        batch = catalog.cut(batch)
        checked = catalog.check_rows(batch, t, {**parents, "offers": stored["offers"]})
        assert _stored_rows_dealt(_plan(checked), root) == []
        assert checked.where(F.size("failed_rules") == 0).count() == batch.count()
        whole = catalog.check_rows(batch, t, parents)  # a first load joins whole tables
        assert _stored_rows_dealt(_plan(whole), root)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_rebuilt_parent_rechecks_stored_children(spark, tmp_path):
    path = str(tmp_path / "tables")
    catalog.load_tables(spark, generate(spark, scale=1.0, seed=12), path)
    before = {n: catalog.read_table(spark, path, n).count() for n in TABLES}
    customers = catalog.cut(catalog.read_table(spark, path, "customers"))
    gone = customers.where("customer_id % 2 = 0").select("customer_id")
    rejected = catalog.load_tables(spark, {"customers": customers.where("customer_id % 2 = 1")}, path)
    assert {"customers", "leads", "customer_interactions", "offers", "contracts"} <= set(rejected) and "properties" not in rejected
    for name in ("leads", "customer_interactions", "offers"):
        left = catalog.read_table(spark, path, name)
        assert left.join(gone, "customer_id", "left_semi").count() == 0
        assert left.count() + rejected[name] == before[name] and rejected[name] > 0
    contracts, offers = catalog.read_table(spark, path, "contracts"), catalog.read_table(spark, path, "offers")
    assert contracts.join(offers, "offer_id", "left_anti").count() == 0
    assert contracts.count() + rejected["contracts"] == before["contracts"]


def test_stream_without_a_loaded_parent(spark, tmp_path):
    path, landing = str(tmp_path / "tables"), str(tmp_path / "landing")
    leads = generate(spark, scale=1.0, seed=13)["leads"].limit(5)
    leads.write.parquet(landing)
    checked_append_stream(spark, "leads", landing, path, str(tmp_path / "ck")).awaitTermination()
    assert catalog.read_table(spark, path, "leads").count() == 0
    rules = {r for x in catalog.read_rejected(spark, path, "leads").collect() for r in x.failed_rules}
    assert rules == {"foreign_key:customer_id->customers"}
