"""Data-quality and referential-action jobs on literal tables."""


from pyspark.sql import functions as F

from estatelens.operators import quality, referential
from helpers import D, d, frame, tables, ts


def _counts(df):
    return {(r.table_name, r.rule_id): r.violations for r in df.collect()}


def test_row_rules_null_passes_checks_and_domains(spark):
    rows = [
        dict(property_id=1, address="a", neighborhood_id=1, property_type="Condo", rooms=D("5.0"),
             bedroom=D("2.0"), bathroom=D("1.0"), sqft=None, price=None),
        dict(property_id=2, address="a", neighborhood_id=1, property_type="Castle", rooms=D("5.0"),
             bedroom=D("2.0"), bathroom=D("1.0"), sqft=0, price=D("-1")),
        dict(property_id=3, address=None, neighborhood_id=None, property_type=None, rooms=D("5.0"),
             bedroom=D("2.0"), bathroom=D("1.0"), sqft=10, price=D("1")),
    ]
    c = _counts(quality.row_rule_counts(frame(spark, "properties", rows), "properties"))
    assert c[("properties", "domain:property_type")] == 1
    assert c[("properties", "check:sqft_positive")] == 1
    assert c[("properties", "check:price_nonneg")] == 1
    assert c[("properties", "not_null:address")] == 1
    assert c[("properties", "not_null:property_type")] == 1


def test_split_tags_failed_rules(spark):
    rows = [dict(office_id=1, office_name="o", address="a", city="c", state="NY", zip_code="1"),
            dict(office_id=2, office_name="o", address="a", city="c", state="TX", zip_code="1" * 11)]
    good, bad = quality.split(frame(spark, "offices", rows), "offices")
    assert [r.office_id for r in good.collect()] == [1]
    (r,) = bad.collect()
    assert sorted(r.failed_rules) == ["domain:state", "length:zip_code"]


def test_precision_rule_on_raw_input(spark):
    raw = spark.createDataFrame([(1, 9.9), (2, 12.5)], "neighborhood_id long, walkability_score double")
    raw = raw.select("neighborhood_id", F.col("walkability_score").alias("rooms"))
    rules = dict(quality.row_rules(quality.TABLES["properties"], raw))
    flags = raw.select(rules["precision:rooms"].alias("x")).collect()
    assert [f.x for f in flags] == [False, True]


def test_unique_nulls_do_not_collide(spark):
    cust = lambda i, email: dict(customer_id=i, first_name="f", last_name="l", email=email,
                                 customer_type="buyer", created_date=d("2023-01-01"))
    df = frame(spark, "customers", [cust(1, None), cust(2, None), cust(3, "x"), cust(4, "x"), cust(4, "y")])
    c = _counts(quality.key_rule_counts(df, "customers"))
    assert c[("customers", "unique:email")] == 2
    assert c[("customers", "primary_key:customer_id")] == 2
    assert sorted(r.customer_id for r in quality.duplicate_keys(df, ["email"]).collect()) == [3, 4]


def test_foreign_keys_ignore_null_and_flag_missing(spark):
    team = lambda i, office: dict(team_id=i, team_name="t", office_id=office)
    t = tables(spark, offices=[dict(office_id=1, office_name="o", address="a", city="c",
                                    state="NY", zip_code="1")],
               teams=[team(1, 1), team(2, None), team(3, 999)])
    assert [r.team_id for r in quality.orphans(t, "teams", "office_id").collect()] == [3]


def _graph(spark):
    return tables(
        spark,
        neighborhoods=[dict(neighborhood_id=1, neighborhood_name="n", city="c", state="NY", zip_code="1")],
        properties=[dict(property_id=p, address="a", neighborhood_id=1, property_type="Condo",
                         rooms=D("5.0"), bedroom=D("2.0"), bathroom=D("1.0")) for p in (1, 2)],
        listings=[dict(listing_id=l, property_id=p, listing_type="Sale", listing_date=d("2023-01-01"),
                       listing_status="Active") for l, p in ((10, 1), (11, 1), (12, 2))],
        property_price_history=[dict(price_history_id=h, listing_id=l, old_price=D(2), new_price=D(1))
                                for h, l in ((100, 10), (101, 12))],
        customers=[dict(customer_id=c, first_name="f", last_name="l", customer_type="buyer",
                        created_date=d("2023-01-01")) for c in (1, 2)],
        leads=[dict(lead_id=20, customer_id=1, lead_date=d("2023-01-01"), lead_status="active")],
        customer_interactions=[
            dict(interaction_id=30, customer_id=2, lead_id=20, listing_id=10, interaction_dt=ts("2023-01-02 00:00:00")),
            dict(interaction_id=31, customer_id=1, lead_id=None, listing_id=12, interaction_dt=ts("2023-01-02 00:00:00")),
        ],
        offers=[dict(offer_id=40, customer_id=2, listing_id=11, offer_price=D(1), offer_date=d("2023-01-03"),
                     status="accepted")],
        contracts=[dict(contract_id=50, offer_id=40, contract_type="purchase", contract_date=d("2023-01-04"),
                        contract_status="closed")],
    )


def test_delete_property_cascades_to_grandchildren(spark):
    t = _graph(spark)
    res = referential.delete_cascade(t, "properties", spark.createDataFrame([(1,)], "k long"),
                                     materialize=False)
    out = res.tables
    assert [r.property_id for r in out["properties"].collect()] == [2]
    assert sorted(r.listing_id for r in out["listings"].collect()) == [12]
    assert [r.price_history_id for r in out["property_price_history"].collect()] == [101]
    assert out["offers"].count() == 0 and out["contracts"].count() == 0
    inter = {r.interaction_id: r.listing_id for r in out["customer_interactions"].collect()}
    assert inter == {30: None, 31: 12}


def test_delete_customer_nulls_other_customers_lead_refs(spark):
    t = _graph(spark)
    res = referential.delete_cascade(t, "customers", spark.createDataFrame([(1,)], "k long"))
    out = res.tables
    assert out["leads"].count() == 0
    inter = {r.interaction_id: r.lead_id for r in out["customer_interactions"].collect()}
    assert inter == {30: None}  # 31 belonged to customer 1 and is deleted
    rep = {r.table_name: (r.deleted_rows, r.nulled_references)
           for r in referential.delete_report(res).collect()}
    assert rep["customer_interactions"] == (1, 1) and rep["leads"] == (1, 0)


def test_rekey_office_follows_to_children(spark):
    t = tables(spark,
               offices=[dict(office_id=1, office_name="o", address="a", city="c", state="NY", zip_code="1")],
               teams=[dict(team_id=1, team_name="t", office_id=1)],
               agents=[dict(agent_id=1, office_id=1, team_id=1, first_name="f", last_name="l", email="e",
                            license_number="L", hire_date=d("2020-01-01"))],
               commissions=[dict(commission_id=1, agent_id=1, office_id=1)])
    m = spark.createDataFrame([(1, 100)], "old_key long, new_key long")
    out = referential.rekey(t, "offices", m)
    assert [r.office_id for r in out["offices"].collect()] == [100]
    for name in ("teams", "agents", "commissions"):
        assert [r.office_id for r in out[name].collect()] == [100]


def test_defaults_fill_now_and_today(spark):
    df = spark.createDataFrame([(1, None)], "customer_id long, created_date date")
    out = quality.apply_defaults(df, "customers", load_ts="2024-02-01 10:00:00").first()
    assert str(out.created_date) == "2024-02-01"


def test_jdbc_read_is_range_partitioned_on_the_key():
    from estatelens.sources.jdbc import bounds_query, partitioned_read_options

    assert bounds_query("listings") == "(SELECT MIN(listing_id) AS lo, MAX(listing_id) AS hi FROM listings) AS b"
    o = partitioned_read_options("listings", 1, 1000, 16)
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == (
        "listing_id", "1", "1001", "16")


def test_violation_rows_name_rule_and_key(spark):
    t = tables(spark,
               offices=[dict(office_id=1, office_name="o", address="a", city="c", state="NY", zip_code="1")],
               teams=[dict(team_id=1, team_name="t", office_id=1), dict(team_id=2, team_name=None, office_id=7),
                      dict(team_id=2, team_name="t", office_id=1)])
    got = sorted((r.rule_id, r.key) for r in quality.violations(t, "teams").collect())
    assert got == [("foreign_key:office_id->offices", 2), ("not_null:team_name", 2),
                   ("primary_key:team_id", 2), ("primary_key:team_id", 2)]


def test_no_orphans_after_cascading_deletes(spark):
    from pyspark.sql import functions as F

    from estatelens.sources.generator import generate

    t = generate(spark, scale=3.0, seed=21)
    for table, keys in [
        ("properties", t["properties"].where(F.col("property_id") % 3 == 0).select("property_id")),
        ("customers", t["customers"].where(F.col("customer_type") == "renter").select("customer_id")),
        ("agents", t["agents"].where(F.col("status") == "Retired").select("agent_id")),
        ("offices", t["offices"].where(F.col("office_id") <= 2).select("office_id")),
    ]:
        res = referential.delete_cascade(t, table, keys, materialize=False)
        bad = quality.foreign_key_report(res.tables).where("violations > 0").collect()
        assert bad == [], (table, bad)
        assert res.tables[table].count() == t[table].count() - keys.distinct().count()


def test_reports_deal_parts_by_rows_and_keep_every_violation(spark, monkeypatch):
    """Small parts, parents broadcast or not, keys that many rows share."""
    team = lambda i, office: dict(team_id=i, team_name="t", office_id=office)
    agent = lambda i, email, o, tm: dict(agent_id=i, office_id=o, team_id=tm, first_name="f", last_name="l", email=email,
                                         license_number=None, hire_date=d("2020-01-01"))
    t = tables(spark, offices=[dict(office_id=i, office_name="o", address="a", city="c", state="NY", zip_code="1") for i in (1, 1, 2)],
               teams=[team(3, 1)] * 1500 + [team(4, 9), team(5, None), team(None, 8)],
               agents=[agent(i, f"e{i // 2}", 1, 77 if i % 3 else 3) for i in range(1, 41)])
    expected = ([("offices", "primary_key:office_id", 1)] * 2 + [("teams", "primary_key:team_id", 3)] * 1500
                + [("teams", "foreign_key:office_id->offices", None), ("teams", "foreign_key:office_id->offices", 4)]
                + [("teams", "not_null:team_id", None)]
                + [("agents", "unique:email", i) for i in range(2, 40)]
                + [("agents", "foreign_key:team_id->teams", i) for i in range(1, 41) if i % 3]
                + [("agents", "not_null:license_number", i) for i in range(1, 41)])
    expected.sort(key=lambda r: (r[0], r[1], r[2] or 0))
    monkeypatch.setattr(quality, "ROWS_A_PART", 100)
    n = {(a, b): sum(1 for x in expected if x[:2] == (a, b)) for a, b, _ in expected}
    assert {k: v for k, v in _counts(quality.key_rule_report(t)).items() if v} == {
        k: v for k, v in n.items() if k[1].startswith(("primary", "unique"))}
    for room in (3 * quality.KEY_BYTES, 0):
        monkeypatch.setattr(quality, "BROADCAST_BYTES", room)
        got = [(r.table_name, r.rule_id, r.key) for r in quality.violation_report(t).collect()]
        assert sorted(got, key=lambda r: (r[0], r[1], r[2] or 0)) == expected
    assert {k: v for k, v in _counts(quality.foreign_key_report(t)).items() if v} == {
        k: v for k, v in n.items() if k[1].startswith("foreign")}


def test_parts_of_the_key_report_follow_the_rows(spark, monkeypatch, capsys):
    customer = lambda i: dict(customer_id=i, first_name="f", last_name="l", email=f"e{i}", customer_type="buyer", created_date=d("2023-01-01"))
    t = tables(spark, customers=[customer(i) for i in range(90)])
    monkeypatch.setattr(quality, "ROWS_A_PART", 10)
    quality.key_rule_report(t).explain()
    assert "10), REPARTITION_BY_NUM" in capsys.readouterr().out


def test_sorts_by_listing_are_dealt_by_the_rows(spark, monkeypatch, tmp_path, capsys):
    import importlib

    driver_tables = importlib.import_module("estatelens.sources.driver_tables")
    spark.range(40).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "100.0D AS o_totalprice").write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(80).selectExpr("id % 40 AS l_orderkey", "cast(id AS int) AS l_linenumber", "id AS l_partkey", "id AS l_suppkey",
                               "10.0D AS l_extendedprice", "1.0D AS l_quantity", "0.01D AS l_discount").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(driver_tables, "ROWS_A_PART", 4)
    t = driver_tables.DriverTables(spark, str(tmp_path))
    for name, rows, parts in (("property_price_history", 80, 21), ("offers", 40, 11)):
        t[name].explain()
        assert f"{parts}), REPARTITION_BY_NUM" in capsys.readouterr().out
        assert t[name].count() == rows
