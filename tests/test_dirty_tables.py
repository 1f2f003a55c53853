"""The integrity queries see broken rows of every declared rule."""

import os

import pytest

import __spark_entry__ as E
from tools.check_oracle import duck

SF = "/root/testdata/sf0.01"
REPORTS = ("quality_row_rules", "quality_key_rules", "quality_foreign_keys")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver data missing")


@pytest.fixture(scope="module")
def counts():
    """Expected violations by (table, rule), from the oracle alone (its
    agreement with the jobs is test_oracle's)."""
    con = duck(SF)
    return {(t, r): n for q in REPORTS
            for t, r, n in con.execute(f"SELECT table_name, rule_id, violations FROM ({E.oracle_sql()[q]})").fetchall()}


def test_every_rule_is_broken_somewhere(counts):
    # offices has five rows, too few for each of its rules
    assert [k for k, n in counts.items() if n == 0 and k[0] != "offices"] == []
    assert any(n for k, n in counts.items() if k[0] == "offices")


def test_violations_are_listed_once_each(counts):
    rows = duck(SF).execute(E.oracle_sql()["quality_violations"]).df()
    assert rows.groupby(["table_name", "rule_id"]).size().to_dict() == {k: n for k, n in counts.items() if n}


def test_precision_rule_needs_wider_input(spark):
    from estatelens.operators import quality
    from estatelens.sources.dirty_tables import dirty_tables
    from estatelens.sources.driver_tables import driver_tables

    clean = driver_tables(spark, "/root/testdata/sf0.001")
    names = lambda df: {rid for rid, _ in quality.row_rules(quality.TABLES["properties"], df)}
    assert names(dirty_tables(clean)["properties"]) - names(clean["properties"]) == {
        "precision:rooms", "precision:bedroom", "precision:bathroom", "precision:price"}
