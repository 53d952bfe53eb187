"""How often a query scans the largest raw table."""

import importlib.util
from pathlib import Path

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
spec = importlib.util.spec_from_file_location("audit_plans", Path(__file__).resolve().parents[1] / "scripts" / "audit_plans.py")
audit_plans = importlib.util.module_from_spec(spec)
spec.loader.exec_module(audit_plans)

# prices alone: one scan; prices and fundamentals: two
MOST = {"price_ytd_return": 1, "price_daily_return": 1, "winsorize_by_year": 2, "quarterly_dataset": 2, "vs_index_labels": 2,
        "class_weights": 2, "encode_labels": 2, "portfolio_vs_index_growth": 2, "yearly_dataset": 2, "describe_panel": 2}


@pytest.mark.parametrize("name", sorted(MOST))
def test_scans_of_the_largest_table(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan shows what is reused
    try:
        plan, scans = audit_plans.audit(E.queries()[name], spark, SF)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "CartesianProduct" not in plan
    assert 0 < scans <= MOST[name]
