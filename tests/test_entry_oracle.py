"""The driver contract and a DuckDB oracle sweep on the smallest scale factor."""

import datetime as dt
import math
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
# Rows-only queries (MLlib fits, least squares per group, engine-specific hash): no SQL twin.
ROWS_ONLY = {"var1_forecast", "var1_forecast_by_sector", "var1_forecast_monthly", "var1_multi_step_rmse", "var_vs_baseline",
             "walk_forward_rf", "walk_forward_gbt", "walk_forward_gbt_fenced", "walk_forward_gbt_all_ranks", "gbt_classifier_scores",
             "gbt_classifier_scores_compound", "logistic_balanced", "mlp_scores", "linear_svm", "random_forest_classifier",
             "holdout_confusion", "grid_search_tree", "grid_search_logistic", "feature_importance", "grid_search_svm", "grid_search_forest",
             "grid_search_forest_classifier", "tree_best_depth", "forest_best_depth", "boosting_rounds",
             "grid_search_rbf_svm", "rbf_svm_best"}
FAST = ["greenblatt_top20", "yearly_dataset", "price_ytd_return", "index_ytd_return_open_base", "quarterly_dataset",
        "fence_filter_global", "fence_filter_by_year", "winsorize_by_year", "linear_interpolation", "walk_forward_lr",
        "roc_curve", "dashboard_picks", "metric_row_ranks", "boxplot_summary", "entity_eligibility", "ar1_forecast"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"YEAR", "CODE", "RANKING", "COMPANY"} <= set(df.columns)


def test_every_query_has_an_oracle_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {n for n in q if n != "pipeline" and not re.match(r"op\d+_", n)}  # the text operators have tests of their own
    assert own - set(o) == ROWS_ONLY


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_oracle_equal_on_small_fixture(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert _bag(df.columns, s_rows) == _bag(d_cols, d_rows)
