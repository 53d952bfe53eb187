"""Queries: fences, fence filters and winsorizing."""

from __future__ import annotations

from panelforge.operators import outliers as OUT
from panelforge.plans import oracle as O
from panelforge.plans import pipelines as P
from panelforge.plans.catalog import Tables, register

FENCED = ["CSR__ROC_JOEL_GREENBLATT", "VR__EV_TO_EBIT"]
WINSORIZED = ["CSR__ROC_JOEL_GREENBLATT", "VR__EV_TO_EBIT", "CSR__ROE", "CSR__NET_MARGIN", "VQ__ALTMAN_Z_SCORE",
              "CSR__ROA"]
KEEP = ["YEAR", "CODE", "CSR__ROC_JOEL_GREENBLATT", "VR__EV_TO_EBIT", "CSR__ROE", "CSR__NET_MARGIN",
        "VQ__ALTMAN_Z_SCORE", "CSR__ROA", "RETURNS"]

O.cte(
    "opanel",
    "SELECT " + ", ".join(f"f.{c}" if c != "RETURNS" else "y.RETURNS" for c in KEEP)
    + " FROM fund f JOIN yearly_prices y USING (YEAR, CODE)",
    ("fund", "yearly_prices"),
)


def _panel(spark, base):
    t = Tables(spark, base)
    return P.fundamentals(t.financials).join(P.yearly_prices(t.price), ["YEAR", "CODE"]).select(*KEEP)


def _q(c: str, p: float, over: str = "") -> str:
    return f"round(quantile_cont({c}, {p}){over}, 6)"


@register(
    "fence_bounds",
    "SELECT YEAR, METRIC, Q1, Q3, Q3 - Q1 AS IQR, Q1 - 1.5 * (Q3 - Q1) AS LOW, Q3 + 1.5 * (Q3 - Q1) AS HIGH FROM (\n"
    + "\nUNION ALL\n".join(
        f"SELECT YEAR, '{c}' AS METRIC, {_q(c, 0.25)} AS Q1, {_q(c, 0.75)} AS Q3 FROM opanel GROUP BY YEAR" for c in WINSORIZED
    )
    + ") t",
    ["opanel"],
)
def fence_bounds(spark, base):
    return OUT.fence_bounds(_panel(spark, base), WINSORIZED)


def _global_sql(cols):
    ctes = ["s0 AS (SELECT * FROM opanel)"]
    for i, c in enumerate(cols, 1):
        ctes.append(f"b{i} AS (SELECT {_q(c, 0.25)} AS q1, {_q(c, 0.75)} AS q3 FROM s{i-1})")
        ctes.append(
            f"s{i} AS (SELECT s{i-1}.* FROM s{i-1}, b{i} WHERE {c} > q1 - 1.5 * (q3 - q1) AND {c} < q3 + 1.5 * (q3 - q1))"
        )
    return ", ".join(ctes), f"s{len(cols)}"


def _by_year_sql(cols):
    ctes = ["s0 AS (SELECT * FROM opanel)"]
    for i, c in enumerate(cols, 1):
        w = " OVER (PARTITION BY YEAR)"
        ctes.append(
            f"s{i} AS (SELECT * EXCLUDE (q1, q3) FROM (SELECT *, {_q(c, 0.25, w)} AS q1, {_q(c, 0.75, w)} AS q3 FROM s{i-1}) t "
            f"WHERE {c} IS NULL OR ({c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)))"
        )
    return ", ".join(ctes), f"s{len(cols)}"


_g_ctes, _g_last = _global_sql(FENCED)
O.cte("fence_global_chain", f"WITH {_g_ctes} SELECT * FROM {_g_last}", ("opanel",))


@register("fence_filter_global", "SELECT * FROM fence_global_chain", ["fence_global_chain"])
def fence_filter_global(spark, base):
    return OUT.fence_filter_global(_panel(spark, base), FENCED)


_y_ctes, _y_last = _by_year_sql(FENCED)
O.cte("fence_year_chain", f"WITH {_y_ctes} SELECT * FROM {_y_last}", ("opanel",))


@register("fence_filter_by_year", "SELECT * FROM fence_year_chain", ["fence_year_chain"])
def fence_filter_by_year(spark, base):
    return OUT.fence_filter_by(_panel(spark, base), FENCED)


_wq = ", ".join(f"{_q(c, 0.25)} AS {c}_q1, {_q(c, 0.75)} AS {c}_q3" for c in WINSORIZED)
_wclip = ", ".join(
    f"CASE WHEN p.{c} IS NULL THEN NULL ELSE least(greatest(p.{c}, {c}_q1 - 1.5 * ({c}_q3 - {c}_q1)), "
    f"{c}_q3 + 1.5 * ({c}_q3 - {c}_q1)) END AS {c}"
    for c in WINSORIZED
)


@register(
    "winsorize_by_year",
    f"""
SELECT p.YEAR, p.CODE, p.RETURNS, {_wclip}
FROM opanel p LEFT JOIN (SELECT YEAR, {_wq} FROM opanel GROUP BY YEAR) b USING (YEAR)
""",
    ["opanel"],
)
def winsorize_by_year(spark, base):
    return OUT.winsorize_by(_panel(spark, base), WINSORIZED)


# All ratio columns except the Piotroski score (a 0..9 count), in the yearly dataset order.
ALL_FENCED = [c for c in P.RATIO_COLUMNS if c != "VQ__PIOTROSKI_F_SCORE"]

O.cte("fpanel", "SELECT YEAR, CODE, " + ", ".join(ALL_FENCED) + " FROM fund", ("fund",))


def _fpanel(spark, base):
    return P.fundamentals(Tables(spark, base).financials, True, ALL_FENCED)


_ya_ctes, _ya_last = _by_year_sql(ALL_FENCED)
_ya_ctes = _ya_ctes.replace("s0 AS (SELECT * FROM opanel)", "s0 AS (SELECT * FROM fpanel)")


O.cte("fence_all_year_chain", f"WITH {_ya_ctes} SELECT * FROM {_ya_last}", ("fpanel",))


@register("fence_all_columns_by_year", "SELECT * FROM fence_all_year_chain", ["fence_all_year_chain"])
def fence_all_columns_by_year(spark, base):
    """Per-year fences applied sequentially to 24 ratio columns: 24 window aggregates
    over one partitioning (one exchange), no loop over years."""
    return OUT.fence_filter_by(_fpanel(spark, base), ALL_FENCED)


_ga_ctes, _ga_last = _global_sql(ALL_FENCED)
_ga_ctes = _ga_ctes.replace("s0 AS (SELECT * FROM opanel)", "s0 AS (SELECT * FROM fpanel)")


O.cte("fence_all_global_chain", f"WITH {_ga_ctes} SELECT * FROM {_ga_last}", ("fpanel",))


@register("fence_all_columns_global", "SELECT * FROM fence_all_global_chain", ["fence_all_global_chain"])
def fence_all_columns_global(spark, base):
    """Global fences applied sequentially to 24 ratio columns (one checkpoint, one
    small statistics job per column)."""
    return OUT.fence_filter_global(_fpanel(spark, base), ALL_FENCED)


@register(
    "fenced_dense_ranks",
    f"""
SELECT YEAR, CODE, {FENCED[0]}, {FENCED[1]},
  CASE WHEN {FENCED[0]} IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY YEAR ORDER BY {FENCED[0]} DESC NULLS LAST) AS INTEGER) END AS ROC_RANK,
  CASE WHEN {FENCED[1]} IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY YEAR ORDER BY {FENCED[1]} ASC NULLS LAST) AS INTEGER) END AS EBIT_RANK
FROM fence_year_chain
""",
    ["fence_year_chain"],
)
def fenced_dense_ranks(spark, base):
    """Per-year fences on ROC and EV/EBIT, then dense ranks on the surviving rows
    (ROC descending, EV/EBIT ascending): ranks are taken after filtering."""
    from panelforge.operators import ranks as R

    f = OUT.fence_filter_by(_panel(spark, base), FENCED).select("YEAR", "CODE", *FENCED)
    f = R.dense_rank_by(f, FENCED[0], ascending=False, out="ROC_RANK")
    return R.dense_rank_by(f, FENCED[1], ascending=True, out="EBIT_RANK")
