"""Queries: profiling, histograms, correlation, eligibility, universe filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import quality as Q
from panelforge.plans import oracle as O
from panelforge.plans import pipelines as P
from panelforge.plans.catalog import Tables, register, rounded
from panelforge.plans.catalog_outliers import KEEP, WINSORIZED, _panel

PROFILED = ["CSR__ROA", "VQ_MARKET_CAP", "VQ__PIOTROSKI_F_SCORE", "RETURNS_NEXT", "RISK", "INDEX_RETURNS_NEXT"]


def _labelled(spark, base):
    t = Tables(spark, base).once("price")
    return P.labelled_panel(t.financials, t.price, t.index_values)


def _pct(expr: str) -> str:
    return f"floor(avg({expr}) * 100 * 100 + 0.5) / 100"


@register(
    "null_zero_profile",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS METRIC, {_pct(f'CASE WHEN {c} IS NULL THEN 1 ELSE 0 END')} AS NULL_PCT, "
        f"{_pct(f'CASE WHEN {c} = 0 THEN 1 ELSE 0 END')} AS ZERO_PCT FROM panel"
        for c in PROFILED
    ),
    ["panel"],
)
def null_zero_profile(spark, base):
    return Q.null_zero_profile(_labelled(spark, base), PROFILED)


@register(
    "null_profile_by_entity",
    "\nUNION ALL\n".join(
        f"SELECT CODE, '{c}' AS METRIC, {_pct(f'CASE WHEN {c} IS NULL THEN 1 ELSE 0 END')} AS NULL_PCT, "
        f"{_pct(f'CASE WHEN {c} = 0 THEN 1 ELSE 0 END')} AS ZERO_PCT FROM panel GROUP BY CODE"
        for c in PROFILED
    ),
    ["panel"],
)
def null_profile_by_entity(spark, base):
    return Q.null_zero_profile(_labelled(spark, base), PROFILED, by=("CODE",))


DESCRIBED = [c for c in KEEP if c not in ("YEAR", "CODE")]


@register(
    "describe_panel",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS METRIC, count({c}) AS COUNT, round(avg({c}), 6) AS MEAN, round(stddev_samp({c}), 6) AS STD, "
        f"min({c}) AS MIN, round(quantile_cont({c}, 0.25), 6) AS P25, round(quantile_cont({c}, 0.5), 6) AS P50, "
        f"round(quantile_cont({c}, 0.75), 6) AS P75, max({c}) AS MAX FROM opanel"
        for c in DESCRIBED
    ),
    ["opanel"],
)
def describe_panel(spark, base):
    d = Q.describe(_panel(spark, base), DESCRIBED)
    return rounded(d, ["MEAN", "STD", "P25", "P50", "P75"], 6)


CORR = WINSORIZED + ["RETURNS"]


@register(
    "correlation_matrix",
    "\nUNION ALL\n".join(
        f"SELECT '{a}' AS METRIC_A, '{b}' AS METRIC_B, round(abs(corr({a}, {b})), 6) AS CORR FROM opanel"
        for i, a in enumerate(CORR)
        for b in CORR[:i]
    ),
    ["opanel"],
)
def correlation_matrix(spark, base):
    return rounded(Q.correlation_matrix(_panel(spark, base), CORR), ["CORR"])


def _hist_sql(src: str, col: str, bins: int, by: str | None = None) -> str:
    byc = f"{by}, " if by else ""
    return f"""
SELECT '{col}' AS METRIC, {byc}BIN, lo + (BIN - 1) * ((hi - lo) / {bins}) AS LOW, lo + BIN * ((hi - lo) / {bins}) AS HIGH, COUNT
FROM (SELECT {byc}BIN, count(*) AS COUNT, any_value(lo) AS lo, any_value(hi) AS hi FROM (
        SELECT {byc}CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor(({col} - lo) / (hi - lo) * {bins}) + 1, {bins}) END AS INTEGER) AS BIN, lo, hi
        FROM {src}, (SELECT min({col}) AS lo, max({col}) AS hi FROM {src}) s WHERE {col} IS NOT NULL) b
      GROUP BY {byc}BIN) g
"""


@register("histogram", _hist_sql("yearly_prices", "RETURNS", 10), ["yearly_prices"])
def histogram(spark, base):
    return Q.histogram(P.yearly_prices(Tables(spark, base).price), "RETURNS", 10)


@register("class_histogram", _hist_sql("panel", "CSR__ROC_JOEL_GREENBLATT", 7, "RETURNS_NEXT_CAT"), ["panel"])
def class_histogram(spark, base):
    return Q.histogram(_labelled(spark, base), "CSR__ROC_JOEL_GREENBLATT", 7, by=("RETURNS_NEXT_CAT",))


def _box_sql(cols, by: str | None) -> str:
    parts = []
    byc, grp, on = (f"{by}, ", f" GROUP BY {by}", f" JOIN q USING ({by})") if by else ("", "", ", q")
    for c in cols:
        q = (f"WITH q AS (SELECT {byc}round(quantile_cont({c}, 0.25), 6) AS Q1, round(quantile_cont({c}, 0.5), 6) AS MEDIAN, "
             f"round(quantile_cont({c}, 0.75), 6) AS Q3 FROM opanel{grp}) ")
        inside = f"{c} >= Q1 - 1.5 * (Q3 - Q1) AND {c} <= Q3 + 1.5 * (Q3 - Q1)"
        parts.append(
            f"SELECT * FROM ({q}SELECT {byc}'{c}' AS METRIC, max(Q1) AS Q1, max(MEDIAN) AS MEDIAN, max(Q3) AS Q3, "
            f"min(CASE WHEN {inside} THEN {c} END) AS WHISKER_LOW, max(CASE WHEN {inside} THEN {c} END) AS WHISKER_HIGH, "
            f"count(CASE WHEN {c} IS NOT NULL AND NOT ({inside}) THEN 1 END) AS OUTLIERS FROM opanel{on}{grp}) t"
        )
    return "\nUNION ALL\n".join(parts)


@register("boxplot_summary", _box_sql(WINSORIZED, None), ["opanel"])
def boxplot_summary(spark, base):
    return Q.boxplot_summary(_panel(spark, base), WINSORIZED)


@register("boxplot_summary_by_year", _box_sql(WINSORIZED, "YEAR"), ["opanel"])
def boxplot_summary_by_year(spark, base):
    return Q.boxplot_summary(_panel(spark, base), WINSORIZED, by=("YEAR",))


O.cte(
    "sparse_yearly",
    """
SELECT YEAR, CODE, arg_min(PRICE, DATE) AS PRICE_START, arg_max(PRICE, DATE) AS PRICE_END, stddev_samp(PRICE) AS RISK,
       (arg_max(PRICE, DATE) - arg_min(PRICE, DATE)) / NULLIF(arg_min(PRICE, DATE), 0) AS RETURNS
FROM price_sparse GROUP BY YEAR, CODE
""",
    ("price_sparse",),
)


@register(
    "entity_eligibility",
    """
SELECT s.YEAR, s.CODE, s.RETURNS, round(s.RISK, 6) AS RISK FROM sparse_yearly s
WHERE s.CODE IN (
  SELECT CODE FROM sparse_yearly GROUP BY CODE
  HAVING sum(CASE WHEN PRICE_START IS NULL OR PRICE_END IS NULL OR RISK IS NULL OR RETURNS IS NULL THEN 1 ELSE 0 END) = 0
     AND count(*) >= 3 AND max(YEAR) - min(YEAR) + 1 = count(*)
     AND max(YEAR) = (SELECT max(YEAR) FROM sparse_yearly))
""",
    ["sparse_yearly"],
)
def entity_eligibility(spark, base):
    y = P.yearly_prices(Tables(spark, base).price_sparse)
    return rounded(Q.eligible_rows(y, "CODE", "YEAR", min_periods=3).select("YEAR", "CODE", "RETURNS", "RISK"), ["RISK"])


@register(
    "eligible_entities",
    """
SELECT CODE, count(*) AS N, min(YEAR) AS FIRST_PERIOD, max(YEAR) AS LAST_PERIOD,
       CAST(sum(CASE WHEN PRICE_START IS NULL OR PRICE_END IS NULL OR RISK IS NULL OR RETURNS IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS NULL_ROWS
FROM sparse_yearly GROUP BY CODE
HAVING sum(CASE WHEN PRICE_START IS NULL OR PRICE_END IS NULL OR RISK IS NULL OR RETURNS IS NULL THEN 1 ELSE 0 END) = 0
   AND count(*) >= 3 AND max(YEAR) - min(YEAR) + 1 = count(*) AND max(YEAR) = (SELECT max(YEAR) FROM sparse_yearly)
""",
    ["sparse_yearly"],
)
def eligible_entities(spark, base):
    y = P.yearly_prices(Tables(spark, base).price_sparse)
    return Q.entity_eligibility(y, "CODE", "YEAR", min_periods=3)


@register(
    "exclude_zero_cap_entities",
    """
SELECT YEAR, CODE, VQ_MARKET_CAP, CSR__ROC_JOEL_GREENBLATT FROM fund
WHERE CODE NOT IN (SELECT CODE FROM fund WHERE VQ_MARKET_CAP = 0)
""",
    ["fund"],
)
def exclude_zero_cap_entities(spark, base):
    f = P.fundamentals(Tables(spark, base).financials, True, ["VQ_MARKET_CAP", "CSR__ROC_JOEL_GREENBLATT"])
    return Q.drop_entities_with_value(f, "VQ_MARKET_CAP", 0)


@register(
    "distinct_counts",
    """
SELECT (SELECT count(*) FROM panel) AS ROWS, METRIC, DISTINCT_ AS "DISTINCT" FROM (
  SELECT 'CODE' AS METRIC, count(DISTINCT CODE) AS DISTINCT_ FROM panel
  UNION ALL SELECT 'YEAR', count(DISTINCT YEAR) FROM panel
  UNION ALL SELECT 'RETURNS_vs_INDEX_NEXT', count(DISTINCT RETURNS_vs_INDEX_NEXT) FROM panel
  UNION ALL SELECT 'VQ__PIOTROSKI_F_SCORE', count(DISTINCT VQ__PIOTROSKI_F_SCORE) FROM panel) t
""",
    ["panel"],
)
def distinct_counts(spark, base):
    return Q.distinct_counts(_labelled(spark, base), ["CODE", "YEAR", "RETURNS_vs_INDEX_NEXT", "VQ__PIOTROSKI_F_SCORE"])


SUMMED = ["VQ_MARKET_CAP", "VQ__YOY_EBITDA_GROWTH", "PRELIMINARY"]


@register(
    "zero_sum_columns",
    "\nUNION ALL\n".join(
        f"SELECT CODE, '{c}' AS METRIC, round(CAST(sum({c}) AS DOUBLE), 4) AS SUM, round(CAST(sum({c}) AS DOUBLE), 4) = 0 AS IS_ZERO "
        f"FROM financials_quarterly GROUP BY CODE"
        for c in SUMMED
    ),
    ["financials_quarterly"],
)
def zero_sum_columns(spark, base):
    fq = Tables(spark, base).financials_quarterly.withColumn("PRELIMINARY", F.col("PRELIMINARY").cast("double"))
    z = Q.zero_sum_columns(fq, SUMMED, by=("CODE",))
    return z.withColumn("SUM", F.round("SUM", 4)).withColumn("IS_ZERO", F.col("SUM") == 0)


UNIVERSE_FEATURES = ["CSR__ROC_JOEL_GREENBLATT", "VR__EV_TO_EBIT", "CSR__ROA", "RETURNS", "RISK"]


@register(
    "training_universe",
    """
SELECT YEAR, CODE, """ + ", ".join(UNIVERSE_FEATURES).replace("RISK", "round(RISK, 6) AS RISK") + """, RETURNS_NEXT, INDEX_RETURNS_NEXT FROM panel
WHERE YEAR > 1990 AND YEAR < 2016
  AND """ + " AND ".join(f"{c} IS NOT NULL" for c in UNIVERSE_FEATURES) + """
  AND RETURNS_NEXT > -0.9 AND RETURNS_NEXT < 0.9 AND RETURNS_NEXT <> 0 AND INDEX_RETURNS_NEXT > -0.2
""",
    ["panel"],
)
def training_universe(spark, base):
    p = _labelled(spark, base).select("YEAR", "CODE", *UNIVERSE_FEATURES, "RETURNS_NEXT", "INDEX_RETURNS_NEXT")
    p = p.where(Q.between_open("YEAR", 1990, 2016))
    p = Q.drop_nulls(p, UNIVERSE_FEATURES)
    p = p.where(Q.between_open("RETURNS_NEXT", -0.9, 0.9) & (F.col("RETURNS_NEXT") != 0)
                & (F.col("INDEX_RETURNS_NEXT") > -0.2))
    return rounded(p, ["RISK"])


@register(
    "anti_join_zero_cap",
    "SELECT YEAR, CODE, VQ_MARKET_CAP FROM fund f WHERE NOT EXISTS (SELECT 1 FROM fund z WHERE z.CODE = f.CODE AND z.VQ_MARKET_CAP = 0)",
    ["fund"],
)
def anti_join_zero_cap(spark, base):
    """Companies with a zero market cap dropped by an anti join on their keys."""
    f = P.fundamentals(Tables(spark, base).financials, True, ["VQ_MARKET_CAP"])
    return Q.drop_entities(f, Q.entities_with_value(f, "VQ_MARKET_CAP", 0)).select("YEAR", "CODE", "VQ_MARKET_CAP")
