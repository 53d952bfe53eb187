"""Queries: dashboards, portfolio growth, unions, suffixed joins, quarterly dataset
(F11-F15, A11, A12, J3-J5, W6, P14, P18, T7-T9, U1, U2)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelforge.functions.columns import case_label
from panelforge.operators import dashboards as D
from panelforge.operators import returns as T
from panelforge.operators import sets as SE
from panelforge.plans import oracle as O
from panelforge.plans import pipelines as P
from panelforge.plans.catalog import Tables, register, rounded
from panelforge.plans.catalog_models import _SCORE_SQL, _walk_forward_lr
from panelforge.session import write_once

# Dashboard parameters for the driver's data (years 1995..2001): picks for 2000
# are made with the data of 1999; top 20; market cap from 50 up or unknown.
PICK_YEAR, TOP_N, CAP_LOW = 2000, 20, 50.0
PICK_REGIONS = ("AMERICA", "EUROPE")

O.cte("gb_metrics", _SCORE_SQL, ("gb_scored",))


def _attr(c: str) -> str:
    return f"CASE WHEN min({c}) = max({c}) THEN min({c}) END AS {c}"


#: Page of a company on a quote site, an argument of the dashboard.
QUOTE_PAGE = "https://quotes.example/"


def _picks_sql(region_filter: str = "") -> str:
    return f"""
SELECT *, PRICE_END - PRICE_START AS PRICE_DIFF, '{QUOTE_PAGE}' || CODE AS URL FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY SUM_RANKING ASC NULLS LAST, CODE) AS INTEGER) AS RANK_UNIQUE FROM (
    SELECT CODE, CAST(sum(RANKING) AS BIGINT) AS SUM_RANKING, {_attr('COMPANY')}, {_attr('REGION')}, {_attr('CAP')},
           {_attr('PRICE_START')}, {_attr('PRICE_END')}, {_attr('RETURNS')}, count(*) AS NUMBER_OF_RECORDS
    FROM (SELECT CODE, COMPANY, REGION FROM companies) c JOIN gb_metrics m USING (CODE)
    WHERE YEAR = {PICK_YEAR} - 1 AND (CAP >= {CAP_LOW} OR CAP IS NULL) {region_filter}
    GROUP BY CODE) g
  QUALIFY row_number() OVER (ORDER BY SUM_RANKING ASC NULLS LAST, CODE) <= {TOP_N}) t
"""


O.cte("dash_picks", _picks_sql(), ("gb_metrics", "companies"))


def _picks(spark, base, regions=None):
    t = Tables(spark, base)
    metrics = _walk_forward_lr(spark, base, "closed", PICK_YEAR - 1)
    return D.picks(metrics, t.companies, PICK_YEAR, TOP_N, "RANKING", CAP_LOW, regions, QUOTE_PAGE)


@register("dashboard_picks", "SELECT * FROM dash_picks", ["dash_picks"])
def dashboard_picks(spark, base):
    return _picks(spark, base)


@register(
    "dashboard_picks_region",
    _picks_sql("AND REGION IN (" + ", ".join(f"'{r}'" for r in PICK_REGIONS) + ")"),
    ["gb_metrics", "companies"],
)
def dashboard_picks_region(spark, base):
    return _picks(spark, base, PICK_REGIONS)


O.cte(
    "price_ret",
    """
SELECT *, (PRICE - PRICE_START) / NULLIF(PRICE_START, 0) AS CUMULATIVE_RETURNS
FROM (SELECT *, first_value(PRICE) OVER (PARTITION BY CODE, YEAR ORDER BY DATE
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS PRICE_START FROM price) t
""",
    ("price",),
)
O.cte(
    "index_ret",
    """
SELECT *, (ADJ_CLOSE - PRICE_START) / NULLIF(PRICE_START, 0) AS CUMULATIVE_RETURNS
FROM (SELECT *, first_value(OPEN) OVER (PARTITION BY INDICE, YEAR ORDER BY DATE
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS PRICE_START FROM index_values) t
""",
    ("index_values",),
)


@register(
    "dashboard_cumulative_vs_index",
    f"""
SELECT d.DATE, N_CODES, CASE WHEN N_CODES >= 1 THEN round(a, 9) END AS AVG_CUMULATIVE_RETURNS,
       CASE WHEN N_CODES >= 1 OR N_CODES < 25 THEN round(p, 9) END AS AVG_PRICE,
       i.CUMULATIVE_RETURNS AS INDEX_CUMULATIVE_RETURNS
FROM (SELECT DATE, count(DISTINCT CODE) AS N_CODES, avg(CUMULATIVE_RETURNS) AS a, avg(PRICE) AS p
      FROM price_ret WHERE year(DATE) = {PICK_YEAR} AND CODE IN (SELECT CODE FROM dash_picks) GROUP BY DATE) d
LEFT JOIN (SELECT DATE, CUMULATIVE_RETURNS FROM index_ret WHERE year(DATE) = {PICK_YEAR}) i USING (DATE)
""",
    ["price_ret", "index_ret", "dash_picks"],
)
def dashboard_cumulative_vs_index(spark, base):
    t = Tables(spark, base).once("price")
    sel = _picks(spark, base)
    prices, quotes = write_once(t.price, "daily"), write_once(t.index_values, "daily")
    out = D.cumulative_vs_index(P.price_returns_job(prices), sel, P.index_returns_job(quotes), PICK_YEAR)
    return rounded(out, ["AVG_CUMULATIVE_RETURNS", "AVG_PRICE"], 9)


@register(
    "index_quotes_named",
    "SELECT v.DATE, i.NAME, i.REGION, v.ADJ_CLOSE, v.VOLUME FROM index_table i JOIN index_values v ON i.ID = v.INDICE",
    ["index_table", "index_values"],
)
def index_quotes_named(spark, base):
    t = Tables(spark, base)
    i, v = t.index_table, t.index_values
    return i.join(v, i.ID == v.INDICE).select("DATE", "NAME", "REGION", "ADJ_CLOSE", "VOLUME")


O.cte(
    "gb_top20",
    """
SELECT * FROM (SELECT *, ROC_RANKING + EBIT_RANKING AS SCORE FROM greenblatt) s
QUALIFY row_number() OVER (PARTITION BY YEAR ORDER BY SCORE, CODE) <= 20
""",
    ("greenblatt",),
)


@register(
    "portfolio_vs_index_growth",
    """
SELECT YEAR, N_PICKS, round(PORTFOLIO_RETURN, 9) AS PORTFOLIO_RETURN, INDEX_RETURNS_NEXT,
       round(exp(sum(ln(1 + PORTFOLIO_RETURN)) OVER w), 6) AS PORTFOLIO_GROWTH,
       round(exp(sum(ln(1 + INDEX_RETURNS_NEXT)) OVER w), 6) AS INDEX_GROWTH
FROM (SELECT t.YEAR, count(*) AS N_PICKS, avg(p.RETURNS_NEXT) AS PORTFOLIO_RETURN
      FROM gb_top20 t JOIN panel p USING (YEAR, CODE) GROUP BY t.YEAR) y
LEFT JOIN (SELECT YEAR, lead(INDEX_RETURNS) OVER (ORDER BY YEAR) AS INDEX_RETURNS_NEXT FROM index_yearly) i USING (YEAR)
WINDOW w AS (ORDER BY YEAR ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""",
    ["gb_top20", "panel", "index_yearly"],
)
def portfolio_vs_index_growth(spark, base):
    t = Tables(spark, base).once("price", "financials")
    top = P.greenblatt_top_n(t.financials, t.price, t.companies, 20).select("YEAR", "CODE")
    panel = P.labelled_panel(t.financials, t.price, t.index_values).select("YEAR", "CODE", "RETURNS_NEXT")
    idx = P.index_yearly_returns(P.one_index(t.index_values))
    idx_next = idx.select("YEAR", F.lead("INDEX_RETURNS").over(Window.orderBy("YEAR")).alias("INDEX_RETURNS_NEXT"))
    out = D.portfolio_vs_index(top.join(panel, ["YEAR", "CODE"]), idx_next)
    return rounded(rounded(out, ["PORTFOLIO_RETURN"], 9), ["PORTFOLIO_GROWTH", "INDEX_GROWTH"], 6)


@register(
    "union_missing_columns",
    """
SELECT f.YEAR, f.CODE, f.CSR__ROC_JOEL_GREENBLATT, y.RETURNS, round(y.RISK, 6) AS RISK
FROM fund f JOIN yearly_prices y USING (YEAR, CODE)
UNION ALL BY NAME
SELECT YEAR, CODE, RETURNS, round(RISK, 6) AS RISK FROM sparse_yearly
""",
    ["fund", "yearly_prices", "sparse_yearly"],
)
def union_missing_columns(spark, base):
    t = Tables(spark, base).once("price")
    a = P.fundamentals(t.financials, True, ["CSR__ROC_JOEL_GREENBLATT"]).join(
        P.yearly_prices(t.price).select("YEAR", "CODE", "RETURNS", "RISK"), ["YEAR", "CODE"])
    b = P.yearly_prices(t.price_sparse).select("YEAR", "CODE", "RETURNS", "RISK")
    return rounded(SE.union_by_name([a, b], allow_missing=True), ["RISK"])


def _bounds_sql(src: str, key: str, start: str, end: str) -> str:
    return f"""
SELECT k.{key}, k.Y, k.M, s.v_start, e.v_end FROM
  (SELECT DISTINCT {key}, CAST(year(DATE) AS INTEGER) AS Y, CAST(month(DATE) AS INTEGER) AS M FROM {src}) k
  LEFT JOIN (SELECT {key}, CAST(year(DATE) AS INTEGER) AS Y, CAST(month(DATE) AS INTEGER) AS M, arg_min({start}, DATE) AS v_start
             FROM {src} WHERE day(DATE) BETWEEN 1 AND 29 AND {start} <> 0 GROUP BY 1, 2, 3) s
    ON k.{key} = s.{key} AND k.Y = s.Y AND k.M = s.M
  LEFT JOIN (SELECT {key}, CAST(year(DATE) AS INTEGER) AS Y, CAST(month(DATE) AS INTEGER) AS M, arg_max({end}, DATE) AS v_end
             FROM {src} WHERE day(DATE) >= 2 AND day(DATE) <= CASE WHEN month(DATE) IN (3, 12) THEN 31 ELSE 30 END
               AND {end} <> 0 GROUP BY 1, 2, 3) e
    ON k.{key} = e.{key} AND k.Y = e.Y AND k.M = e.M
"""


def _qret_sql(quarters: str, bounds: str, qkey: str | None, bkey: str | None, prefix: str = "") -> str:
    on_s = f"s.{bkey} = q.{qkey} AND " if qkey else ""
    on_e = f"e.{bkey} = q.{qkey} AND " if qkey else ""
    return f"""
SELECT *, CASE WHEN {prefix}PRICE_INI = 0 THEN 0.0 ELSE ({prefix}PRICE_FIN - {prefix}PRICE_INI) / {prefix}PRICE_INI END AS {prefix}RETURNS
FROM (SELECT q.*, coalesce(s.v_start, 0.0) AS {prefix}PRICE_INI, coalesce(e.v_end, 0.0) AS {prefix}PRICE_FIN
      FROM {quarters} q
      LEFT JOIN {bounds} s ON {on_s}s.Y = CAST(substr(q.FISCAL_YEAR, 1, 4) AS INTEGER) AND s.M + 2 = CAST(substr(q.FISCAL_YEAR, 6, 2) AS INTEGER)
      LEFT JOIN {bounds} e ON {on_e}e.Y = CAST(substr(q.FISCAL_YEAR, 1, 4) AS INTEGER) AND e.M = CAST(substr(q.FISCAL_YEAR, 6, 2) AS INTEGER)) t
"""


O.cte("index_month_bounds", _bounds_sql("index_values", "INDICE", "OPEN", "CLOSE"), ("index_values",))
O.cte(
    "quarterly_returns",
    _qret_sql("(SELECT CODE, FISCAL_YEAR, IS__REVENUE FROM financials_quarterly)", "month_bounds", "CODE", "CODE"),
    ("financials_quarterly", "month_bounds"),
)
O.cte(
    "index_quarterly_returns",
    _qret_sql("(SELECT DISTINCT FISCAL_YEAR FROM financials_quarterly)", "index_month_bounds", None, None, "INDEX_"),
    ("financials_quarterly", "index_month_bounds"),
)


@register(
    "quarterly_dataset",
    """
SELECT CODE AS Ticker, FISCAL_YEAR, PRICE_INI, PRICE_FIN, RETURNS, INDEX_RETURNS, IS__REVENUE,
  lead(RETURNS) OVER w AS RETURNS_NEXT, lead(INDEX_RETURNS) OVER w AS INDEX_RETURNS_NEXT,
  CASE WHEN RETURNS > 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS RETURNS_CAT,
  CASE WHEN lead(RETURNS) OVER w > 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS RETURNS_NEXT_CAT,
  CASE WHEN RETURNS > INDEX_RETURNS THEN 'WINS' ELSE 'LOSES' END AS RETURNS_vs_INDEX,
  CASE WHEN lead(RETURNS) OVER w > lead(INDEX_RETURNS) OVER w THEN 'WINS' ELSE 'LOSES' END AS RETURNS_vs_INDEX_NEXT
FROM quarterly_returns q LEFT JOIN (SELECT FISCAL_YEAR, INDEX_RETURNS FROM index_quarterly_returns) i USING (FISCAL_YEAR)
WINDOW w AS (PARTITION BY CODE ORDER BY FISCAL_YEAR)
""",
    ["quarterly_returns", "index_quarterly_returns"],
)
def quarterly_dataset(spark, base):
    t = Tables(spark, base).once("price")
    fq = write_once(t.financials_quarterly.select("CODE", "FISCAL_YEAR", "IS__REVENUE"), "quarters")
    q = T.quarterly_return(fq, t.price)
    iq = T.quarterly_return(fq.select("FISCAL_YEAR").distinct().withColumn("INDICE", F.lit(1)), t.index_values,
                            key="INDICE", start_value="OPEN", end_value="CLOSE", prefix="INDEX_")
    j = q.join(iq.select("FISCAL_YEAR", "INDEX_RETURNS"), "FISCAL_YEAR", "left")
    w = Window.partitionBy("CODE").orderBy("FISCAL_YEAR")
    r, i = F.col("RETURNS"), F.col("INDEX_RETURNS")
    rn, inx = F.lead("RETURNS").over(w), F.lead("INDEX_RETURNS").over(w)
    return j.select(
        F.col("CODE").alias("Ticker"), "FISCAL_YEAR", "PRICE_INI", "PRICE_FIN", "RETURNS", "INDEX_RETURNS", "IS__REVENUE",
        rn.alias("RETURNS_NEXT"), inx.alias("INDEX_RETURNS_NEXT"),
        case_label(r > 0, "POSITIVE", "NEGATIVE").alias("RETURNS_CAT"),
        case_label(rn > 0, "POSITIVE", "NEGATIVE").alias("RETURNS_NEXT_CAT"),
        case_label(r > i, "WINS", "LOSES").alias("RETURNS_vs_INDEX"),
        case_label(rn > inx, "WINS", "LOSES").alias("RETURNS_vs_INDEX_NEXT"),
    )


@register(
    "monthly_fin_join",
    """
SELECT m.CODE, m.YEAR, m.MONTH, m.OPEN, m.HIGH, m.LOW, m.CLOSE, m.RETURNS AS RETURNS_prices,
       q.RETURNS AS RETURNS_fin, q.IS__REVENUE, q.FISCAL_YEAR
FROM (SELECT CODE, YEAR, MONTH, OPEN, HIGH, LOW, CLOSE, (CLOSE - OPEN) / NULLIF(OPEN, 0) AS RETURNS FROM (
        SELECT CODE, YEAR, CAST(month(DATE) AS INTEGER) AS MONTH, arg_min(PRICE, DATE) AS OPEN, max(PRICE) AS HIGH,
               min(PRICE) AS LOW, arg_max(PRICE, DATE) AS CLOSE FROM price GROUP BY CODE, YEAR, month(DATE)) a) m
LEFT JOIN (SELECT CODE, CAST(substr(FISCAL_YEAR, 1, 4) AS INTEGER) AS YEAR, CAST(substr(FISCAL_YEAR, 6, 2) AS INTEGER) AS MONTH,
                  RETURNS, IS__REVENUE, FISCAL_YEAR FROM quarterly_returns) q
  ON m.CODE = q.CODE AND m.YEAR = q.YEAR AND m.MONTH = q.MONTH
""",
    ["price", "quarterly_returns"],
)
def monthly_fin_join(spark, base):
    t = Tables(spark, base).once("price")
    monthly = T.monthly_ohlc(t.price)
    fq = t.financials_quarterly.select("CODE", "FISCAL_YEAR", "IS__REVENUE")
    q = T.quarterly_return(fq, t.price).select(
        "CODE", F.substring("FISCAL_YEAR", 1, 4).cast("int").alias("YEAR"),
        F.substring("FISCAL_YEAR", 6, 2).cast("int").alias("MONTH"), "RETURNS", "IS__REVENUE", "FISCAL_YEAR")
    return SE.left_join_suffixed(monthly, q, ["CODE", "YEAR", "MONTH"])
