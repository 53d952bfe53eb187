"""Queries: price and index returns, period aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import returns as T
from panelforge.plans import oracle as O
from panelforge.plans import pipelines as P
from panelforge.plans.catalog import Tables, register, rounded
from panelforge.session import write_once

O.cte(
    "yearly_prices",
    """
SELECT YEAR, CODE, arg_min(PRICE, DATE) AS PRICE_START, arg_max(PRICE, DATE) AS PRICE_END,
       stddev_samp(PRICE) AS RISK,
       (arg_max(PRICE, DATE) - arg_min(PRICE, DATE)) / NULLIF(arg_min(PRICE, DATE), 0) AS RETURNS
FROM price GROUP BY YEAR, CODE
""",
    ("price",),
)


@register(
    "price_daily_return",
    """
SELECT CODE, DATE, YEAR, PRICE,
       (PRICE - lag(PRICE) OVER w) / NULLIF(lag(PRICE) OVER w, 0) AS RETURNS
FROM price WINDOW w AS (PARTITION BY CODE ORDER BY DATE)
""",
    ["price"],
)
def price_daily_return(spark, base):
    return T.daily_return(write_once(Tables(spark, base).price, "daily")).select("CODE", "DATE", "YEAR", "PRICE", "RETURNS")


@register(
    "price_daily_return_current_denominator",
    """
SELECT CODE, DATE, YEAR, PRICE,
       (PRICE - lag(PRICE) OVER w) / NULLIF(PRICE, 0) AS RETURNS
FROM price WINDOW w AS (PARTITION BY CODE ORDER BY DATE)
""",
    ["price"],
)
def price_daily_return_current(spark, base):
    return T.daily_return(write_once(Tables(spark, base).price, "daily"), denominator="current").select(
        "CODE", "DATE", "YEAR", "PRICE", "RETURNS"
    )


@register(
    "price_ytd_return",
    """
SELECT CODE, DATE, YEAR, PRICE, PRICE_START,
       (PRICE - lag(PRICE) OVER w) / NULLIF(lag(PRICE) OVER w, 0) AS RETURNS,
       (PRICE - PRICE_START) / NULLIF(PRICE_START, 0) AS CUMULATIVE_RETURNS
FROM (SELECT *, first_value(PRICE) OVER (PARTITION BY CODE, YEAR ORDER BY DATE
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS PRICE_START FROM price) t
WINDOW w AS (PARTITION BY CODE ORDER BY DATE)
""",
    ["price"],
)
def price_ytd_return(spark, base):
    return P.price_returns_job(write_once(Tables(spark, base).price, "daily")).select(
        "CODE", "DATE", "YEAR", "PRICE", "PRICE_START", "RETURNS", "CUMULATIVE_RETURNS"
    )


_INDEX_SQL = """
SELECT DATE, YEAR, INDICE, OPEN, HIGH, LOW, CLOSE, ADJ_CLOSE, VOLUME, PRICE_START,
       (ADJ_CLOSE - lag(ADJ_CLOSE) OVER w) / NULLIF(lag(ADJ_CLOSE) OVER w, 0) AS RETURNS,
       (ADJ_CLOSE - PRICE_START) / NULLIF(PRICE_START, 0) AS CUMULATIVE_RETURNS
FROM (SELECT *, first_value({base}) OVER (PARTITION BY INDICE, YEAR ORDER BY DATE
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS PRICE_START FROM index_values) t
WHERE DATE > DATE '1970-01-01'
WINDOW w AS (PARTITION BY INDICE ORDER BY DATE)
"""

_INDEX_COLS = ("DATE", "YEAR", "INDICE", "OPEN", "HIGH", "LOW", "CLOSE", "ADJ_CLOSE", "VOLUME", "PRICE_START",
               "RETURNS", "CUMULATIVE_RETURNS")


@register("index_ytd_return_open_base", _INDEX_SQL.format(base="OPEN"), ["index_values"])
def index_ytd_open(spark, base):
    q = Tables(spark, base).index_values.where(F.col("DATE") > F.lit("1970-01-01").cast("date"))
    return P.index_returns_job(write_once(q, "daily"), "OPEN").select(*_INDEX_COLS)


@register("index_ytd_return_adj_close_base", _INDEX_SQL.format(base="ADJ_CLOSE"), ["index_values"])
def index_ytd_adj_close(spark, base):
    q = Tables(spark, base).index_values.where(F.col("DATE") > F.lit("1970-01-01").cast("date"))
    return P.index_returns_job(write_once(q, "daily"), "ADJ_CLOSE").select(*_INDEX_COLS)


@register(
    "index_daily_return",
    """
SELECT DATE, INDICE, ADJ_CLOSE,
       (ADJ_CLOSE - lag(ADJ_CLOSE) OVER w) / NULLIF(lag(ADJ_CLOSE) OVER w, 0) AS RETURNS
FROM index_values WINDOW w AS (PARTITION BY INDICE ORDER BY DATE)
""",
    ["index_values"],
)
def index_daily_return(spark, base):
    q = write_once(Tables(spark, base).index_values, "daily")
    return T.daily_return(q, "INDICE", "DATE", "ADJ_CLOSE").select("DATE", "INDICE", "ADJ_CLOSE", "RETURNS")


@register(
    "yearly_risk",
    "SELECT YEAR, CODE, round(stddev_samp(PRICE), 6) AS RISK FROM price GROUP BY YEAR, CODE",
    ["price"],
)
def yearly_risk(spark, base):
    return rounded(T.yearly_risk(Tables(spark, base).price), ["RISK"])


@register(
    "yearly_start_end_return",
    "SELECT YEAR, CODE, PRICE_START, PRICE_END, round(RISK, 6) AS RISK, RETURNS FROM yearly_prices",
    ["yearly_prices"],
)
def yearly_start_end_return(spark, base):
    return rounded(P.yearly_prices(Tables(spark, base).price), ["RISK"])


@register(
    "yearly_start_end_return_sparse",
    """
SELECT YEAR, CODE, arg_min(PRICE, DATE) AS PRICE_START, arg_max(PRICE, DATE) AS PRICE_END,
       round(stddev_samp(PRICE), 6) AS RISK,
       (arg_max(PRICE, DATE) - arg_min(PRICE, DATE)) / NULLIF(arg_min(PRICE, DATE), 0) AS RETURNS
FROM price_sparse GROUP BY YEAR, CODE
""",
    ["price_sparse"],
)
def yearly_start_end_return_sparse(spark, base):
    return rounded(P.yearly_prices(Tables(spark, base).price_sparse), ["RISK"])


@register(
    "monthly_ohlc_return",
    """
SELECT CODE, YEAR, MONTH, OPEN, HIGH, LOW, CLOSE, (CLOSE - OPEN) / NULLIF(OPEN, 0) AS RETURNS FROM (
  SELECT CODE, YEAR, CAST(month(DATE) AS INTEGER) AS MONTH, arg_min(PRICE, DATE) AS OPEN, max(PRICE) AS HIGH,
         min(PRICE) AS LOW, arg_max(PRICE, DATE) AS CLOSE
  FROM price GROUP BY CODE, YEAR, month(DATE)) t
""",
    ["price"],
)
def monthly_ohlc_return(spark, base):
    return T.monthly_ohlc(Tables(spark, base).price)


@register(
    "daily_ohlc_events",
    """
SELECT user_id, DAY, OPEN, HIGH, LOW, CLOSE, (CLOSE - OPEN) / NULLIF(OPEN, 0) AS RETURNS FROM (
  SELECT user_id, CAST(ts AS DATE) AS DAY, arg_min(value, ts) AS OPEN, max(value) AS HIGH,
         min(value) AS LOW, arg_max(value, ts) AS CLOSE
  FROM events GROUP BY user_id, CAST(ts AS DATE)) t
""",
)
def daily_ohlc_events(spark, base):
    ev = Tables(spark, base).raw("events").withColumn("DAY", F.to_date("ts"))
    return T.ohlc(ev, ("user_id", "DAY"), "ts", "value")


O.cte(
    "month_bounds",
    """
SELECT k.CODE, k.Y, k.M, s.v_start, e.v_end FROM
  (SELECT DISTINCT CODE, CAST(year(DATE) AS INTEGER) AS Y, CAST(month(DATE) AS INTEGER) AS M FROM price) k
  LEFT JOIN (SELECT CODE, CAST(year(DATE) AS INTEGER) AS Y, CAST(month(DATE) AS INTEGER) AS M, arg_min(PRICE, DATE) AS v_start
             FROM price WHERE day(DATE) BETWEEN 1 AND 29 AND PRICE <> 0 GROUP BY 1, 2, 3) s
    ON k.CODE = s.CODE AND k.Y = s.Y AND k.M = s.M
  LEFT JOIN (SELECT CODE, CAST(year(DATE) AS INTEGER) AS Y, CAST(month(DATE) AS INTEGER) AS M, arg_max(PRICE, DATE) AS v_end
             FROM price WHERE day(DATE) >= 2 AND day(DATE) <= CASE WHEN month(DATE) IN (3, 12) THEN 31 ELSE 30 END
               AND PRICE <> 0 GROUP BY 1, 2, 3) e
    ON k.CODE = e.CODE AND k.Y = e.Y AND k.M = e.M
""",
    ("price",),
)


@register(
    "quarterly_boundary_return",
    """
SELECT CODE, FISCAL_YEAR, PRICE_INI, PRICE_FIN,
       CASE WHEN PRICE_INI = 0 THEN 0.0 ELSE (PRICE_FIN - PRICE_INI) / PRICE_INI END AS RETURNS
FROM (
  SELECT q.CODE, q.FISCAL_YEAR, coalesce(s.v_start, 0.0) AS PRICE_INI, coalesce(e.v_end, 0.0) AS PRICE_FIN
  FROM financials_quarterly q
  LEFT JOIN month_bounds s ON s.CODE = q.CODE AND s.Y = CAST(substr(q.FISCAL_YEAR, 1, 4) AS INTEGER)
       AND s.M + 2 = CAST(substr(q.FISCAL_YEAR, 6, 2) AS INTEGER)
  LEFT JOIN month_bounds e ON e.CODE = q.CODE AND e.Y = CAST(substr(q.FISCAL_YEAR, 1, 4) AS INTEGER)
       AND e.M = CAST(substr(q.FISCAL_YEAR, 6, 2) AS INTEGER)) t
""",
    ["financials_quarterly", "month_bounds"],
)
def quarterly_boundary_return(spark, base):
    t = Tables(spark, base)
    q = t.financials_quarterly.select("CODE", "FISCAL_YEAR")
    return T.quarterly_return(q, t.price)
