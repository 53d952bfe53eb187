"""Queries: rolling sums, first/last rows, zero-price inspection, unpivot of measures,
preview, computed sort, per-entity files, their resumed build, bucketed tables, fiscal period dates,
numeric describe (W12, W13, W15, F16, A20, J1, L2, L3, S4, S5, S6, S8, P7, P8, P19)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from panelforge.functions.columns import make_month_date, split_year_month
from panelforge.operators import quality as Q
from panelforge.operators import ranks as R
from panelforge.operators import returns as T
from panelforge.plans import pipelines as P
from panelforge.plans.catalog import Tables, register, rounded
from panelforge.plans.catalog_dashboards import _picks
from panelforge.session import shared_scratch, write_once
from panelforge.sources import readers as RD
from panelforge.sources import writers as WR


def _rolling_sql(n: int) -> str:
    return (f"SELECT CODE, DATE, YEAR, PRICE, round(sum(PRICE) OVER (PARTITION BY CODE ORDER BY DATE "
            f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 6) AS PRICE_SUM{n} FROM price")


@register("rolling_sum_2", _rolling_sql(2), ["price"])
def rolling_sum_2(spark, base):
    return rounded(T.rolling_sum(Tables(spark, base).price, 2), ["PRICE_SUM2"])


@register("rolling_sum_5_sparse", _rolling_sql(5).replace("FROM price", "FROM price_sparse"), ["price_sparse"])
def rolling_sum_5_sparse(spark, base):
    """Five-row trailing sum on the gappy series: windows reach back over several years."""
    return rounded(T.rolling_sum(Tables(spark, base).price_sparse, 5), ["PRICE_SUM5"])


@register(
    "first_price_of_year",
    "SELECT CODE, YEAR, arg_min(PRICE, DATE) AS PRICE, min(DATE) AS DATE FROM price GROUP BY CODE, YEAR",
    ["price"],
)
def first_price_of_year(spark, base):
    return R.first_row(Tables(spark, base).price, ("CODE", "YEAR"), "DATE", ["PRICE"])


@register(
    "last_row_per_entity",
    "SELECT CODE, arg_max_null(RETURNS, YEAR) AS RETURNS, round(arg_max_null(RISK, YEAR), 6) AS RISK, max(YEAR) AS YEAR "
    "FROM sparse_yearly GROUP BY CODE",
    ["sparse_yearly"],
)
def last_row_per_entity(spark, base):
    y = P.yearly_prices(Tables(spark, base).price_sparse)
    return rounded(R.last_row(y, ("CODE",), "YEAR", ["RETURNS", "RISK"]), ["RISK"])


@register(
    "zero_end_price_quarters",
    "SELECT CODE, FISCAL_YEAR, PRICE_INI, PRICE_FIN FROM quarterly_returns WHERE PRICE_FIN = 0",
    ["quarterly_returns"],
)
def zero_end_price_quarters(spark, base):
    t = Tables(spark, base)
    q = T.quarterly_return(t.financials_quarterly.select("CODE", "FISCAL_YEAR"), t.price)
    return q.where(F.col("PRICE_FIN") == 0).select("CODE", "FISCAL_YEAR", "PRICE_INI", "PRICE_FIN")


# Measures of the picks text table, in display order.
MEASURES = ["CAP", "PRICE_START", "PRICE_END", "PRICE_DIFF", "RETURNS"]


@register(
    "unpivot_measures",
    "SELECT CODE, MEASURE, VALUE, CAST(CASE MEASURE " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(MEASURES, 1))
    + " END AS INTEGER) AS MEASURE_ORDER FROM (SELECT CODE, " + ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in MEASURES)
    + " FROM dash_picks) s UNPIVOT INCLUDE NULLS (VALUE FOR MEASURE IN (" + ", ".join(MEASURES) + "))",
    ["dash_picks"],
)
def unpivot_measures(spark, base):
    p = _picks(spark, base).select("CODE", *[F.col(m).cast("double").alias(m) for m in MEASURES])
    long = p.unpivot(["CODE"], MEASURES, "MEASURE", "VALUE")
    order = F.create_map(*[x for i, m in enumerate(MEASURES, 1) for x in (F.lit(m), F.lit(i))])
    return long.withColumn("MEASURE_ORDER", order[F.col("MEASURE")].cast("int"))


@register("price_preview", "SELECT * FROM price ORDER BY CODE, DATE LIMIT 20", ["price"])
def price_preview(spark, base):
    """L2: the first rows by a total order (a preview: the limit is the feature)."""
    return Tables(spark, base).price.orderBy("CODE", "DATE").limit(20)


@register(
    "industry_by_return",
    """
SELECT c.INDUSTRY01, round(avg(y.RETURNS), 9) AS AVG_RETURNS, count(*) AS N
FROM yearly_prices y JOIN companies c USING (CODE) GROUP BY c.INDUSTRY01 ORDER BY AVG_RETURNS DESC
""",
    ["yearly_prices", "companies"],
)
def industry_by_return(spark, base):
    """L3: a dimension ordered by an aggregate."""
    t = Tables(spark, base)
    g = P.yearly_prices(t.price).join(t.companies.select("CODE", "INDUSTRY01"), "CODE").groupBy("INDUSTRY01").agg(
        F.round(F.avg("RETURNS"), 9).alias("AVG_RETURNS"), F.count(F.lit(1)).alias("N"))
    return g.orderBy(F.col("AVG_RETURNS").desc())


QUARTER_FILE_SCHEMA = TY.StructType([
    TY.StructField("Unnamed: 0", TY.LongType()),
    TY.StructField("FISCAL_YEAR", TY.StringType()),
    TY.StructField("PRICE_INI", TY.DoubleType()),
    TY.StructField("PRICE_FIN", TY.DoubleType()),
    TY.StructField("RETURNS", TY.DoubleType()),
])


@register("per_entity_files", "SELECT CODE AS Ticker, FISCAL_YEAR, PRICE_INI, PRICE_FIN, RETURNS FROM quarterly_returns",
          ["quarterly_returns"])
def per_entity_files(spark, base):
    """S8 -> S4 -> S5: one ';'-separated folder per ticker with a leading row-number
    column, stacked back with one distributed read of them all, index column dropped."""
    t = Tables(spark, base)
    q = T.quarterly_return(t.financials_quarterly.select("CODE", "FISCAL_YEAR"), t.price)
    q = q.withColumn("Unnamed: 0", F.row_number().over(Window.partitionBy("CODE").orderBy("FISCAL_YEAR")) - 1)
    folder = shared_scratch(spark, "per_ticker")
    WR.write_entity_files(q.select("Unnamed: 0", "FISCAL_YEAR", "PRICE_INI", "PRICE_FIN", "RETURNS", F.col("CODE").alias("Ticker")),
                          folder, "Ticker", "csv", header="true", sep=";")
    back = RD.read_many(spark, folder, TY.StructType([*QUARTER_FILE_SCHEMA, TY.StructField("Ticker", TY.StringType())]), sep=";")
    return RD.drop_index_column(back).select("Ticker", "FISCAL_YEAR", "PRICE_INI", "PRICE_FIN", "RETURNS")


@register("per_entity_resumed", "SELECT CODE AS Ticker, FISCAL_YEAR, PRICE_INI, PRICE_FIN, RETURNS FROM quarterly_returns",
          ["quarterly_returns"])
def per_entity_resumed(spark, base):
    """S8 in two runs: the first ends after three of eight batches of tickers, the second writes only the rest."""
    t = Tables(spark, base)
    q = T.quarterly_return(t.financials_quarterly.select("CODE", "FISCAL_YEAR"), t.price)
    q = write_once(q.select(F.col("CODE").alias("Ticker"), "FISCAL_YEAR", "PRICE_INI", "PRICE_FIN", "RETURNS"), "quarterly")
    folder = shared_scratch(spark, "per_ticker")
    WR.write_entities(q, folder, "Ticker", batches=8, most=3)
    WR.write_entities(q, folder, "Ticker", batches=8)
    return spark.read.schema(q.schema).parquet(folder).select(*q.columns)


@register(
    "bucketed_yearly_join",
    """
SELECT f.YEAR, f.CODE, f.CSR__ROE, y.PRICE_START, y.PRICE_END, y.RETURNS
FROM fund f JOIN yearly_prices y ON f.YEAR = y.YEAR AND f.CODE = y.CODE
""",
    ["fund", "yearly_prices"],
)
def bucketed_yearly_join(spark, base):
    """Fundamentals and yearly prices stored in buckets of (YEAR, CODE), joined where they lie."""
    t = Tables(spark, base)
    fund = P.fundamentals(t.financials, True, ["CSR__ROE"])
    stored = []
    for name, table in (("fund", fund), ("prices", P.yearly_prices(t.price).select("YEAR", "CODE", "PRICE_START", "PRICE_END", "RETURNS"))):
        path = shared_scratch(spark, f"bucketed-{name}")
        stored.append(WR.write_bucketed(table, f"panelforge_{name}_{path.split('-')[-1].split('/')[0]}", path, buckets=16))
    return stored[0].join(stored[1].hint("merge"), ["YEAR", "CODE"]).select("YEAR", "CODE", "CSR__ROE", "PRICE_START", "PRICE_END", "RETURNS")


@register(
    "fiscal_period_dates",
    """
SELECT CODE, FISCAL_YEAR, CAST(split_part(FISCAL_YEAR, '-', 1) AS INTEGER) AS Year,
       CAST(split_part(FISCAL_YEAR, '-', 2) AS INTEGER) AS Month,
       make_date(CAST(split_part(FISCAL_YEAR, '-', 1) AS INTEGER), CAST(split_part(FISCAL_YEAR, '-', 2) AS INTEGER), 1) AS PERIOD_DATE
FROM financials_quarterly
""",
    ["financials_quarterly"],
)
def fiscal_period_dates(spark, base):
    fq = Tables(spark, base).financials_quarterly.select("CODE", "FISCAL_YEAR")
    y, m = split_year_month("FISCAL_YEAR")
    return fq.withColumn("Year", y).withColumn("Month", m).withColumn("PERIOD_DATE", make_month_date("Year", "Month"))


FIN_NUMERIC = ["PRELIMINARY"] + P.RATIO_COLUMNS + ["VQ_MARKET_CAP", "IS_EPS_BASIC", "VR_PE_RATIO"]


@register(
    "describe_financials",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS METRIC, count({c}) AS COUNT, round(avg({c}), 6) AS MEAN, round(stddev_samp({c}), 6) AS STD, "
        f"CAST(min({c}) AS DOUBLE) AS MIN, round(quantile_cont({c}, 0.25), 6) AS P25, round(quantile_cont({c}, 0.5), 6) AS P50, "
        f"round(quantile_cont({c}, 0.75), 6) AS P75, CAST(max({c}) AS DOUBLE) AS MAX FROM financials"
        for c in FIN_NUMERIC
    ),
    ["financials"],
)
def describe_financials(spark, base):
    """A6 over every numeric column of the fundamentals, selected by type."""
    f = Tables(spark, base).financials
    d = Q.describe(f, Q.numeric_columns(f))
    return rounded(d, ["MEAN", "STD", "P25", "P50", "P75"], 6)


@register(
    "monthly_interpolated_fundamentals",
    """
SELECT CODE, YEAR, MONTH, CLOSE, REVENUE FROM (
  SELECT CODE, YEAR, MONTH, CLOSE,
         coalesce(IS__REVENUE, v0 + (v1 - v0) * (p - p0) / NULLIF(p1 - p0, 0), v0) AS REVENUE FROM (
    SELECT *,
      last_value(IS__REVENUE IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN IS__REVENUE IS NOT NULL THEN p END IGNORE NULLS) OVER b AS p0,
      first_value(IS__REVENUE IGNORE NULLS) OVER f AS v1, first_value(CASE WHEN IS__REVENUE IS NOT NULL THEN p END IGNORE NULLS) OVER f AS p1
    FROM (SELECT *, row_number() OVER (PARTITION BY CODE ORDER BY YEAR * 12 + MONTH) AS p FROM (
            SELECT m.CODE, m.YEAR, m.MONTH, m.CLOSE, q.IS__REVENUE
            FROM (SELECT CODE, YEAR, CAST(month(DATE) AS INTEGER) AS MONTH, arg_max(PRICE, DATE) AS CLOSE
                  FROM price GROUP BY CODE, YEAR, month(DATE)) m
            LEFT JOIN (SELECT CODE, CAST(substr(FISCAL_YEAR, 1, 4) AS INTEGER) AS YEAR,
                              CAST(substr(FISCAL_YEAR, 6, 2) AS INTEGER) AS MONTH, IS__REVENUE FROM financials_quarterly) q
              ON m.CODE = q.CODE AND m.YEAR = q.YEAR AND m.MONTH = q.MONTH) j) x
    WINDOW b AS (PARTITION BY CODE ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           f AS (PARTITION BY CODE ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) y) z
WHERE REVENUE IS NOT NULL
""",
    ["price", "financials_quarterly"],
)
def monthly_interpolated_fundamentals(spark, base):
    """Monthly closes left-joined with quarterly fundamentals (J5), the quarterly
    revenue interpolated linearly over the months of each company (W14); months
    before the first report are dropped."""
    from panelforge.operators import series as S
    from panelforge.operators import sets as SE

    t = Tables(spark, base)
    monthly = T.monthly_ohlc(t.price).select("CODE", "YEAR", "MONTH", "CLOSE")
    q = t.financials_quarterly.select(
        "CODE", F.substring("FISCAL_YEAR", 1, 4).cast("int").alias("YEAR"),
        F.substring("FISCAL_YEAR", 6, 2).cast("int").alias("MONTH"), "IS__REVENUE")
    j = SE.left_join_suffixed(monthly, q, ["CODE", "YEAR", "MONTH"]).withColumn("_M", F.col("YEAR") * 12 + F.col("MONTH"))
    out = S.linear_interpolation(j, ["IS__REVENUE"], "CODE", "_M")
    return out.select("CODE", "YEAR", "MONTH", "CLOSE", F.col("IS__REVENUE").alias("REVENUE"))


@register("var1_forecast_monthly")
def var1_forecast_monthly(spark, base):
    """VAR(1) per company on the monthly close and interpolated revenue; the last month
    is held out (rows-only: least squares per group)."""
    from panelforge.operators import series as S

    m = monthly_interpolated_fundamentals(spark, base).withColumn("_M", F.col("YEAR") * 12 + F.col("MONTH"))
    return S.var_forecast(m, ["CLOSE", "REVENUE"], "CODE", "_M", lags=1, holdout=1)


@register(
    "orders_by_iso_year",
    "SELECT n_name AS NATION, CAST(substr(CAST(o_orderdate AS VARCHAR), 1, 4) AS INTEGER) AS YEAR, count(*) AS ORDERS"
    " FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2",
)
def orders_by_iso_year(spark, base):
    """Tables by name, joined; the year from the ISO text of a date."""
    from panelforge.functions.columns import year_of_iso_text
    from panelforge.sources.readers import read_tables

    t = read_tables(spark, base, ["orders", "customer", "nation"])
    j = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy(F.col("n_name").alias("NATION"), year_of_iso_text("o_orderdate").alias("YEAR")).agg(F.count("*").alias("ORDERS"))
