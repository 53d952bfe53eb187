"""Logical tables of the panel model built from the driver's parquet tables.

The mapping is fixed in FIXTURES.md section 2; ``panelforge.plans.oracle``
holds the same definitions as DuckDB SQL. Every table is derived by Spark
from the given tables, so its size grows with them.

* ``price``          company x trading day, one row per (CODE, DATE)
* ``price_sparse``   short, gappy series from ``orders``
* ``index_values``   one index, OHLC per trading day over all companies
* ``index_table``    index master data
* ``financials``     company x fiscal year (or quarter) fundamentals
* ``companies``      company master data
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from panelforge.functions.columns import half_up

# Fixed values of the fixture mapping (FIXTURES.md section 2).
NULL_PRELIMINARY_EVERY = 17
NULL_ROA_EVERY = 11
ZERO_CAP_EVERY = 23
MONEY_DIGITS = 2
RATIO_DIGITS = 4


def _read(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def price(spark: SparkSession, base: str) -> DataFrame:
    """CODE = 'S'||suppkey, DATE = ship date, PRICE = avg unit price of the day (4 digits).

    Grouped on the numeric key; the text code is built after the aggregate,
    on one row per (supplier, day) instead of every line item.
    """
    li = _read(spark, base, "lineitem")
    return (
        li.select(
            F.col("l_suppkey"),
            F.to_date("l_shipdate").alias("DATE"),
            F.try_divide("l_extendedprice", "l_quantity").alias("_unit"),
        )
        .groupBy("l_suppkey", "DATE")
        .agg(half_up(F.avg("_unit"), 4).alias("PRICE"))
        .select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("CODE"), "DATE", "PRICE",
                F.year("DATE").alias("YEAR"))
    )


def price_sparse(spark: SparkSession, base: str) -> DataFrame:
    """CODE = 'C'||custkey, DATE = order date, PRICE = avg order total (4 digits)."""
    o = _read(spark, base, "orders")
    return (
        o.select(F.col("o_custkey"), F.to_date("o_orderdate").alias("DATE"), F.col("o_totalprice"))
        .groupBy("o_custkey", "DATE")
        .agg(half_up(F.avg("o_totalprice"), 4).alias("PRICE"))
        .select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("CODE"), "DATE", "PRICE",
                F.year("DATE").alias("YEAR"))
    )


def index_values(spark: SparkSession, base: str, prices: DataFrame | None = None) -> DataFrame:
    """Per trading day: OPEN = price of the smallest CODE, CLOSE = ADJ_CLOSE = of the largest."""
    p = prices if prices is not None else price(spark, base)
    return (
        p.groupBy("DATE")
        .agg(
            F.min_by("PRICE", "CODE").alias("OPEN"),
            F.max("PRICE").alias("HIGH"),
            F.min("PRICE").alias("LOW"),
            F.max_by("PRICE", "CODE").alias("CLOSE"),
            F.count(F.lit(1)).alias("VOLUME"),
            # INDICE is a data column, as in the stored quotes table; a literal
            # would let the optimizer fold the join to the index master table
            # (ID = INDICE) into a cross product.
            F.min(F.lit(1)).alias("INDICE"),
        )
        .withColumn("ADJ_CLOSE", F.col("CLOSE"))
        .withColumn("YEAR", F.year("DATE"))
    )


def index_table(spark: SparkSession, base: str) -> DataFrame:
    """ID = 1, NAME = REGION = name of the region with the smallest key."""
    r = _read(spark, base, "region")
    # ID is a data column (see index_values: keeps ID = INDICE an equi-join)
    return r.agg(F.min(F.lit(1)).alias("ID"), F.min_by("r_name", "r_regionkey").alias("NAME")).select(
        "ID", "NAME", F.col("NAME").alias("REGION")
    )


def companies(spark: SparkSession, base: str) -> DataFrame:
    s = _read(spark, base, "supplier")
    n = _read(spark, base, "nation")
    r = _read(spark, base, "region")
    return (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("CODE"),
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("SYMBOL"),
            F.col("s_name").alias("COMPANY"),
            F.col("r_name").alias("REGION"),
            F.col("n_name").alias("INDUSTRY01"),
            F.col("r_name").alias("INDUSTRY02"),
        )
    )


def _r(c: Column, digits: int = RATIO_DIGITS) -> Column:
    return half_up(c, digits)


def financials(spark: SparkSession, base: str, period: str = "year") -> DataFrame:
    """Fundamentals per (supplier, fiscal period) in the short-name layout.

    ``period='year'``: FISCAL_YEAR = 'yyyy-12'; ``period='quarter'``: 'yyyy-MM'
    with MM the quarter's last month (03, 06, 09, 12).
    """
    li = _read(spark, base, "lineitem")
    pa = _read(spark, base, "part")
    su = _read(spark, base, "supplier")
    year = F.year("l_shipdate")
    if period == "year":
        month = F.lit(12)
    elif period == "quarter":
        month = F.quarter("l_shipdate") * 3
    else:
        raise ValueError(f"unknown period {period!r}")
    base_rows = li.join(pa, li.l_partkey == pa.p_partkey).select(
        F.col("l_suppkey").alias("SUPP"),
        year.alias("FY"),
        month.alias("FM"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("cogs"),
        F.col("l_extendedprice").alias("gross"),
        (F.col("l_tax") * F.col("l_extendedprice")).alias("tax"),
        (F.col("l_discount") * F.col("l_extendedprice")).alias("disc"),
        F.col("l_quantity").alias("qty"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("ret"),
    )
    g = base_rows.groupBy("SUPP", "FY", "FM").agg(
        F.sum("rev").alias("rev"),
        F.sum("cogs").alias("cogs"),
        F.sum("gross").alias("gross"),
        F.sum("tax").alias("tax"),
        F.avg("tax").alias("avg_tax"),
        F.sum("disc").alias("disc"),
        F.sum("qty").alias("qty"),
        F.count(F.lit(1)).alias("n"),
        F.sum("ret").alias("nret"),
    )
    g = g.join(su.select(F.col("s_suppkey").alias("SUPP"), F.col("s_acctbal").alias("bal")), "SUPP")
    rev, cogs, gross, tax = F.col("rev"), F.col("cogs"), F.col("gross"), F.col("tax")
    disc, qty, n, nret, bal = F.col("disc"), F.col("qty"), F.col("n"), F.col("nret"), F.col("bal")
    net = rev - cogs - tax
    last_period = F.max(F.col("FY") * 100 + F.col("FM")).over(Window.partitionBy("SUPP"))
    supp = F.col("SUPP")
    return g.select(
        F.concat(F.lit("S"), supp.cast("string")).alias("CODE"),
        F.concat(F.col("FY").cast("string"), F.lit("-"), F.lpad(F.col("FM").cast("string"), 2, "0")).alias("FISCAL_YEAR"),
        F.when(supp % NULL_PRELIMINARY_EVERY == 0, F.lit(None).cast("int"))
        .when(F.col("FY") * 100 + F.col("FM") == last_period, F.lit(1))
        .otherwise(F.lit(0))
        .alias("PRELIMINARY"),
        _r(F.try_divide(net, F.abs(bal) + 1000)).alias("CSR__ROE"),
        _r(F.try_divide(bal, F.col("avg_tax"))).alias("VR__EV_TO_EBIT"),
        _r(F.try_divide(rev - 2 * cogs, cogs)).alias("CSR__ROC_JOEL_GREENBLATT"),
        _r(F.try_divide(rev - cogs, rev)).alias("CSR__OPERATING_MARGIN"),
        (n % 10).cast("int").alias("VQ__PIOTROSKI_F_SCORE"),
        _r(F.try_divide(gross, n * 1000)).alias("VR__PS_RATIO"),
        _r(F.try_divide(rev, F.abs(bal) + 1000)).alias("VR__PB_RATIO"),
        _r(F.try_divide(disc, tax)).alias("VQ__ALTMAN_Z_SCORE"),
        F.when(supp % NULL_ROA_EVERY == 0, F.lit(None).cast("double"))
        .otherwise(_r(F.try_divide(net, gross)))
        .alias("CSR__ROA"),
        _r(F.try_divide(net, n)).alias("PSDA__EARNINGS_PER_SHARE_DILUTED"),
        _r(F.try_divide(rev - cogs, cogs + F.abs(bal))).alias("CSR__ROIC"),
        _r(F.try_divide(gross - cogs, gross)).alias("CSR__GROSS_MARGIN"),
        _r(F.try_divide(qty, n)).alias("VQ__YOY_EPS_GROWTH"),
        _r(F.try_divide(nret, n)).alias("VQ__YOY_EBITDA_GROWTH"),
        _r(F.try_divide(rev - cogs, n)).alias("PSDA__EBITDA_PER_SHARE"),
        _r(F.try_divide(tax, n)).alias("PSDA__TOTAL_DEBT_PER_SHARE"),
        _r(F.try_divide(net, rev)).alias("CSR__NET_MARGIN"),
        _r(rev, MONEY_DIGITS).alias("IS__REVENUE"),
        _r(net, MONEY_DIGITS).alias("IS__NET_INCOME"),
        _r(cogs, MONEY_DIGITS).alias("IS__COST_OF_GOODS_SOLD"),
        _r(F.abs(bal) * 10 + rev / 10, MONEY_DIGITS).alias("BS__TOTAL_EQUITY"),
        _r(rev - cogs, MONEY_DIGITS).alias("IS__EBITDA"),
        _r(gross, MONEY_DIGITS).alias("BS__TOTAL_ASSETS"),
        _r(disc, MONEY_DIGITS).alias("BS__LONG_TERM_DEBT"),
        _r(tax, MONEY_DIGITS).alias("BS__TOTAL_CURRENT_LIABILITIES"),
        F.when(supp % ZERO_CAP_EVERY == 0, F.lit(0.0)).otherwise(_r(rev / 1000)).alias("VQ_MARKET_CAP"),
        _r(F.try_divide(net, qty)).alias("IS_EPS_BASIC"),
        _r(F.try_divide(gross, qty)).alias("VR_PE_RATIO"),
    )
