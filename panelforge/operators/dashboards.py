"""Dashboard queries.

The BI workbook computed ranks and top-N in the client after the query; here
everything is one DataFrame plan. The unique rank runs over the grouped result
(one row per company), and the ``<= n`` filter lets Spark plan a
``WindowGroupLimit`` so each task ships at most ``n`` rows to the final window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.columns import url_for


def attr(col: str) -> Column:
    """The value if it is unique in the group, else null (the BI tool shows ``*``)."""
    return F.when(F.min(col) == F.max(col), F.min(col))


def in_range_or_null(col: str, low: float, high: float | None = None) -> Column:
    """``low <= col <= high`` (open above when ``high`` is None), nulls kept."""
    c = F.col(col)
    cond = c >= low if high is None else c.between(low, high)
    return cond | c.isNull()


def picks(metrics: DataFrame, companies: DataFrame, year: int, n: int = 20, score: str = "RANKING",
          cap_low: float = 50.0, regions: Sequence[str] | None = None, url_prefix: str = "") -> DataFrame:
    """Entry point C: who would have been picked for ``year`` (data of ``year - 1``).

    companies x metrics on CODE (J3), year parameter (F13), CAP in range or
    null (F11), optional region filter (F15), one mark per CODE with ATTR
    measures (A12), unique rank of the summed score (W6), rank <= n (W7).
    """
    m = metrics.where(F.col("YEAR") == year - 1).where(in_range_or_null("CAP", cap_low))
    j = companies.select("CODE", "COMPANY", "REGION").join(m, "CODE")
    if regions:
        j = j.where(F.col("REGION").isin(list(regions)))
    g = j.groupBy("CODE").agg(
        F.sum(score).alias(f"SUM_{score}"),
        attr("COMPANY").alias("COMPANY"),
        attr("REGION").alias("REGION"),
        attr("CAP").alias("CAP"),
        attr("PRICE_START").alias("PRICE_START"),
        attr("PRICE_END").alias("PRICE_END"),
        attr("RETURNS").alias("RETURNS"),
        F.count(F.lit(1)).alias("NUMBER_OF_RECORDS"),
    )
    w = Window.orderBy(F.col(f"SUM_{score}").asc_nulls_last(), F.col("CODE"))
    top = g.withColumn("RANK_UNIQUE", F.row_number().over(w)).where(F.col("RANK_UNIQUE") <= n)
    return top.withColumn("PRICE_DIFF", F.col("PRICE_END") - F.col("PRICE_START")).withColumn("URL", url_for("CODE", url_prefix))


def cumulative_vs_index(price_returns: DataFrame, selection: DataFrame, index_returns: DataFrame, year: int) -> DataFrame:
    """Second sheet: per day of ``year``, AVG(CUMULATIVE_RETURNS) and AVG(PRICE) of the
    selected companies (F14 action filter = left semi join), beside the index."""
    p = price_returns.where(F.year("DATE") == year).join(selection.select("CODE"), "CODE", "left_semi")
    daily = p.groupBy("DATE").agg(
        F.countDistinct("CODE").alias("N_CODES"),
        F.avg("CUMULATIVE_RETURNS").alias("_avg_cum"),
        F.avg("PRICE").alias("_avg_price"),
    )
    daily = daily.select(
        "DATE", "N_CODES",
        F.when(F.col("N_CODES") >= 1, F.col("_avg_cum")).alias("AVG_CUMULATIVE_RETURNS"),
        F.when((F.col("N_CODES") >= 1) | (F.col("N_CODES") < 25), F.col("_avg_price")).alias("AVG_PRICE"),
    )
    idx = index_returns.where(F.year("DATE") == year).select("DATE", F.col("CUMULATIVE_RETURNS").alias("INDEX_CUMULATIVE_RETURNS"))
    return daily.join(idx, "DATE", "left")


def portfolio_vs_index(picks_by_year: DataFrame, index_next: DataFrame, value: str = "RETURNS_NEXT") -> DataFrame:
    """Per year the average next-year return of the picks vs the index, and the
    growth of one unit compounded over the years (``exp(sum(ln(1 + r)))``).

    The compounding window runs over one row per year (bounded by the calendar).
    """
    y = picks_by_year.groupBy("YEAR").agg(F.avg(value).alias("PORTFOLIO_RETURN"), F.count(F.lit(1)).alias("N_PICKS"))
    y = y.join(index_next, "YEAR", "left")
    w = Window.orderBy("YEAR").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return y.withColumn("PORTFOLIO_GROWTH", F.exp(F.sum(F.log(1 + F.col("PORTFOLIO_RETURN"))).over(w))).withColumn(
        "INDEX_GROWTH", F.exp(F.sum(F.log(1 + F.col("INDEX_RETURNS_NEXT"))).over(w))
    )
