"""Multi-step jobs composed of the operators.

* ``yearly_dataset``      fundamentals + yearly price metrics + ranks + label + industry
* ``greenblatt_metrics``  positive-ratio universe with the two magic-formula ranks
* ``greenblatt_top_n``    sum of both ranks, best N per year, with company data
* ``price_returns_job``   daily and year-to-date returns of every company
* ``index_returns_job``   the same for index quotes (ADJ_CLOSE on the first OPEN)
* ``labelled_panel``      yearly panel with next-period and versus-index labels
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.columns import year_of_fiscal
from panelforge.operators import labels as L
from panelforge.operators import ranks as R
from panelforge.operators import returns as T

# The 25 fundamental ratios of the yearly dataset, in output order.
RATIO_COLUMNS = [
    "CSR__ROE",
    "VR__EV_TO_EBIT",
    "CSR__ROC_JOEL_GREENBLATT",
    "CSR__OPERATING_MARGIN",
    "VQ__PIOTROSKI_F_SCORE",
    "VR__PS_RATIO",
    "VR__PB_RATIO",
    "VQ__ALTMAN_Z_SCORE",
    "CSR__ROA",
    "PSDA__EARNINGS_PER_SHARE_DILUTED",
    "CSR__ROIC",
    "CSR__GROSS_MARGIN",
    "VQ__YOY_EPS_GROWTH",
    "VQ__YOY_EBITDA_GROWTH",
    "PSDA__EBITDA_PER_SHARE",
    "PSDA__TOTAL_DEBT_PER_SHARE",
    "CSR__NET_MARGIN",
    "IS__REVENUE",
    "IS__NET_INCOME",
    "IS__COST_OF_GOODS_SOLD",
    "BS__TOTAL_EQUITY",
    "IS__EBITDA",
    "BS__TOTAL_ASSETS",
    "BS__LONG_TERM_DEBT",
    "BS__TOTAL_CURRENT_LIABILITIES",
]

# The 12 ratios ranked ascending within each year.
RANKED_COLUMNS = [
    "PSDA__EARNINGS_PER_SHARE_DILUTED",
    "PSDA__EBITDA_PER_SHARE",
    "PSDA__TOTAL_DEBT_PER_SHARE",
    "CSR__NET_MARGIN",
    "IS__REVENUE",
    "IS__NET_INCOME",
    "IS__COST_OF_GOODS_SOLD",
    "BS__TOTAL_EQUITY",
    "IS__EBITDA",
    "BS__TOTAL_ASSETS",
    "BS__LONG_TERM_DEBT",
    "BS__TOTAL_CURRENT_LIABILITIES",
]

# Short output names of the magic-formula metrics table.
GREENBLATT_COLUMNS = {
    "CSR__ROC_JOEL_GREENBLATT": "ROC",
    "VR__EV_TO_EBIT": "EV_TO_EBIT",
    "VQ_MARKET_CAP": "CAP",
    "IS_EPS_BASIC": "EPS",
    "IS__REVENUE": "REVENUE",
    "VR_PE_RATIO": "PER",
    "VQ__PIOTROSKI_F_SCORE": "PIOTROSKI",
}


def fundamentals(financials: DataFrame, include_preliminary: bool = True, columns: list[str] | None = None) -> DataFrame:
    """(CODE, YEAR, ratios...) from fiscal-period fundamentals.

    ``include_preliminary=False`` keeps ``PRELIMINARY <> 1``, which also drops
    rows whose flag is null (three-valued logic, as the batch jobs do). The
    filter runs before the projection so that it reaches the scan.
    """
    f = financials if include_preliminary else financials.where(F.col("PRELIMINARY") != 1)
    cols = columns if columns is not None else RATIO_COLUMNS
    return f.select("CODE", year_of_fiscal("FISCAL_YEAR").alias("YEAR"), *cols)


def yearly_prices(prices: DataFrame) -> DataFrame:
    """(YEAR, CODE, PRICE_START, PRICE_END, RISK, RETURNS): one aggregate over the price table."""
    return T.period_summary(prices, ("YEAR", "CODE"), "DATE", "PRICE")


def yearly_dataset(financials: DataFrame, prices: DataFrame, companies: DataFrame | None = None,
                   include_preliminary: bool = True, with_ranks: bool = True, with_target: bool = True) -> DataFrame:
    """The yearly company dataset.

    The label (next row's return of the company) is computed before the ranks,
    so that all 13 ranks are one pass.
    """
    total = fundamentals(financials, include_preliminary).join(yearly_prices(prices), ["YEAR", "CODE"])
    if with_target:
        total = L.lead_value(total, "RETURNS", "CODE", "YEAR", "TARGET")
    if with_ranks:
        total = R.row_rank(total, [*RANKED_COLUMNS, *["TARGET"] * with_target])
    if companies is not None:
        total = total.join(companies.select("CODE", "INDUSTRY01", "INDUSTRY02"), "CODE")
    return total


def greenblatt_metrics(financials: DataFrame, prices: DataFrame) -> DataFrame:
    """Positive ROC and EV/EBIT universe with yearly price metrics and the two ranks:
    ROC descending, EV/EBIT ascending (cheap is good), ties by CODE."""
    f = fundamentals(financials, True, list(GREENBLATT_COLUMNS)).withColumnsRenamed(GREENBLATT_COLUMNS)
    f = f.where((F.col("ROC") > 0) & (F.col("EV_TO_EBIT") > 0))
    total = f.join(yearly_prices(prices), ["YEAR", "CODE"])
    return R.row_rank(total, ["ROC", "EV_TO_EBIT"], ascending=[False, True], names=["ROC_RANKING", "EBIT_RANKING"])


def greenblatt_top_n(financials: DataFrame, prices: DataFrame, companies: DataFrame, n: int = 20) -> DataFrame:
    """Best ``n`` companies per year by the sum of both ranks (ties by CODE), with company data."""
    m = greenblatt_metrics(financials, prices).withColumn("SCORE", F.col("ROC_RANKING") + F.col("EBIT_RANKING"))
    top = R.top_n(m, [F.col("SCORE").asc(), F.col("CODE").asc()], n, rank_name="RANKING")
    return top.join(companies.select("CODE", "COMPANY", "REGION", "INDUSTRY01"), "CODE")


def price_returns_job(prices: DataFrame) -> DataFrame:
    """(CODE, DATE, YEAR, PRICE, PRICE_START, RETURNS, CUMULATIVE_RETURNS)."""
    return T.price_returns(prices, "CODE", "DATE", "PRICE", "YEAR")


def index_returns_job(quotes: DataFrame, base: str = "OPEN") -> DataFrame:
    """Index quotes with daily ADJ_CLOSE returns and YTD returns on the year's first ``base``.

    The reference job ordered an unpartitioned window (one task for the whole
    history); here the window is per (INDICE, YEAR).
    """
    return T.price_returns(quotes, "INDICE", "DATE", "ADJ_CLOSE", "YEAR", ytd_base=base)


def one_index(quotes: DataFrame, index: str | None = None) -> DataFrame:
    """The quotes of one index: the named one, or the only one (several without a name are an error)."""
    if index is not None:
        return quotes.where(F.col("INDICE") == index)
    several = F.raise_error(F.lit("several indices: name one"))
    only = quotes.select(F.when(F.min("INDICE") == F.max("INDICE"), F.min("INDICE")).otherwise(several.cast(quotes.schema["INDICE"].dataType))).scalar()
    return quotes.where(F.col("INDICE") == only)


def index_yearly_returns(quotes: DataFrame) -> DataFrame:
    """(INDICE, YEAR, INDEX_RETURNS): last CLOSE of the year on the first OPEN of the year, per index."""
    y = quotes.groupBy("INDICE", "YEAR").agg(F.min_by("OPEN", "DATE").alias("_o"), F.max_by("CLOSE", "DATE").alias("_c"))
    return y.select("INDICE", "YEAR", F.try_divide(F.col("_c") - F.col("_o"), F.col("_o")).alias("INDEX_RETURNS"))


def labelled_panel(financials: DataFrame, prices: DataFrame, quotes: DataFrame, companies: DataFrame | None = None,
                   include_preliminary: bool = True, index: str | None = None) -> DataFrame:
    """Yearly panel + next-period and versus-index labels (the modelling input), against one index."""
    base = fundamentals(financials, include_preliminary, RATIO_COLUMNS + ["VQ_MARKET_CAP", "IS_EPS_BASIC", "VR_PE_RATIO"])
    panel = base.join(yearly_prices(prices), ["YEAR", "CODE"])
    panel = L.next_period_labels(panel, index_yearly_returns(one_index(quotes, index)))
    if companies is not None:
        panel = panel.join(companies.select("CODE", "INDUSTRY01", "INDUSTRY02"), "CODE")
    return panel
