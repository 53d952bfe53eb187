"""Queries: sources and sinks round trip."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.plans import pipelines as P
from panelforge.plans.catalog import Tables, register, rounded
from panelforge.session import shared_scratch
from panelforge.sources import readers as RD
from panelforge.sources import writers as WR


@register(
    "csv_roundtrip_yearly",
    """
SELECT y.YEAR, y.CODE, y.PRICE_START, y.PRICE_END, round(y.RISK, 6) AS RISK, y.RETURNS, c.INDUSTRY01
FROM yearly_prices y JOIN companies c USING (CODE)
""",
    ["yearly_prices", "companies"],
)
def csv_roundtrip_yearly(spark, base):
    """Write the price table as the raw export (MM-dd-yyyy text, partitioned by YEAR)
    and the companies as a pipe-separated file, read both back with declared
    schemas, and build the yearly price metrics with the industry."""
    t = Tables(spark, base)
    price_dir, comp_dir = shared_scratch(spark, "price_csv"), shared_scratch(spark, "companies_csv")
    raw = t.price.select("CODE", F.date_format("DATE", "MM-dd-yyyy").alias("DATE"), "PRICE", "YEAR")
    WR.write_partitioned(raw, price_dir, ("YEAR",), fmt="csv")
    t.companies.write.mode("overwrite").option("header", "true").option("sep", "|").csv(comp_dir)
    prices = RD.normalize_price(RD.read_csv(spark, price_dir, RD.PRICE_SCHEMA))
    comps = RD.read_companies(spark, comp_dir)
    y = P.yearly_prices(prices).join(comps.select("CODE", "INDUSTRY01"), "CODE")
    return rounded(y, ["RISK"])


@register(
    "index_csv_roundtrip",
    """
SELECT DATE, OPEN, HIGH, LOW, CLOSE, ADJ_CLOSE, VOLUME, YEAR, INDICE FROM index_values WHERE DATE > DATE '1970-01-01'
""",
    ["index_values"],
)
def index_csv_roundtrip(spark, base):
    """Index quotes written as the vendor export (ISO dates, 'Adj Close' header) in one
    sorted file, read back and normalised (rename, YEAR, INDICE, date floor)."""
    t = Tables(spark, base)
    folder = shared_scratch(spark, "index_csv")
    raw = t.index_values.select(
        F.date_format("DATE", "yyyy-MM-dd").alias("Date"), F.col("OPEN").alias("Open"), F.col("HIGH").alias("High"),
        F.col("LOW").alias("Low"), F.col("CLOSE").alias("Close"), F.col("ADJ_CLOSE").alias("Adj Close"),
        F.col("VOLUME").alias("Volume"),
    )
    WR.write_sorted_csv(raw, folder, ("Date",), single_file=True)  # one row per trading day: a small report
    return RD.normalize_index_quotes(RD.read_csv(spark, folder, RD.INDEX_QUOTES_SCHEMA)).select(
        "DATE", "OPEN", "HIGH", "LOW", "CLOSE", "ADJ_CLOSE", "VOLUME", "YEAR", "INDICE")


@register("financials_from_long_names", "SELECT * FROM fund", ["fund"])
def financials_from_long_names(spark, base):
    """Fundamentals delivered with the vendor's long column names (positional header),
    renamed to the short layout and turned into (CODE, YEAR, ratios)."""
    f = Tables(spark, base).financials
    vendor = RD.rename_positional(f, [RD.long_name(c) for c in f.columns])
    short = RD.shorten_columns(vendor)
    return P.fundamentals(short, True, P.RATIO_COLUMNS + ["VQ_MARKET_CAP", "IS_EPS_BASIC", "VR_PE_RATIO"])
