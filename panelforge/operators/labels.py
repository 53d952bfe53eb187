"""Label operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.columns import case_label, compound_label
from panelforge.session import write_once

# The two-valued categories of the labels.
POSITIVE, NEGATIVE = "POSITIVE", "NEGATIVE"
WINS, LOSES = "WINS", "LOSES"


def lead_value(df: DataFrame, value: str = "RETURNS", key: str = "CODE", order: str = "YEAR", out: str = "TARGET",
               offset: int = 1, strict: bool = False) -> DataFrame:
    """The next row's value of the same entity (gaps bridged).

    ``strict=True`` returns null when the next row is not the next period.
    The partition is one entity's yearly series: bounded by the number of years.
    """
    w = Window.partitionBy(key).orderBy(order)
    nxt = F.lead(value, offset).over(w)
    if strict:
        nxt = F.when(F.lead(order, offset).over(w) == F.col(order) + offset, nxt)
    return df.withColumn(out, nxt)


def lag_value(df: DataFrame, value: str, key: str = "CODE", order: str = "YEAR", out: str | None = None,
              offset: int = 1) -> DataFrame:
    """The previous row's value beside the value; first row null."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn(out or f"{value}_LAG{offset}", F.lag(value, offset).over(w))


def next_period_labels(panel: DataFrame, index_returns: DataFrame, key: str = "CODE", order: str = "YEAR") -> DataFrame:
    """RETURNS_NEXT, INDEX_RETURNS_NEXT and the four category labels.

    ``index_returns`` has the returns of one index: one row per period (``order``,
    INDEX_RETURNS). A table with several rows per period would multiply the
    panel's rows, so periods that occur more than once raise an error.
    """
    twice = F.raise_error(F.lit("several index returns in one period"))
    of_period = index_returns.groupBy(order).agg(F.when(F.count("*") == 1, F.max("INDEX_RETURNS")).otherwise(twice.cast("double")).alias("INDEX_RETURNS"))
    j = panel.join(of_period, order, "left")
    w = Window.partitionBy(key).orderBy(order)
    r, i = F.col("RETURNS"), F.col("INDEX_RETURNS")
    rn, inx = F.col("RETURNS_NEXT"), F.col("INDEX_RETURNS_NEXT")
    return (
        j.withColumn("RETURNS_NEXT", F.lead("RETURNS").over(w))
        .withColumn("INDEX_RETURNS_NEXT", F.lead("INDEX_RETURNS").over(w))
        .withColumn("RETURNS_CAT", case_label(r > 0, POSITIVE, NEGATIVE))
        .withColumn("RETURNS_NEXT_CAT", case_label(rn > 0, POSITIVE, NEGATIVE))
        .withColumn("RETURNS_vs_INDEX", case_label(r > i, WINS, LOSES))
        .withColumn("RETURNS_vs_INDEX_NEXT", case_label(rn > inx, WINS, LOSES))
    )


def compound_wins(df: DataFrame, out: str = "RETURNS_vs_INDEX_NEXT") -> DataFrame:
    """WINS only if the next return is positive and beats the index."""
    return df.withColumn(out, compound_label("RETURNS_NEXT", "INDEX_RETURNS_NEXT"))


def encode_label(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Sorted distinct text values -> 0..k-1 (LOSES=0, WINS=1; NEGATIVE=0, POSITIVE=1).

    The input is written once. The code table is built from the distinct values
    (a categorical: a handful of rows) and joined back.
    """
    df = write_once(df, "encode")
    codes = df.select(col).where(F.col(col).isNotNull()).distinct()
    codes = codes.withColumn(out or f"{col}_CODE", F.dense_rank().over(Window.orderBy(col)) - 1)
    return df.join(codes, col, "left")


def map_categories(df: DataFrame, mapping: DataFrame, col: str, out: str, source: str = "FROM", target: str = "TO") -> DataFrame:
    """Map values through a mapping table; unlisted values pass through unchanged.

    ``mapping`` has one row per source value; Spark broadcasts it as far as its
    size allows.
    """
    m = mapping.select(F.col(source).alias("_from"), F.col(target).alias("_to"))
    return (
        df.join(m, F.col(col) == F.col("_from"), "left")
        .withColumn(out, F.coalesce(F.col("_to"), F.col(col)))
        .drop("_from", "_to")
    )


def mapping_table(spark, pairs: Mapping[str, Sequence[str]], source: str = "FROM", target: str = "TO") -> DataFrame:
    """Mapping table from ``{target: [source, ...]}`` (a literal hierarchy)."""
    rows = [(s, t) for t, srcs in pairs.items() for s in srcs]
    return spark.createDataFrame(rows, f"{source} string, {target} string")
