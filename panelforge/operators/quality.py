"""Profiling, data-quality and eligibility operators.

Profiles are computed as one wide aggregate (a single scan with map-side
partial aggregation) and reshaped afterwards with ``inline`` of an array of
structs; unpivoting first would multiply the rows by the number of columns
before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.columns import half_up
from panelforge.operators.ordered import null_safe_join
from panelforge.operators.quantiles import exact_quantiles, quantile_columns
from panelforge.session import write_once


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of numeric columns."""
    numeric = ("int", "bigint", "smallint", "tinyint", "double", "float") 
    return [c for c, t in df.dtypes if (t in numeric or t.startswith("decimal")) and c not in exclude]


def _long(g: DataFrame, keys: Sequence[str], cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    rows = F.array(
        *[F.struct(F.lit(c).alias("METRIC"), *[F.col(f"_{c}_{f}").alias(f) for f in fields]) for c in cols]
    )
    return g.select(*keys, F.inline(rows))


def null_zero_profile(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), digits: int = 2) -> DataFrame:
    """Percentage of nulls and of exact zeros per column (optionally per entity)."""
    aggs = []
    for c in cols:
        aggs.append(half_up(F.avg(F.col(c).isNull().cast("int")) * 100, digits).alias(f"_{c}_NULL_PCT"))
        aggs.append(half_up(F.avg(F.when(F.col(c) == 0, 1).otherwise(0)) * 100, digits).alias(f"_{c}_ZERO_PCT"))
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return _long(g, by, cols, ["NULL_PCT", "ZERO_PCT"])


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, std (sample), min, quartiles, max per column, long form.

    The columns are written once; moments come from one wide aggregate, the
    quartiles of all columns from one pass over the unpivoted values.
    """
    base = write_once(df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]), "describe")
    aggs = []
    for c in cols:
        aggs += [
            F.count(c).alias(f"_{c}_COUNT"),
            F.avg(c).alias(f"_{c}_MEAN"),
            F.stddev_samp(c).alias(f"_{c}_STD"),
            F.min(c).alias(f"_{c}_MIN"),
            F.max(c).alias(f"_{c}_MAX"),
        ]
    g = base.groupBy(*by).agg(*aggs) if by else base.agg(*aggs)
    moments = _long(g, by, cols, ["COUNT", "MEAN", "STD", "MIN", "MAX"])
    q = quantile_columns(base, cols, {0.25: "P25", 0.5: "P50", 0.75: "P75"}, by)
    return null_safe_join(moments, q, [*by, "METRIC"], "left").select(*by, "METRIC", "COUNT", "MEAN", "STD", "MIN", "P25", "P50", "P75", "MAX")


def zero_sum_columns(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sum per column and whether it is zero (columns to drop), whole set or per entity."""
    g = df.groupBy(*by).agg(*[F.sum(c).alias(f"_{c}_SUM") for c in cols]) if by else df.agg(
        *[F.sum(c).alias(f"_{c}_SUM") for c in cols]
    )
    return _long(g, by, cols, ["SUM"]).withColumn("IS_ZERO", F.col("SUM") == 0)


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Row count and exact distinct count per column in one aggregate."""
    g = df.agg(F.count(F.lit(1)).alias("_ROWS"), *[F.countDistinct(c).alias(f"_{c}_DISTINCT") for c in cols])
    return g.select(F.col("_ROWS").alias("ROWS"), F.inline(F.array(
        *[F.struct(F.lit(c).alias("METRIC"), F.col(f"_{c}_DISTINCT").alias("DISTINCT")) for c in cols])))


def correlation_matrix(df: DataFrame, cols: Sequence[str], absolute: bool = True) -> DataFrame:
    """Pearson correlation of every pair (lower triangle), pairwise complete rows,
    all pairs in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[:i]]
    aggs = []
    for a, b in pairs:
        r = F.corr(F.col(a).cast("double"), F.col(b).cast("double"))
        aggs.append((F.abs(r) if absolute else r).alias(f"_{a}__{b}"))
    g = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(a).alias("METRIC_A"), F.lit(b).alias("METRIC_B"), F.col(f"_{a}__{b}").alias("CORR"))
                     for a, b in pairs])
    return g.select(F.inline(rows))


def _bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin 1..bins of ``x`` on [lo, hi]; the maximum falls in the last bin."""
    raw = F.floor((x - lo) / (hi - lo) * bins) + 1
    return F.when(hi == lo, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Counts in ``bins`` equal-width bins over the column's global [min, max].

    min and max are scalar subqueries (evaluated once, no join); bins with no
    rows are absent. ``by`` splits counts per class (the density-per-class
    view) while the bin edges stay global.
    """
    x = F.col(col).cast("double")
    stats = df.select(F.min(x).alias("lo"), F.max(x).alias("hi"))
    lo = stats.select("lo").scalar()
    hi = stats.select("hi").scalar()
    b = df.where(x.isNotNull()).select(*by, _bin(x, lo, hi, bins).alias("BIN"), lo.alias("_lo"), hi.alias("_hi"))
    g = b.groupBy(*by, "BIN").agg(F.count(F.lit(1)).alias("COUNT"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return g.select(
        F.lit(col).alias("METRIC"), *by, "BIN",
        (F.col("_lo") + (F.col("BIN") - 1) * width).alias("LOW"),
        (F.col("_lo") + F.col("BIN") * width).alias("HIGH"),
        "COUNT",
    )


def boxplot_summary(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: float = 1.5,
                    digits: int = 6) -> DataFrame:
    """q1, median, q3, whiskers (most extreme values inside the fences) and outlier count.

    The columns are written once in long form; the quartiles of all groups and
    columns are one pass, joined to the values for the conditional aggregates.
    """
    long = write_once(
        df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(list(by), list(cols), "METRIC", "__val"), "boxplot"
    )
    keys = [*by, "METRIC"]
    q = exact_quantiles(long, "__val", [0.25, 0.5, 0.75], keys).withColumn("Q", F.round("Q", digits))
    named = {0.25: "Q1", 0.5: "MEDIAN", 0.75: "Q3"}
    wide = write_once(q.groupBy(*keys).agg(*[F.max(F.when(F.col("P") == p, F.col("Q"))).alias(n) for p, n in named.items()]), "boxplot-quartiles")
    v, iqr = F.col("__val"), F.col("Q3") - F.col("Q1")
    inside = (v >= F.col("Q1") - k * iqr) & (v <= F.col("Q3") + k * iqr)
    return null_safe_join(long, wide, keys, "left").groupBy(*keys).agg(
        *[F.max(n).alias(n) for n in named.values()],
        F.min(F.when(inside, v)).alias("WHISKER_LOW"),
        F.max(F.when(inside, v)).alias("WHISKER_HIGH"),
        F.count(F.when(v.isNotNull() & ~inside, 1)).alias("OUTLIERS"),
    )


def entity_eligibility(df: DataFrame, key: str = "CODE", period: str = "YEAR", min_periods: int = 12,
                       last_period: int | None = None, cols: Sequence[str] | None = None) -> DataFrame:
    """Entities with no null in any row, at least ``min_periods`` rows, no gap
    between first and last period, and ending at ``last_period`` (default: the
    latest period in the data, a scalar subquery).

    One ``groupBy(key)`` with partial aggregation; the result is one row per
    eligible entity (use ``keep_entities`` to filter rows).
    """
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in (key, period)]
    any_null = F.greatest(*[F.col(c).isNull().cast("int") for c in cols]) if len(cols) > 1 else F.col(cols[0]).isNull().cast("int")
    g = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("N"),
        F.min(period).alias("FIRST_PERIOD"),
        F.max(period).alias("LAST_PERIOD"),
        F.sum(any_null).alias("NULL_ROWS"),
    )
    last = F.lit(last_period) if last_period is not None else df.select(F.max(period)).scalar()
    return g.where(
        (F.col("NULL_ROWS") == 0)
        & (F.col("N") >= min_periods)
        & (F.col("LAST_PERIOD") - F.col("FIRST_PERIOD") + 1 == F.col("N"))
        & (F.col("LAST_PERIOD") == last)
    )


def eligible_rows(df: DataFrame, key: str = "CODE", period: str = "YEAR", min_periods: int = 12,
                  last_period: int | None = None, cols: Sequence[str] | None = None) -> DataFrame:
    """A17 as a row filter in one pass: the same rules as ``entity_eligibility``
    evaluated with window aggregates per entity (a partition is one entity's
    series, bounded by its number of periods) instead of aggregate + semi join,
    which would evaluate the input twice."""
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in (key, period)]
    any_null = F.greatest(*[F.col(c).isNull().cast("int") for c in cols]) if len(cols) > 1 else F.col(cols[0]).isNull().cast("int")
    w = Window.partitionBy(key)
    last = F.lit(last_period) if last_period is not None else df.select(F.max(period)).scalar()
    n, lo, hi = F.count(F.lit(1)).over(w), F.min(period).over(w), F.max(period).over(w)
    ok = (F.sum(any_null).over(w) == 0) & (n >= min_periods) & (hi - lo + 1 == n) & (hi == last)
    return df.withColumn("_eligible", ok).where(F.col("_eligible")).drop("_eligible")


def drop_entities_with_value(df: DataFrame, col: str, value=0, key: str = "CODE") -> DataFrame:
    """A18 in one pass: drop every row of an entity that has any row with ``col == value``
    (window flag per entity instead of distinct keys + anti join)."""
    flag = F.max(F.when(F.col(col) == value, 1).otherwise(0)).over(Window.partitionBy(key))
    return df.withColumn("_hit", flag).where(F.col("_hit") == 0).drop("_hit")


def keep_entities(df: DataFrame, entities: DataFrame, key: str = "CODE") -> DataFrame:
    """Rows whose key is in ``entities`` (left semi join)."""
    return df.join(entities.select(key), key, "left_semi")


def drop_entities(df: DataFrame, entities: DataFrame, key: str = "CODE") -> DataFrame:
    """Rows whose key is not in ``entities`` (left anti join)."""
    return df.join(entities.select(key), key, "left_anti")


def entities_with_value(df: DataFrame, col: str, value=0, key: str = "CODE") -> DataFrame:
    """Keys having any row with ``col == value`` (e.g. a zero market cap)."""
    return df.where(F.col(col) == value).select(key).distinct()


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """drop rows with a null in any (or the listed) column; NaN counts as missing."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def between_closed(col: str, low: float, high: float) -> Column:
    """F4 closed interval ``low <= col <= high``."""
    return F.col(col).between(low, high)


def between_open(col: str, low: float, high: float) -> Column:
    """F4/F8 open interval ``low < col < high``."""
    return (F.col(col) > low) & (F.col(col) < high)
