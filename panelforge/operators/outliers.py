"""Interquartile fences.

Quartiles are exact (``percentile``, linear interpolation, nulls ignored: the
pandas/``quantile_cont`` definition), never ``approx_percentile``. They are
rounded to ``digits`` decimals (default 6) before the fences are derived: the
inputs carry at most 4 decimals and interpolation weights are multiples of
1/4, so quartiles carry at most 6 decimals and the rounding loses nothing,
while it removes the last-bit differences between interpolation formulas of
different engines.

Three behaviours exist and are offered separately:

* ``fence_filter_global``  keep rows strictly inside the fences of the whole
  table; boundary rows and nulls are dropped; sequential over columns.
* ``fence_filter_by``      per group (year), drop rows strictly outside;
  boundary rows and nulls are kept; sequential over columns.
* ``winsorize_by``         per group, clip to the fences; columns independent.

Scale: quartiles come from ``exact_quantiles``, which never merges a year or the
table in one task. Fences are small tables (one row per group) written as Parquet
and joined; Spark broadcasts them as far as their size allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators.ordered import null_safe_join
from panelforge.operators.quantiles import exact_quantiles, quantile_columns
from panelforge.session import write_once

FENCE_K = 1.5
QUANTILE_DIGITS = 6
REWRITE = 4


def fence_bounds(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("YEAR",), k: float = FENCE_K,
                 digits: int | None = QUANTILE_DIGITS) -> DataFrame:
    """(by..., METRIC, Q1, Q3, IQR, LOW, HIGH).

    All columns are unpivoted to (METRIC, value); their quartiles are one pass of
    ``exact_quantiles``.
    """
    q = quantile_columns(df, cols, {0.25: "Q1", 0.75: "Q3"}, by, digits)
    iqr = F.col("Q3") - F.col("Q1")
    return q.withColumn("IQR", iqr).withColumn("LOW", F.col("Q1") - k * iqr).withColumn("HIGH", F.col("Q3") + k * iqr)


def _fences(df: DataFrame, col: str, by: Sequence[str], k: float, digits: int | None) -> DataFrame:
    """(by..., __low, __high) of one column, written: one row per group."""
    low, high = F.col("LOW").alias("__low"), F.col("HIGH").alias("__high")
    return write_once(fence_bounds(df, [col], by, k, digits).select(*by, low, high), "fences")


def fence_filter_global(df: DataFrame, cols: Sequence[str], k: float = FENCE_K, digits: int | None = QUANTILE_DIGITS) -> DataFrame:
    """O1: keep rows strictly inside ``(q1 - k*iqr, q3 + k*iqr)`` of the whole table.

    Sequential by definition: the fences of a column are computed on the rows
    that survived the previous columns, so the list order is part of the
    signature. The input is written once, without its lineage; each column costs
    one pass that returns two numbers.
    """
    out = write_once(df, "fence-input")
    for c in cols:
        q = exact_quantiles(out, c, [0.25, 0.75])
        got = {r["P"]: r["Q"] for r in (q if digits is None else q.withColumn("Q", F.round("Q", digits))).collect()}
        if not got:
            return out.where(F.lit(False))
        q1, q3 = F.lit(got[0.25]), F.lit(got[0.75])
        out = out.where((F.col(c) > q1 - k * (q3 - q1)) & (F.col(c) < q3 + k * (q3 - q1)))
    return out


def fence_filter_by(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("YEAR",), k: float = FENCE_K,
                    digits: int | None = QUANTILE_DIGITS) -> DataFrame:
    """O2: per group drop rows strictly outside the fences; boundary rows and nulls stay.

    Sequential over columns within each group. The input is written once; each
    column is one pass for the fences of all groups and one join with them. The
    rows left are written again after every ``REWRITE`` columns, so that a pass
    never repeats a long chain of joins.
    """
    out = write_once(df, "fence-input")
    for i, c in enumerate(cols):
        if i and i % REWRITE == 0:
            out = write_once(out, "fence-rows")
        x = F.col(c)
        inside = x.isNull() | F.col("__low").isNull() | ((x >= F.col("__low")) & (x <= F.col("__high")))
        out = null_safe_join(out, _fences(out, c, by, k, digits), list(by), "left").where(inside).drop("__low", "__high")
    return out


def winsorize_by(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("YEAR",), k: float = FENCE_K,
                 digits: int | None = QUANTILE_DIGITS) -> DataFrame:
    """O3: per group clip every column to its fences; nulls stay null; columns independent.

    One pass for the fences of all columns, one join with them.
    """
    base = write_once(df, "winsorize-input")
    bounds = fence_bounds(base, cols, by, k, digits)
    wide = bounds.groupBy(*by).agg(*[
        F.max(F.when(F.col("METRIC") == c, F.col(edge))).alias(f"__{edge}_{i}") for i, c in enumerate(cols) for edge in ("LOW", "HIGH")
    ])
    out = null_safe_join(base, write_once(wide, "fences"), list(by), "left")
    clipped = {
        c: F.when(F.col(c).isNull(), F.col(c)).otherwise(F.least(F.greatest(F.col(c), F.col(f"__LOW_{i}")), F.col(f"__HIGH_{i}")))
        for i, c in enumerate(cols)
    }
    return out.withColumns(clipped).select(*df.columns)
