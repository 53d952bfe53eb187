"""Rank, top-N and first/last-row operators.

Ranks within a period do not run as a window over the period, which would be one
task per year: rows are numbered by ``operators.ordered`` over
range partitions. Several ranks of a table are one
pass over its long form (one row per key and column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.ordered import dense_numbers, null_safe_join, row_numbers
from panelforge.session import write_once


def _sort_keys(value: Column, ascending: bool, nulls_first: bool) -> tuple[Column, Column]:
    """Two ascending keys (class, value) with the order of one sort key: nulls and NaN where Spark puts them."""
    x = value.cast("double")
    nan = 3 if ascending else 1  # NaN is the largest value
    kind = F.when(x.isNull(), 0 if nulls_first else 4).when(F.isnan(x), nan).otherwise(2)
    return kind, F.when(kind == 2, x if ascending else -x)


def _row_numbers_long(df: DataFrame, cols: Sequence[str], ascending: Sequence[bool], nulls_first: Sequence[bool], by: Sequence[str], tie_break: Sequence[str]) -> DataFrame:
    """(by, tie_break, __m, __rank): the row number of each row within ``by`` for column number ``__m``."""
    parts = []
    for i, (c, up, first) in enumerate(zip(cols, ascending, nulls_first)):
        kind, value = _sort_keys(F.col(c), up, first)
        parts.append(F.struct(F.lit(i).alias("__m"), kind.alias("__k"), value.alias("__v")))
    keys = list(dict.fromkeys([*by, *tie_break]))
    long = df.select(*keys, F.inline(F.array(*parts)))
    order = [F.col("__k").asc(), F.col("__v").asc(), *[F.col(t).asc() for t in tie_break if t not in by]]
    return row_numbers(long, [*by, "__m"], order, "__rank").select(*keys, "__m", "__rank")


def row_rank(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("YEAR",), ascending: bool | Sequence[bool] = True,
             tie_break: Sequence[str] = ("CODE",), suffix: str = "_RANKING", names: Sequence[str] | None = None,
             nulls_first: bool | None = None) -> DataFrame:
    """``row_number`` per column within ``by``.

    Default null placement follows Spark: ascending puts nulls first (they get
    the lowest numbers), descending puts them last. ``(by, tie_break)`` is the
    key of a row, which makes the result deterministic; rows that share it share
    their ranks. The columns must be numeric. ``df`` is written once and read by
    both the numbering and the join that brings the ranks back.
    """
    asc = [ascending] * len(cols) if isinstance(ascending, bool) else list(ascending)
    first = [up if nulls_first is None else nulls_first for up in asc]
    names = list(names) if names else [c + suffix for c in cols]
    base = write_once(df, "rank")
    keys = list(dict.fromkeys([*by, *tie_break]))
    long = _row_numbers_long(base, cols, asc, first, by, tie_break)
    wide = long.groupBy(*keys).agg(*[F.min(F.when(F.col("__m") == i, F.col("__rank"))).alias(n) for i, n in enumerate(names)])
    return null_safe_join(base.drop(*names), wide, keys, "left")


def row_rank_long(df: DataFrame, cols: Sequence[str], key: Sequence[str] = ("YEAR", "CODE"), by: str = "YEAR",
                  tie_break: str = "CODE") -> DataFrame:
    """Ascending row ranks of many metrics as a long table (key, METRIC, VALUE, RANKING)."""
    long = df.select(*key, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(key), list(cols), "METRIC", "VALUE"
    )
    return row_numbers(long, [by, "METRIC"], [F.col("VALUE").asc_nulls_first(), F.col(tie_break).asc()], "RANKING")


def dense_rank_by(df: DataFrame, col: str, by: Sequence[str] = ("YEAR",), ascending: bool = False,
                  out: str | None = None) -> DataFrame:
    """Dense rank within ``by``; ties share a rank, no gaps, nulls stay null.

    A value repeated many times spreads over partitions like any other rows.
    """
    return dense_ranks(df, {out or f"{col}_RANK": (col, ascending)}, by)


def dense_ranks(df: DataFrame, ranks: dict[str, tuple[str, bool]], by: Sequence[str] = ("YEAR",)) -> DataFrame:
    """Several dense ranks ``{name: (column, ascending)}`` within ``by``, numbered in one pass over the long form.

    The rows are numbered when they are written; a row's ranks come back in one
    join on that number, whatever the number of ranks and however often a value
    is repeated.
    """
    base = write_once(df.withColumn("__row", F.monotonically_increasing_id()), "dense-rank")
    parts = [
        F.struct(F.lit(i).alias("__m"), (F.col(c).cast("double") * (1 if up else -1) + 0.0).alias("__v"))  # + 0.0: no negative zero
        for i, (c, up) in enumerate(ranks.values())
    ]
    long = base.select(*by, "__row", F.inline(F.array(*parts))).where("__v is not null")
    numbered = dense_numbers(long, [*by, "__m"], "__v", "__row", "__rank")
    wide = numbered.groupBy("__row").agg(*[F.min(F.when(F.col("__m") == i, F.col("__rank"))).alias(name) for i, name in enumerate(ranks)])
    return base.drop(*ranks).join(wide, "__row", "left").drop("__row")


def top_n(df: DataFrame, order: Sequence[Column], n: int, by: Sequence[str] = ("YEAR",), rank_name: str = "RANK") -> DataFrame:
    """Keep the first ``n`` rows per group by a total order.

    The filter on ``row_number`` lets Spark plan a ``WindowGroupLimit`` below
    the exchange, so each task ships at most ``n`` rows per group.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= n)


def unique_rank_of_sum(df: DataFrame, group: Sequence[str], measure: str, by: Sequence[str] = (),
                       ascending: bool = True, out: str = "RANK_UNIQUE", n: int | None = None) -> DataFrame:
    """Sum a measure per group, then a tie-free rank of the sums (ties by group key).

    The rank runs over the aggregated rows (one per group), numbered over range
    partitions. With ``n`` only the first ``n`` are kept, which Spark plans as a
    per-task ``WindowGroupLimit`` before the final window.
    """
    agg = df.groupBy(*by, *group).agg(F.sum(measure).alias(f"SUM_{measure}"))
    s = F.col(f"SUM_{measure}")
    order = [s.asc_nulls_last() if ascending else s.desc_nulls_last(), *[F.col(g) for g in group]]
    if n is None:
        return row_numbers(agg, by, order, out)
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)
    return agg.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n)


def first_row(df: DataFrame, key: Sequence[str], order: str, value_cols: Sequence[str]) -> DataFrame:
    """Values of the earliest row per key (``min_by``: an aggregate, no sort)."""
    return df.groupBy(*key).agg(*[F.min_by(c, order).alias(c) for c in value_cols], F.min(order).alias(order))


def last_row(df: DataFrame, key: Sequence[str], order: str, value_cols: Sequence[str]) -> DataFrame:
    """Values of the latest row per key (``max_by``)."""
    return df.groupBy(*key).agg(*[F.max_by(c, order).alias(c) for c in value_cols], F.max(order).alias(order))
