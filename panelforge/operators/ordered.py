"""Positions and running totals over a total order, without a task per group.

A window partitioned by a period runs a whole period in one task. Here the rows
are range-partitioned by (group, order), written once, and summed in two levels:
the sums per (partition, group) - at most partitions x groups rows - give each
partition's offset in its group, and a window inside the partition gives the
rest. A group of any size spreads over the range partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.session import write_once


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which null keys meet; the left side's keys stay."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"__right_{k}"]) for k in keys]
    return left.join(renamed, on, how).drop(*[f"__right_{k}" for k in keys])


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[Column], totals: Mapping[str, Column], whole: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` plus, for each of ``totals``, its sum over the rows of the group up to and including this one.

    ``order`` must be a total order inside a group for the result to be
    determined. Group keys may be null. ``whole`` names, for some of ``totals``, a
    column for the sum over all rows of the group.
    """
    by, whole = list(by), whole or {}
    marked = df.withColumns({f"__{name}": value for name, value in totals.items()})
    dealt = marked.repartitionByRange(*[F.col(b).asc() for b in by], *order)
    laid = write_once(dealt.withColumn("__pid", F.spark_partition_id()), "ordered")
    sums = laid.groupBy("__pid", *by).agg(*[F.sum(f"__{name}").alias(f"__sum_{name}") for name in totals])
    before = Window.partitionBy(*by).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__pid", *by, *[F.coalesce(F.sum(f"__sum_{name}").over(before), F.lit(0)).alias(f"__before_{name}") for name in totals],
                          *[F.sum(f"__sum_{name}").over(Window.partitionBy(*by)).alias(out) for name, out in whole.items()])
    inside = Window.partitionBy("__pid", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = null_safe_join(laid, offsets, ["__pid", *by])
    found = {name: F.col(f"__before_{name}") + F.sum(f"__{name}").over(inside) for name in totals}
    return placed.withColumns(found).select(*df.columns, *totals, *whole.values())


def row_numbers(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str, size: str | None = None) -> DataFrame:
    """``row_number`` over (by, order), from 1; ``size`` names a column for the group's number of rows."""
    return running_totals(df, by, order, {out: F.lit(1)}, {out: size} if size else None).withColumn(out, F.col(out).cast("int"))


def dense_numbers(df: DataFrame, by: Sequence[str], value: str, tie: str, out: str) -> DataFrame:
    """``dense_rank`` over (by, value), from 1; ``tie`` tells equal values apart, so that a frequent one spreads.

    Each partition counts its distinct values. A value that goes on from the
    partition before was counted there, which the ends of the partitions tell.
    """
    by = list(by)
    dealt = df.repartitionByRange(*[F.col(b).asc() for b in by], F.col(value).asc(), F.col(tie).asc())
    laid = write_once(dealt.withColumn("__pid", F.spark_partition_id()), "ordered")
    ends = laid.groupBy("__pid", *by).agg(F.count_distinct(value).alias("__n"), F.min(value).alias("__low"), F.max(value).alias("__high"))
    parts = Window.partitionBy(*by).orderBy("__pid")
    goes_on = F.coalesce((F.lag("__high").over(parts) == F.col("__low")).cast("long"), F.lit(0))
    before = F.coalesce(F.sum("__n").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = ends.withColumns({"__on": goes_on, "__sum": before})
    offsets = counted.select("__pid", *by, (F.col("__sum") - F.sum("__on").over(parts.rowsBetween(Window.unboundedPreceding, 0))).alias("__before"))
    inside = Window.partitionBy("__pid", *by).orderBy(F.col(value).asc())
    placed = null_safe_join(laid, offsets, ["__pid", *by])
    return placed.withColumn(out, (F.col("__before") + F.dense_rank().over(inside)).cast("int")).select(*df.columns, out)
