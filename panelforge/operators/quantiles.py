"""Exact quantiles in two aggregates, whatever the size of a group.

``percentile`` merges the distinct values of a whole group in one task. Here a
first aggregate brackets each quantile with ``percentile_approx``, whose sketches
merge in bounded memory and whose rank error is at most 1 / ACCURACY; a second
one counts the values below the bracket and, per distinct value, those inside,
both combined before the shuffle. Only the bracket's distinct values - ACCURACY,
or a share of about 4 / ACCURACY of a larger group - meet in one task, where the order statistics
are picked by their position and interpolated linearly (the pandas /
``quantile_cont`` definition). A value repeated any number of times is one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.ordered import null_safe_join

ACCURACY = 10_000
_MARGIN = 2.0 / ACCURACY


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., P, Q): exact linear-interpolation quantiles of ``col`` (nulls and NaN ignored).

    Groups without values are absent; a null key is a group. ``df`` is evaluated
    twice.
    """
    by, probs = list(by), [float(p) for p in probs]
    value = F.col(col).cast("double")
    values = df.select(*by, value.alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    edges = [min(1.0, max(0.0, p + d)) for p in probs for d in (-_MARGIN, _MARGIN)]
    near = F.percentile_approx("__v", edges, ACCURACY)
    stats = values.groupBy(*by).agg(F.count("*").alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max"), near.alias("__e")).where("__n > 0")

    def bracket(i: int, p: float):
        # the margin is two ranks at least where the group has more values than ACCURACY
        low = F.when((F.col("__n") <= ACCURACY) | (edges[2 * i] == 0.0), F.col("__min")).otherwise(F.col("__e")[2 * i])
        high = F.when((F.col("__n") <= ACCURACY) | (edges[2 * i + 1] == 1.0), F.col("__max")).otherwise(F.col("__e")[2 * i + 1])
        at = (F.col("__n") - 1) * F.lit(p)
        return F.struct(F.lit(p).alias("P"), low.alias("low"), high.alias("high"), F.floor(at).alias("i"), F.ceil(at).alias("j"), (at - F.floor(at)).alias("part"))

    brackets = stats.select(*by, F.array(*[bracket(i, p) for i, p in enumerate(probs)]).alias("__w"))
    joined = null_safe_join(values, brackets, by) if by else values.withColumn("__w", brackets.scalar())
    w = F.col("__w")
    counted = (
        joined.withColumn("__w", F.explode("__w")).where(F.col("__v") <= w["high"])
        .groupBy(*by, "__w", F.when(F.col("__v") >= w["low"], F.col("__v")).alias("__key")).agg(F.count("*").alias("__c"))
    )
    upto = F.sum("__c").over(Window.partitionBy(*by, "__w").orderBy(F.col("__key").asc_nulls_first()))
    placed = counted.withColumn("__end", upto).withColumn("__start", F.col("__end") - F.col("__c"))

    def at(position: str):
        return F.max(F.when((F.col("__start") <= w[position]) & (w[position] < F.col("__end")), F.col("__key")))

    found = placed.groupBy(*by, "__w").agg(at("i").alias("__lo"), at("j").alias("__hi"))
    missed = F.raise_error(F.lit("the bracket of a quantile does not hold it"))
    q = F.when(F.col("__lo").isNull() | F.col("__hi").isNull(), missed.cast("double")).otherwise(F.col("__lo") + (F.col("__hi") - F.col("__lo")) * w["part"])
    return found.select(*by, w["P"].alias("P"), q.alias("Q"))


#: Half the width of the bracket, as a share of the values, that holds the medians of all folds.
_FOLD_MARGIN = 0.01


def fold_medians_in_bracket(df: DataFrame, column: str, folds: int, cols: Sequence[str]) -> list[dict[str, float | None]]:
    """For each fold, the exact median of each column over the rows outside it; 0 without values, None if the bracket does not hold it.

    As ``exact_quantiles``, in two aggregates of all rows, for all folds together: a sketch
    of all values gives one bracket per column; below and, per distinct value, inside it the values
    of each fold are counted, and a fold's training rows are all rows but its own. The driver gets
    two numbers per column and fold.
    """
    cols = list(cols)
    long = df.select(F.col(column).alias("__fold"), *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(["__fold"], cols, "METRIC", "__v")
    values = long.where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    of_fold = [F.count(F.when(F.col("__fold") == k, 1)).alias(f"__n{k}") for k in range(folds)]
    near = F.percentile_approx("__v", [0.5 - _FOLD_MARGIN, 0.5 + _FOLD_MARGIN], ACCURACY).alias("__e")
    stats = values.groupBy("METRIC").agg(F.count("*").alias("__n"), *of_fold, F.min("__v").alias("__min"), F.max("__v").alias("__max"), near).collect()  # a row per column
    rows = []
    for r in stats:
        low, high = (r["__min"], r["__max"]) if r["__n"] <= ACCURACY else r["__e"]
        rows.append((r["METRIC"], low, high, [r["__n"] - r[f"__n{k}"] - 1 for k in range(folds)]))
    out: list[dict[str, float | None]] = [dict.fromkeys(cols, 0.0) for _ in range(folds)]
    if not rows:
        return out
    brackets = F.broadcast(df.sparkSession.createDataFrame(rows, "METRIC string, __low double, __high double, __last array<long>"))
    inside = values.join(brackets, "METRIC").where(F.col("__v") <= F.col("__high"))
    key = F.when(F.col("__v") >= F.col("__low"), F.col("__v")).alias("__key")
    counted = inside.groupBy("METRIC", key).agg(F.count("*").alias("__n"), *of_fold)
    upto = Window.partitionBy("METRIC").orderBy(F.col("__key").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    others = [F.col("__n") - F.col(f"__n{k}") for k in range(folds)]
    placed = counted.select("METRIC", "__key", *[c.alias(f"__c{k}") for k, c in enumerate(others)], *[F.sum(c).over(upto).alias(f"__end{k}") for k, c in enumerate(others)])

    def at(k: int, place):
        return F.max(F.when((F.col(f"__end{k}") - F.col(f"__c{k}") <= place) & (place < F.col(f"__end{k}")), F.col("__key")))

    last = [F.col("__last")[k] / 2 for k in range(folds)]
    found = placed.join(brackets, "METRIC").groupBy("METRIC").agg(*[at(k, f(last[k])).alias(f"{f.__name__}{k}") for k in range(folds) for f in (F.floor, F.ceil)]).collect()
    picked = {r["METRIC"]: r for r in found}
    for metric, _, _, lasts in rows:
        for k, n in enumerate(lasts):
            if n >= 0:
                low, high = picked[metric][f"floor{k}"], picked[metric][f"ceil{k}"]
                out[k][metric] = None if low is None or high is None else low + (high - low) * (n / 2 - n // 2)
    return out


def quantile_columns(df: DataFrame, cols: Sequence[str], named: dict[float, str], by: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """(by..., METRIC, one column per quantile) of several columns at once."""
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(list(by), list(cols), "METRIC", "__val")
    q = exact_quantiles(long, "__val", list(named), by=[*by, "METRIC"])
    if digits is not None:
        q = q.withColumn("Q", F.round("Q", digits))
    return q.groupBy(*by, "METRIC").agg(*[F.max(F.when(F.col("P") == p, F.col("Q"))).alias(n) for p, n in named.items()])
