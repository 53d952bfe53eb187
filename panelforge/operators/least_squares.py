"""Least squares from moments, in column expressions.

``moments`` are aggregates of any grouping: the means and covariances of the
regressors ``x`` and the targets ``y``. ``solve`` turns a table of them into
coefficients, one projection per regressor, without a Python worker; ``pooled``
merges the moments of parts, so that overlapping groups (sliding windows of
years) need no copies of the rows.

Columns: ``_n`` rows, ``_mx_{i}``, ``_my_{j}`` means, ``_xx_{i}_{h}`` (i <= h) and
``_xy_{i}_{j}`` covariances; solved: ``_c_{i}_{j}`` the weight of regressor i in
target j, ``_use_{i}`` whether the regressor is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A regressor whose variance beyond those before it is under this share of its own counts as their linear combination.
COLLINEAR = 1e-10


def moments(x: Sequence[Column], y: Sequence[Column], used: Column) -> list[Column]:
    """Aggregates over the rows in which ``used`` is true; there ``x`` and ``y`` must not be null."""
    x, y = [F.when(used, c) for c in x], [F.when(used, c) for c in y]
    m, k = range(len(x)), range(len(y))
    return [
        F.count(F.when(used, 1)).alias("_n"),
        *[F.avg(x[i]).alias(f"_mx_{i}") for i in m],
        *[F.avg(y[j]).alias(f"_my_{j}") for j in k],
        *[F.covar_pop(x[i], x[h]).alias(f"_xx_{i}_{h}") for i in m for h in m if i <= h],
        *[F.covar_pop(x[i], y[j]).alias(f"_xy_{i}_{j}") for i in m for j in k],
    ]


def pooled(parts: DataFrame, by: str, m: int, k: int) -> DataFrame:
    """Moments per ``by`` of the union of the parts (rows of ``parts``): within plus between, weighted by ``_n``."""
    own = Window.partitionBy(by)
    means = [f"_mx_{i}" for i in range(m)] + [f"_my_{j}" for j in range(k)]
    weight = F.col("_n") / F.sum("_n").over(own)
    at = parts.withColumn("_w", weight).withColumns({f"_all{c}": F.sum(F.col("_w") * F.col(c)).over(own) for c in means})

    def both(within: str, a: str, b: str) -> Column:
        return F.sum(F.col("_w") * (F.col(within) + (F.col(a) - F.col(f"_all{a}")) * (F.col(b) - F.col(f"_all{b}")))).alias(within)

    return at.groupBy(by).agg(
        *[F.first(f"_all{c}").alias(c) for c in means],
        *[both(f"_xx_{i}_{h}", f"_mx_{i}", f"_mx_{h}") for i in range(m) for h in range(i, m)],
        *[both(f"_xy_{i}_{j}", f"_mx_{i}", f"_my_{j}") for i in range(m) for j in range(k)],
        F.sum("_n").alias("_n"),
    )


def solve(table: DataFrame, m: int, k: int) -> DataFrame:
    """``table`` of moments plus ``_c_{i}_{j}`` and ``_use_{i}``; its covariances are used up.

    Elimination forward: the covariances of the later regressors and of the
    targets lose what each regressor explains. One of which nothing is left is
    not used, its weight is 0. Then substitution backwards.
    """
    at = table.withColumns({f"_var_{i}": F.col(f"_xx_{i}_{i}") for i in range(m)})
    for p in range(m):
        pivot = F.col(f"_xx_{p}_{p}")
        left = (pivot > COLLINEAR * F.col(f"_var_{p}")) & (F.col(f"_var_{p}") > COLLINEAR**2 * F.pow(f"_mx_{p}", F.lit(2)))
        at = at.withColumn(f"_use_{p}", F.coalesce(left, F.lit(False)))
        share = {i: F.when(F.col(f"_use_{p}"), F.col(f"_xx_{p}_{i}") / pivot).otherwise(0.0) for i in range(p + 1, m)}
        less = {f"_xx_{i}_{h}": F.col(f"_xx_{i}_{h}") - share[i] * F.col(f"_xx_{p}_{h}") for i in share for h in range(i, m)}
        less |= {f"_xy_{i}_{j}": F.col(f"_xy_{i}_{j}") - share[i] * F.col(f"_xy_{p}_{j}") for i in share for j in range(k)}
        at = at.withColumns(less)
    for p in reversed(range(m)):
        solved = {}
        for j in range(k):
            rest = F.col(f"_xy_{p}_{j}")
            for i in range(p + 1, m):
                rest = rest - F.col(f"_xx_{p}_{i}") * F.col(f"_c_{i}_{j}")
            solved[f"_c_{p}_{j}"] = F.when(F.col(f"_use_{p}"), rest / F.col(f"_xx_{p}_{p}")).otherwise(0.0)
        at = at.withColumns(solved)
    return at


def constant(m: int, j: int = 0) -> Column:
    """The constant of target ``j`` in a solved table."""
    out = F.col(f"_my_{j}")
    for i in range(m):
        out = out - F.col(f"_c_{i}_{j}") * F.col(f"_mx_{i}")
    return out
