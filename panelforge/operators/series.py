"""Per-entity time-series operators.

Every window here is partitioned by the entity (and ordered by the period) of
an already aggregated series -- one row per (entity, year) or (entity, day) --
so a partition is bounded by the calendar span, not by raw event volume.
Groupwise model fits run as one grouped aggregate; the multivariate VAR solves its
normal equations from that aggregate's covariances in column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators import least_squares
from panelforge.operators.ordered import null_safe_join
from panelforge.session import write_once


def series_to_supervised(df: DataFrame, cols: Sequence[str], key: str = "CODE", order: str = "YEAR",
                         n_in: int = 1, n_out: int = 1, dropnan: bool = True) -> DataFrame:
    """Lags ``n_in..1``, the value and leads ``1..n_out-1`` of every column.

    A column per signed offset from ``-n_in`` to ``n_out - 1`` and input column:
    the shifted value, named by ``supervised_name``. Shifts are per entity; rows
    with a missing value are dropped when ``dropnan``.
    """
    w = Window.partitionBy(key).orderBy(order)
    shifted = [F.lead(c, at).over(w).alias(supervised_name(j, at)) for at in range(-n_in, n_out) for j, c in enumerate(cols, 1)]
    out = df.select(key, order, *shifted)
    return out.na.drop() if dropnan else out


def supervised_name(column: int, offset: int) -> str:
    """``var{column}(t)`` with the signed offset behind t, 1-based columns."""
    return f"var{column}(t{offset:+d})".replace("+0", "")


def calendar_fill(df: DataFrame, key: str, time: str, step: str = "1 day") -> DataFrame:
    """Every period between an entity's first and last one, joined to its values;
    missing periods get nulls. The generated rows per entity are bounded by its
    calendar span."""
    span = df.groupBy(key).agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    grid = span.select(key, F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {step}"))).alias(time))
    return grid.join(df, [key, time], "left")


def linear_interpolation(df: DataFrame, cols: Sequence[str], key: str, order: str, drop_leading: bool = True) -> DataFrame:
    """Fill nulls linearly by row position within each entity.

    After the last known value it is carried forward; before the first known
    value it stays null and, with ``drop_leading``, the row is dropped.
    """
    ahead = Window.partitionBy(key).orderBy(F.col(order).asc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the next known value is the last one seen from the other end: a growing frame costs one step a row
    behind = Window.partitionBy(key).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumn("__pos", F.row_number().over(Window.partitionBy(key).orderBy(order)))

    def known(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col("__pos").alias("at")))

    out = out.withColumns({f"__from_{i}": F.last(known(c), ignorenulls=True).over(ahead) for i, c in enumerate(cols)})
    out = out.withColumns({f"__to_{i}": F.last(known(c), ignorenulls=True).over(behind) for i, c in enumerate(cols)})
    filled = {}
    for i, c in enumerate(cols):
        a, b = F.col(f"__from_{i}"), F.col(f"__to_{i}")
        between = a["v"] + F.try_divide((b["v"] - a["v"]) * (F.col("__pos") - a["at"]), b["at"] - a["at"])
        filled[c] = F.coalesce(F.col(c), between, a["v"])
    out = out.withColumns(filled).drop("__pos", *[f"__{side}_{i}" for side in ("from", "to") for i in range(len(cols))])
    return out.na.drop(subset=list(cols)) if drop_leading else out


def standard_scale(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("YEAR",), suffix: str = "") -> DataFrame:
    """Z-score with the population standard deviation within ``by``."""
    base = write_once(df, "scale")
    moments = base.groupBy(*by).agg(*[f(c).alias(f"__{n}_{i}") for i, c in enumerate(cols) for n, f in (("avg", F.avg), ("std", F.stddev_pop))])
    out = null_safe_join(base, moments, list(by))
    scaled = {c + suffix: F.try_divide(F.col(c) - F.col(f"__avg_{i}"), F.col(f"__std_{i}")) for i, c in enumerate(cols)}
    return out.withColumns(scaled).drop(*[f"__{n}_{i}" for i in range(len(cols)) for n in ("avg", "std")])


def min_max_scale(df: DataFrame, cols: Sequence[str], suffix: str = "_SCALED") -> DataFrame:
    """(x - min) / (max - min) over the whole table; min and max are scalar
    subqueries (one aggregate, no single-partition window). Keeps ``_MIN``/``_MAX``
    columns so that ``min_max_inverse`` can undo it."""
    stats = df.agg(*[F.min(c).alias(f"{c}_MIN") for c in cols], *[F.max(c).alias(f"{c}_MAX") for c in cols])
    out = df
    for c in cols:
        lo, hi = stats.select(f"{c}_MIN").scalar(), stats.select(f"{c}_MAX").scalar()
        out = out.withColumn(f"{c}_MIN", lo).withColumn(f"{c}_MAX", hi)
        out = out.withColumn(c + suffix, F.try_divide(F.col(c) - F.col(f"{c}_MIN"), F.col(f"{c}_MAX") - F.col(f"{c}_MIN")))
    return out


def min_max_inverse(df: DataFrame, col: str, scaled: str, out: str) -> DataFrame:
    """Inverse of ``min_max_scale`` for one column (used on forecasts)."""
    return df.withColumn(out, F.col(scaled) * (F.col(f"{col}_MAX") - F.col(f"{col}_MIN")) + F.col(f"{col}_MIN"))


def persistence_rmse(df: DataFrame, value: str, key: str = "CODE", order: str = "YEAR", test_fraction: float = 1.0) -> DataFrame:
    """Forecast y(t) = y(t-1); RMSE over the last ``int(n * f)`` rows of each
    series (the last row only when ``f == 1``). Returns (key, N, PREDICTION, RMSE)
    with PREDICTION the forecast of the last row."""
    w = Window.partitionBy(key).orderBy(order)
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    limit = F.lit(1) if test_fraction == 1 else F.floor(n * F.lit(test_fraction))
    s = (
        df.select(key, order, value)
        .withColumn("_pos", F.row_number().over(w))
        .withColumn("_n", n)
        .withColumn("_prev", F.lag(value).over(w))
        .withColumn("_test", F.col("_pos") > F.col("_n") - limit)
    )
    err = F.when(F.col("_test"), F.pow(F.col(value) - F.col("_prev"), 2))
    return s.groupBy(key).agg(
        F.max("_n").alias("N"),
        F.max_by("_prev", "_pos").alias("PREDICTION"),
        F.sqrt(F.avg(err)).alias("RMSE"),
    )


def ar1_forecast(df: DataFrame, value: str, key: str = "CODE", order: str = "YEAR", holdout: int = 1) -> DataFrame:
    """Univariate VAR(1) with a constant, fitted in closed form per entity.

    ``y_t = a + b * y_{t-1}`` on every pair inside the training rows (all but
    the last ``holdout``), then a one-step forecast from the last training value
    compared with the next actual value. One window pass and one grouped
    aggregate (``regr_slope``/``regr_intercept``) for all entities.
    """
    w = Window.partitionBy(key).orderBy(order)
    s = (
        df.select(key, order, value)
        .withColumn("_pos", F.row_number().over(w))
        .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
        .withColumn("_prev", F.lag(value).over(w))
    )
    train = F.col("_pos") <= F.col("_n") - holdout
    pair = train & F.col("_prev").isNotNull()
    y, x = F.when(pair, F.col(value)), F.when(pair, F.col("_prev"))
    g = s.groupBy(key).agg(
        F.regr_slope(y, x).alias("SLOPE"),
        F.regr_intercept(y, x).alias("INTERCEPT"),
        F.max_by(F.col(value), F.when(train, F.col("_pos"))).alias("_last_train"),
        F.max_by(F.col(value), F.when(F.col("_pos") == F.col("_n") - holdout + 1, F.col("_pos"))).alias("ACTUAL"),
    )
    fc = F.col("INTERCEPT") + F.col("SLOPE") * F.col("_last_train")
    return g.withColumn("FORECAST", fc).withColumn("RMSE", F.abs(F.col("ACTUAL") - F.col("FORECAST"))).drop("_last_train")


def var_forecast(df: DataFrame, cols: Sequence[str], key: str = "CODE", order: str = "YEAR", lags: int = 1,
                 holdout: int | float = 1) -> DataFrame:
    """Vector autoregression with a constant, least squares, per entity.

    Fitted on all but the last ``holdout`` rows (a number, or a share of the
    series as a float); forecast recursively for as many steps. One window pass
    gives the lags, one grouped aggregate their means and covariances, from which
    column expressions solve the normal equations; only the held-out rows of an
    entity are gathered. Output is long: (key, METRIC, STEP, FORECAST, ACTUAL,
    N_OBS, RANK, STATUS). An entity whose series has a null or NaN, or fewer
    observations than parameters, comes back with that status and null forecasts.
    Where lags are collinear, RANK is less than the number of parameters, and a
    lag that those before it determine has coefficient 0.
    """
    k, m = len(cols), len(cols) * lags
    s = df.select(F.col(key).alias("_key"), F.col(order).alias("_order"), *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"_y_{j}") for j, c in enumerate(cols)])
    rows, n = Window.partitionBy("_key").orderBy("_order"), F.count(F.lit(1)).over(Window.partitionBy("_key"))
    held = F.floor(n * F.lit(holdout)) if isinstance(holdout, float) else F.lit(holdout)
    s = s.withColumns({
        "_pos": F.row_number().over(rows), "_train": (n - held).cast("long"),
        **{f"_x_{lag * k + j}": F.lag(f"_y_{j}", lag + 1).over(rows) for lag in range(lags) for j in range(k)},
    })
    row = F.array(*[F.col(f"_y_{j}") for j in range(k)])
    seen = F.array(*[F.col(f"_y_{j}") for j in range(k)], *[F.col(f"_x_{i}") for i in range(m - k)])  # newest row first
    used = F.col("_pos").between(lags + 1, F.col("_train"))
    x, y = [F.col(f"_x_{i}") for i in range(m)], [F.col(f"_y_{j}") for j in range(k)]
    g = s.groupBy("_key").agg(
        F.greatest(F.first("_train") - lags, F.lit(0)).alias("N_OBS"),
        F.max(F.array_contains(F.transform(row, lambda v: v.isNull()), True)).alias("_broken"),
        F.max_by(seen, F.when(F.col("_pos") == F.col("_train"), F.col("_pos"))).alias("_seen"),
        F.sort_array(F.collect_list(F.when(F.col("_pos") > F.col("_train"), F.struct("_pos", row.alias("row"))))).alias("_held"),
        *least_squares.moments(x, y, used),
    )
    fit = least_squares.solve(g, m, k)
    fitted = ~F.col("_broken") & (F.col("N_OBS") >= m + 1)
    equations = [
        F.struct(least_squares.constant(m, j).alias("constant"), F.array(*[F.col(f"_c_{i}_{j}") for i in range(m)]).alias("by_lag"))
        for j in range(k)
    ]

    def step(state: Column, _: Column) -> Column:  # every step goes on from the forecasts before it
        def ahead(eq: Column) -> Column:
            return F.aggregate(F.zip_with(eq["by_lag"], state["seen"], lambda c, v: c * v), eq["constant"], lambda a, b: a + b)

        following = F.transform(F.col("_equations"), ahead)
        return F.struct(F.slice(F.concat(following, state["seen"]), 1, m).alias("seen"), F.concat(state["ahead"], F.array(following)).alias("ahead"))

    start = F.struct(F.col("_seen").alias("seen"), F.array().cast("array<array<double>>").alias("ahead"))
    rank = F.lit(1).cast("long")
    for i in range(m):
        rank = rank + F.col(f"_use_{i}").cast("long")
    out = fit.withColumn("_equations", F.array(*equations)).select(
        "_key", "N_OBS", F.when(fitted, rank).alias("RANK"),
        F.when(F.col("_broken"), "null in the series").when(~fitted, "too short").otherwise("ok").alias("STATUS"),
        F.when(fitted, F.aggregate("_held", start, step)["ahead"]).alias("_ahead"),
        F.posexplode("_held").alias("_at", "_row"),
    )
    named = F.array(*[F.struct(F.lit(c).alias("METRIC"), F.get(F.get("_ahead", F.col("_at")), F.lit(j)).alias("FORECAST"), F.get(F.col("_row.row"), F.lit(j)).alias("ACTUAL")) for j, c in enumerate(cols)])
    long = out.select(F.col("_key").alias(key), (F.col("_at") + 1).cast("long").alias("STEP"), "N_OBS", "RANK", "STATUS", F.inline(named))
    return long.select(key, "METRIC", "STEP", "FORECAST", "ACTUAL", "N_OBS", "RANK", "STATUS")


def var_rmse(forecast: DataFrame, metric: str, key: str = "CODE") -> DataFrame:
    """(key, STEPS, RMSE) of one series over the held-out steps; entities without a forecast have a null."""
    own = forecast.where(F.col("METRIC") == metric)
    return own.groupBy(key).agg(F.count("FORECAST").alias("STEPS"), F.sqrt(F.avg(F.pow(F.col("FORECAST") - F.col("ACTUAL"), 2))).alias("RMSE"))


def model_vs_baseline(model: DataFrame, baseline: DataFrame, key: str = "CODE") -> DataFrame:
    """Join both per-entity RMSE tables and count how often the model wins."""
    j = model.select(key, F.col("RMSE").alias("_m")).join(baseline.select(key, F.col("RMSE").alias("_b")), key)
    return j.agg(
        F.count(F.lit(1)).alias("N_ENTITIES"),
        F.count(F.when(F.col("_b") > F.col("_m"), 1)).alias("MODEL_BETTER"),
    )
