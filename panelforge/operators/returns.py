"""Return operators (T1-T8) and period aggregates.

Scale notes
-----------
* Day-level windows are partitioned by ``(entity, period)`` (default the
  year), never by the entity alone. A daily series has at most 366 rows per
  (entity, year), so no window partition grows with history length, and a hot
  entity is spread over as many tasks as it has years. The one value that
  crosses a period boundary (the last price of the previous period) comes from
  a per-(entity, period) aggregate -- one row per group, computed with partial
  aggregation -- and is joined back on the same keys the window is already
  partitioned on.
* Period aggregates are one ``groupBy`` with ``min_by``/``max_by``/``stddev``:
  one scan, one exchange, map-side partial aggregation; no global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _carry_previous_period(df: DataFrame, key: str, period: str, time: str, value: str, name: str) -> DataFrame:
    """Per (key, period): the last ``value`` of the key's previous non-empty period."""
    last = df.groupBy(key, period).agg(F.max_by(value, time).alias("_last"))
    w = Window.partitionBy(key).orderBy(period)
    return last.select(key, period, F.lag("_last").over(w).alias(name))


def with_previous(df: DataFrame, key: str = "CODE", time: str = "DATE", value: str = "PRICE",
                  period: str | None = "YEAR", name: str = "_prev") -> DataFrame:
    """Add the previous row's ``value`` within ``key`` ordered by ``time``.

    With ``period`` set, the window runs per (key, period) and the first row of
    a period takes the carried value of the previous period (see module notes).
    Both read ``df``: a caller whose input is derived writes it first.
    """
    if period is None:
        return df.withColumn(name, F.lag(value).over(Window.partitionBy(key).orderBy(time)))
    w = Window.partitionBy(key, period).orderBy(time)
    carry = _carry_previous_period(df, key, period, time, value, "_carry")
    inner = df.withColumn("_lag", F.lag(value).over(w)).withColumn("_first", F.lag(time).over(w).isNull())
    return (
        inner.join(carry, [key, period], "left")
        .withColumn(name, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag")))
        .drop("_lag", "_first", "_carry")
    )


def daily_return(df: DataFrame, key: str = "CODE", time: str = "DATE", value: str = "PRICE",
                 out: str = "RETURNS", denominator: str = "previous", period: str | None = "YEAR") -> DataFrame:
    """``(p - prev) / prev`` (or ``/ p`` with ``denominator='current'``); first row null.

    A zero denominator gives null instead of an ANSI error.
    """
    if denominator not in ("previous", "current"):
        raise ValueError("denominator must be 'previous' or 'current'")
    with_prev = with_previous(df, key, time, value, period, "_prev")
    den = F.col("_prev") if denominator == "previous" else F.col(value)
    return with_prev.withColumn(out, F.try_divide(F.col(value) - F.col("_prev"), den)).drop("_prev")


def ytd_return(df: DataFrame, key: str = "CODE", time: str = "DATE", value: str = "PRICE",
               base: str | None = None, period: str = "YEAR", out: str = "CUMULATIVE_RETURNS",
               start_name: str = "PRICE_START") -> DataFrame:
    """``(value - first base of the period) / first base``.

    ``base`` defaults to ``value``; the index job uses the first OPEN as base
    with ADJ_CLOSE as the value. The window is per (key, period): bounded.
    """
    base = base or value
    w = Window.partitionBy(key, period).orderBy(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(start_name, F.first(base).over(w)).withColumn(
        out, F.try_divide(F.col(value) - F.col(start_name), F.col(start_name))
    )


def price_returns(df: DataFrame, key: str = "CODE", time: str = "DATE", value: str = "PRICE",
                  period: str = "YEAR", ytd_base: str | None = None, denominator: str = "previous") -> DataFrame:
    """Daily and year-to-date returns in one pass (the price and index jobs).

    Both windows share the partitioning (key, period) and ordering, so Spark
    plans a single exchange and a single sort for them. The windows and the last
    value of each period, which the next one begins with, both read ``df``: a
    file is scanned twice, a derived input should be written by the caller.
    """
    base = ytd_base or value
    w = Window.partitionBy(key, period).orderBy(time)
    wf = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = _carry_previous_period(df, key, period, time, value, "_carry")
    inner = (
        df.withColumn("_lag", F.lag(value).over(w))
        .withColumn("_first", F.lag(time).over(w).isNull())
        .withColumn("PRICE_START", F.first(base).over(wf))
    )
    prev = F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag"))
    den = prev if denominator == "previous" else F.col(value)
    return (
        inner.join(carry, [key, period], "left")
        .withColumn("RETURNS", F.try_divide(F.col(value) - prev, den))
        .withColumn("CUMULATIVE_RETURNS", F.try_divide(F.col(value) - F.col("PRICE_START"), F.col("PRICE_START")))
        .drop("_lag", "_first", "_carry")
    )


def period_summary(df: DataFrame, keys: tuple[str, ...] = ("YEAR", "CODE"), time: str = "DATE",
                   value: str = "PRICE") -> DataFrame:
    """A1-A3 + T5 in one aggregate: PRICE_START, PRICE_END, RISK (sample std), RETURNS."""
    return (
        df.groupBy(*keys)
        .agg(
            F.min_by(value, time).alias("PRICE_START"),
            F.max_by(value, time).alias("PRICE_END"),
            F.stddev_samp(value).alias("RISK"),
        )
        .withColumn("RETURNS", F.try_divide(F.col("PRICE_END") - F.col("PRICE_START"), F.col("PRICE_START")))
    )


def yearly_risk(df: DataFrame, keys: tuple[str, ...] = ("YEAR", "CODE"), value: str = "PRICE") -> DataFrame:
    """A1: sample standard deviation per (YEAR, CODE); null for a single row."""
    return df.groupBy(*keys).agg(F.stddev_samp(value).alias("RISK"))


def ohlc(df: DataFrame, keys: tuple[str, ...], time: str, value: str) -> DataFrame:
    """A4 + T6: OPEN first, HIGH max, LOW min, CLOSE last per group, and (CLOSE-OPEN)/OPEN."""
    return (
        df.groupBy(*keys)
        .agg(
            F.min_by(value, time).alias("OPEN"),
            F.max(value).alias("HIGH"),
            F.min(value).alias("LOW"),
            F.max_by(value, time).alias("CLOSE"),
        )
        .withColumn("RETURNS", F.try_divide(F.col("CLOSE") - F.col("OPEN"), F.col("OPEN")))
    )


def monthly_ohlc(df: DataFrame, key: str = "CODE", time: str = "DATE", value: str = "PRICE") -> DataFrame:
    """Monthly OHLC and monthly return of a daily series."""
    return ohlc(df.withColumn("MONTH", F.month(time)), (key, "YEAR", "MONTH"), time, value)


# Fixed values of the quarter-boundary rule: the start is searched on days 1..29
# of the month two months before the quarter's last month, the end on days
# 30..2 of that last month, or 31..2 when it is March or December.
START_FIRST_DAY, START_LAST_DAY = 1, 29
END_FIRST_DAY, END_LAST_DAY, END_LAST_DAY_LONG = 2, 30, 31
LONG_END_MONTHS = (3, 12)


def month_boundary_prices(df: DataFrame, key: str = "CODE", time: str = "DATE",
                          start_value: str = "PRICE", end_value: str = "PRICE") -> DataFrame:
    """Per (key, year, month): first non-zero ``start_value`` on the start days and
    last non-zero ``end_value`` on the end days of the quarter rule (J9)."""
    day, month = F.dayofmonth(time), F.month(time)
    start_ok = day.between(START_FIRST_DAY, START_LAST_DAY) & (F.col(start_value) != 0)
    last_day = F.when(month.isin(*LONG_END_MONTHS), END_LAST_DAY_LONG).otherwise(END_LAST_DAY)
    end_ok = (day >= END_FIRST_DAY) & (day <= last_day) & (F.col(end_value) != 0)
    return df.groupBy(key, F.year(time).alias("_Y"), month.alias("_M")).agg(
        F.min_by(F.col(start_value), F.when(start_ok, F.col(time))).alias("_start"),
        F.max_by(F.col(end_value), F.when(end_ok, F.col(time))).alias("_end"),
    )


def quarterly_return(quarters: DataFrame, prices: DataFrame, key: str = "CODE", fiscal: str = "FISCAL_YEAR",
                     time: str = "DATE", start_value: str = "PRICE", end_value: str = "PRICE",
                     prefix: str = "") -> DataFrame:
    """Return between the quarter's boundary prices for every (key, fiscal 'yyyy-MM') row.

    No start price -> start 0 and return 0; no end price -> end 0 and return -1.
    Quarters ending in January or February have no start month and give 0.
    The per-month boundary table has one row per (key, month); each of its rows
    is the end of its own month's quarter and the start of the quarter two months
    on, so that one table and one equi-join on (key, year, month) serve both.
    """
    b = month_boundary_prices(prices, key, time, start_value, end_value)
    none = F.lit(None).cast("double")
    sides = F.array(
        F.struct(F.col("_M").alias("_m"), none.alias("_s"), F.col("_end").cast("double").alias("_e")),
        F.struct((F.col("_M") + 2).alias("_m"), F.col("_start").cast("double").alias("_s"), none.alias("_e")),
    )
    bounds = b.select(F.col(key).alias("_k"), F.col("_Y").alias("_y"), F.inline(sides)).groupBy("_k", "_y", "_m").agg(F.max("_s").alias("_start"), F.max("_e").alias("_end"))
    q = quarters.withColumn("_Y", F.substring(fiscal, 1, 4).try_cast("int")).withColumn(
        "_M", F.substring(fiscal, 6, 2).try_cast("int")
    )
    j = q.join(bounds, (q[key] == bounds._k) & (q._Y == bounds._y) & (q._M == bounds._m), "left")
    ini = F.coalesce(F.col("_start"), F.lit(0.0))
    fin = F.coalesce(F.col("_end"), F.lit(0.0))
    ret = F.when(ini == 0, F.lit(0.0)).otherwise((fin - ini) / ini)
    return j.withColumn(f"{prefix}PRICE_INI", ini).withColumn(f"{prefix}PRICE_FIN", fin).withColumn(
        f"{prefix}RETURNS", ret
    ).drop("_Y", "_M", "_k", "_y", "_m", "_start", "_end")


def rolling_sum(df: DataFrame, n: int, key: str = "CODE", time: str = "DATE", value: str = "PRICE",
                out: str | None = None, period: str | None = "YEAR") -> DataFrame:
    """Trailing sum over the current and ``n - 1`` previous rows of the entity.

    With ``period`` the window runs per (key, period) like the return
    operators. The rows a window needs from earlier periods -- the last
    ``n - 1`` values before the period starts -- are taken from per-period
    tails (the last ``n - 1`` rows of each (key, period), selected with a
    ``row_number`` limit that Spark applies per task before the shuffle, so a
    hot group never travels whole), gathered over the previous ``n - 1``
    non-empty periods, and added as ghost rows that are dropped after the sum.
    """
    out = out or f"{value}_SUM{n}"
    if period is None or n <= 1:
        w = Window.partitionBy(key).orderBy(time).rowsBetween(-(n - 1), 0)
        return df.withColumn(out, F.sum(value).over(w))
    k = n - 1
    last_k = Window.partitionBy(key, period).orderBy(F.col(time).desc())
    tail_rows = df.select(key, period, time, value).withColumn("_rk", F.row_number().over(last_k)).where(F.col("_rk") <= k)
    tails = tail_rows.groupBy(key, period).agg(
        F.array_sort(F.collect_list(F.struct(F.col(time).alias("t"), F.col(value).alias("v")))).alias("_tail")
    )
    wp = Window.partitionBy(key).orderBy(period).rowsBetween(-k, -1)
    prev = F.array_sort(F.flatten(F.collect_list("_tail").over(wp)))
    carry = tails.select(key, period, prev.alias("_prev")).select(
        key, period, F.slice("_prev", F.greatest(F.size("_prev") - k + 1, F.lit(1)), k).alias("_prev")
    )
    ghosts = carry.select(key, period, F.explode("_prev").alias("_g")).select(
        key, period, F.col("_g.t").alias(time), F.col("_g.v").alias(value), F.lit(True).alias("_ghost")
    )
    rows = df.withColumn("_ghost", F.lit(False)).unionByName(ghosts, allowMissingColumns=True)
    w = Window.partitionBy(key, period).orderBy(time).rowsBetween(-k, 0)
    return rows.withColumn(out, F.sum(value).over(w)).where(~F.col("_ghost")).drop("_ghost")
