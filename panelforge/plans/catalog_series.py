"""Queries: supervised framing, interpolation, scaling, persistence, AR/VAR."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import labels as L
from panelforge.operators import series as S
from panelforge.operators import returns as T
from panelforge.plans import oracle as O
from panelforge.plans.catalog import Tables, register, rounded
from panelforge.session import write_once
from panelforge.plans.catalog_outliers import _panel
from panelforge.operators.sectors import sector_pairs, sector_values_sql

SUPERVISED = ["RETURNS", "CSR__ROC_JOEL_GREENBLATT", "VR__EV_TO_EBIT"]


def _sup_sql(n_in: int, n_out: int) -> str:
    shifted = {S.supervised_name(j, at): f"lead({c}, {at}) OVER w" for at in range(-n_in, n_out) for j, c in enumerate(SUPERVISED, 1)}
    columns = ", ".join(f'{value} AS "{name}"' for name, value in shifted.items())
    known = " AND ".join(f'"{name}" IS NOT NULL' for name in shifted)
    return f"SELECT * FROM (SELECT CODE, YEAR, {columns} FROM opanel WINDOW w AS (PARTITION BY CODE ORDER BY YEAR)) t WHERE {known}"


@register("series_to_supervised", _sup_sql(1, 1), ["opanel"])
def series_to_supervised(spark, base):
    return S.series_to_supervised(_panel(spark, base), SUPERVISED, n_in=1, n_out=1)


@register("series_to_supervised_2_2", _sup_sql(2, 2), ["opanel"])
def series_to_supervised_2_2(spark, base):
    return S.series_to_supervised(_panel(spark, base), SUPERVISED, n_in=2, n_out=2)


@register(
    "lag_dataset",
    "SELECT CODE, YEAR, RETURNS, lag(RETURNS, 1) OVER (PARTITION BY CODE ORDER BY YEAR) AS RETURNS_LAG1 FROM opanel",
    ["opanel"],
)
def lag_dataset(spark, base):
    return L.lag_value(_panel(spark, base).select("CODE", "YEAR", "RETURNS"), "RETURNS")


O.cte(
    "events_daily",
    "SELECT user_id, CAST(ts AS DATE) AS DAY, arg_max(value, ts) AS CLOSE FROM events GROUP BY 1, 2",
)


@register(
    "linear_interpolation",
    """
SELECT user_id, DAY, CLOSE FROM (
  SELECT user_id, DAY, coalesce(CLOSE, v0 + (v1 - v0) * (p - p0) / NULLIF(p1 - p0, 0), v0) AS CLOSE FROM (
    SELECT *,
      last_value(CLOSE IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN CLOSE IS NOT NULL THEN p END IGNORE NULLS) OVER b AS p0,
      first_value(CLOSE IGNORE NULLS) OVER f AS v1, first_value(CASE WHEN CLOSE IS NOT NULL THEN p END IGNORE NULLS) OVER f AS p1
    FROM (SELECT g.user_id, g.DAY, d.CLOSE, row_number() OVER (PARTITION BY g.user_id ORDER BY g.DAY) AS p
          FROM (SELECT user_id, CAST(unnest(generate_series(min(DAY), max(DAY), INTERVAL 1 DAY)) AS DATE) AS DAY
                FROM events_daily GROUP BY user_id) g
          LEFT JOIN events_daily d USING (user_id, DAY)) x
    WINDOW b AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           f AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) y) z
WHERE CLOSE IS NOT NULL
""",
    ["events_daily"],
)
def linear_interpolation(spark, base):
    ev = Tables(spark, base).raw("events").withColumn("DAY", F.to_date("ts"))
    daily = T.ohlc(ev, ("user_id", "DAY"), "ts", "value").select("user_id", "DAY", "CLOSE")
    return S.linear_interpolation(S.calendar_fill(daily, "user_id", "DAY"), ["CLOSE"], "user_id", "DAY")


SCALED = ["RETURNS", "CSR__ROC_JOEL_GREENBLATT", "VR__EV_TO_EBIT"]


@register(
    "standard_scale_by_year",
    "SELECT YEAR, CODE, "
    + ", ".join(f"round(({c} - avg({c}) OVER y) / NULLIF(stddev_pop({c}) OVER y, 0), 6) AS {c}_Z" for c in SCALED)
    + " FROM opanel WINDOW y AS (PARTITION BY YEAR)",
    ["opanel"],
)
def standard_scale_by_year(spark, base):
    z = S.standard_scale(_panel(spark, base), SCALED, suffix="_Z").select("YEAR", "CODE", *[c + "_Z" for c in SCALED])
    return rounded(z, [c + "_Z" for c in SCALED])


@register(
    "min_max_scale",
    "SELECT YEAR, CODE, "
    + ", ".join(f"{c}, m.{c}_MIN, m.{c}_MAX, ({c} - m.{c}_MIN) / NULLIF(m.{c}_MAX - m.{c}_MIN, 0) AS {c}_SCALED" for c in SCALED)
    + " FROM opanel, (SELECT " + ", ".join(f"min({c}) AS {c}_MIN, max({c}) AS {c}_MAX" for c in SCALED) + " FROM opanel) m",
    ["opanel"],
)
def min_max_scale(spark, base):
    p = _panel(spark, base).select("YEAR", "CODE", *SCALED)
    return S.min_max_scale(p, SCALED)


def _persist_sql(f: float) -> str:
    limit = "1" if f == 1 else f"floor(n * {f})"
    return f"""
SELECT CODE, max(n) AS N, arg_max(prev, pos) AS PREDICTION,
       round(sqrt(avg(CASE WHEN pos > n - {limit} THEN (RETURNS - prev) ^ 2 END)), 6) AS RMSE
FROM (SELECT CODE, YEAR, RETURNS, row_number() OVER w AS pos, count(*) OVER (PARTITION BY CODE) AS n,
             lag(RETURNS) OVER w AS prev
      FROM opanel WINDOW w AS (PARTITION BY CODE ORDER BY YEAR)) t
GROUP BY CODE
"""


@register("persistence_rmse", _persist_sql(1), ["opanel"])
def persistence_rmse(spark, base):
    return rounded(S.persistence_rmse(_panel(spark, base), "RETURNS", test_fraction=1.0), ["RMSE"])


@register("persistence_rmse_split", _persist_sql(0.6), ["opanel"])
def persistence_rmse_split(spark, base):
    return rounded(S.persistence_rmse(_panel(spark, base), "RETURNS", test_fraction=0.6), ["RMSE"])


O.cte(
    "ar1",
    """
SELECT CODE, regr_slope(y, x) AS SLOPE, regr_intercept(y, x) AS INTERCEPT,
       arg_max(RETURNS, CASE WHEN pos <= n - 1 THEN pos END) AS last_train,
       arg_max(RETURNS, CASE WHEN pos = n THEN pos END) AS ACTUAL
FROM (SELECT *, CASE WHEN pos <= n - 1 AND prev IS NOT NULL THEN RETURNS END AS y,
                CASE WHEN pos <= n - 1 AND prev IS NOT NULL THEN prev END AS x
      FROM (SELECT CODE, YEAR, RETURNS, row_number() OVER w AS pos, count(*) OVER (PARTITION BY CODE) AS n,
                   lag(RETURNS) OVER w AS prev
            FROM opanel WINDOW w AS (PARTITION BY CODE ORDER BY YEAR)) a) b
GROUP BY CODE
""",
    ("opanel",),
)


@register(
    "ar1_forecast",
    """
SELECT CODE, round(SLOPE, 6) AS SLOPE, round(INTERCEPT, 6) AS INTERCEPT, ACTUAL,
       round(INTERCEPT + SLOPE * last_train, 6) AS FORECAST, round(abs(ACTUAL - (INTERCEPT + SLOPE * last_train)), 6) AS RMSE
FROM ar1
""",
    ["ar1"],
)
def ar1_forecast(spark, base):
    a = S.ar1_forecast(_panel(spark, base), "RETURNS")
    return rounded(a, ["SLOPE", "INTERCEPT", "FORECAST", "RMSE"])


@register(
    "model_vs_baseline",
    """
SELECT count(*) AS N_ENTITIES, count(CASE WHEN b.RMSE > m.RMSE THEN 1 END) AS MODEL_BETTER
FROM (SELECT CODE, round(abs(ACTUAL - (INTERCEPT + SLOPE * last_train)), 6) AS RMSE FROM ar1) m
JOIN (SELECT CODE, RMSE FROM (""" + _persist_sql(1) + """) p) b USING (CODE)
""",
    ["ar1", "opanel"],
)
def model_vs_baseline(spark, base):
    p = _panel(spark, base)
    model = rounded(S.ar1_forecast(p, "RETURNS"), ["RMSE"])
    baseline = rounded(S.persistence_rmse(p, "RETURNS", test_fraction=1.0), ["RMSE"])
    return S.model_vs_baseline(model, baseline)


VAR_COLS = ["RETURNS", "CSR__ROC_JOEL_GREENBLATT", "VR__EV_TO_EBIT"]


def _determinant(rows: list[list[str]]) -> str:
    """SQL of a determinant, expanded along the first row."""
    if len(rows) == 1:
        return rows[0][0]
    terms = [f"{'-' if c % 2 else '+'} {rows[0][c]} * ({_determinant([r[:c] + r[c + 1 :] for r in rows[1:]])})" for c in range(len(rows))]
    return " ".join(terms)


def _var_sql(source: str, cols: list[str], key: str, held: str) -> str:
    """VAR(1) by Cramer's rule over the covariances; the held-out steps by a recursive query."""
    k = range(len(cols))
    lagged = ", ".join(f"lag({c}) OVER w AS x{i}, {c} AS y{i}" for i, c in enumerate(cols))
    used = "FILTER (pos BETWEEN 2 AND n - held)"
    moments = [f"avg(x{i}) {used} AS mx{i}, avg(y{i}) {used} AS my{i}" for i in k]
    moments += [f"covar_pop(x{h}, x{i}) {used} AS s{i}{h}, covar_pop(y{h}, x{i}) {used} AS t{i}{h}" for i in k for h in k]
    square = [[f"s{i}{h}" for h in k] for i in k]
    solved = [
        f"({_determinant([[f't{r}{j}' if c == i else square[r][c] for c in k] for r in k])}) / NULLIF({_determinant(square)}, 0) AS c{i}{j}"
        for i in k for j in k
    ]
    ahead = ", ".join("my{j} + ".format(j=j) + " + ".join(f"c{i}{j} * (f{i} - mx{i})" for i in k) + f" AS f{j}" for j in k)
    metrics = " UNION ALL ".join(
        f"SELECT {key}, '{c}' AS METRIC, pos - (n - held) AS STEP, f{i} AS FORECAST, y{i} AS ACTUAL, N_OBS, RANK, STATUS FROM steps" for i, c in enumerate(cols)
    )
    return f"""(
WITH RECURSIVE obs AS MATERIALIZED (
  SELECT {key}, {lagged}, row_number() OVER w AS pos, count(*) OVER (PARTITION BY {key}) AS n,
         CAST({held.format(n=f'count(*) OVER (PARTITION BY {key})')} AS BIGINT) AS held
  FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY YEAR)),
moments AS (SELECT {key}, greatest(any_value(n - held) - 1, 0) AS N_OBS, bool_or({' OR '.join(f'y{i} IS NULL' for i in k)}) AS broken, {', '.join(moments)}
            FROM obs GROUP BY {key}),
fit AS MATERIALIZED (SELECT *, {', '.join(solved)}, NOT broken AND N_OBS >= {len(cols) + 1} AS fitted FROM moments),
ahead AS (
  SELECT {key}, pos, {', '.join(f'CASE WHEN fitted THEN y{i} END AS f{i}' for i in k)} FROM obs JOIN fit USING ({key}) WHERE pos = n - held
  UNION ALL
  SELECT a.{key}, a.pos + 1 AS pos, {ahead} FROM ahead a JOIN fit USING ({key}) JOIN (SELECT {key}, any_value(n) AS n FROM obs GROUP BY {key}) e USING ({key})
  WHERE a.pos < e.n),
steps AS (
  SELECT o.*, f.N_OBS, CASE WHEN fitted THEN CAST({len(cols) + 1} AS BIGINT) END AS RANK, {', '.join(f'f{i}' for i in k)},
         CASE WHEN broken THEN 'null in the series' WHEN NOT fitted THEN 'too short' ELSE 'ok' END AS STATUS
  FROM obs o JOIN fit f USING ({key}) LEFT JOIN ahead a USING ({key}, pos) WHERE pos > n - held)
{metrics})"""


_VAR_SELECT = "METRIC, STEP, round(FORECAST, 6) AS FORECAST, round(ACTUAL, 9) AS ACTUAL, N_OBS, RANK, STATUS"


def _var_rounded(forecast):
    return rounded(rounded(forecast, ["FORECAST"], 6), ["ACTUAL"], 9)


@register("var1_forecast", f"SELECT CODE, {_VAR_SELECT} FROM {_var_sql('opanel', VAR_COLS, 'CODE', '1')}", ["opanel"])
def var1_forecast(spark, base):
    """Multivariate VAR(1) per company, the last year held out."""
    return _var_rounded(S.var_forecast(_panel(spark, base), VAR_COLS, "CODE", "YEAR", lags=1, holdout=1))


def _sector_series(spark, base):
    """(SECTOR, YEAR, RETURNS, ROC): industry mapped to its sector (fixed hierarchy, then
    nation -> region for the test data), averaged to one row per sector and year."""
    t = Tables(spark, base)
    fixed = spark.createDataFrame(sector_pairs(), "FROM string, TO string")
    nat = t.raw("nation").join(t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    mapping = fixed.unionByName(nat.select(F.col("n_name").alias("FROM"), F.col("r_name").alias("TO")))
    p = _panel(spark, base).join(t.companies.select("CODE", "INDUSTRY01"), "CODE")
    p = L.map_categories(p, mapping, "INDUSTRY01", "SECTOR")
    return p.groupBy("SECTOR", "YEAR").agg(F.avg("RETURNS").alias("RETURNS"),
                                           F.avg("CSR__ROC_JOEL_GREENBLATT").alias("CSR__ROC_JOEL_GREENBLATT"))


@register(
    "var1_multi_step_rmse",
    f"""
SELECT CODE, count(FORECAST) AS STEPS, round(sqrt(avg((FORECAST - ACTUAL) ^ 2)), 6) AS RMSE
FROM {_var_sql('opanel', VAR_COLS, 'CODE', 'floor({n} * 0.2)')} WHERE METRIC = 'RETURNS' GROUP BY CODE
""",
    ["opanel"],
)
def var1_multi_step_rmse(spark, base):
    """VAR(1) fitted on the first 80 % of each company's years, forecast recursively over the rest; RMSE of the returns."""
    return rounded(S.var_rmse(S.var_forecast(_panel(spark, base), VAR_COLS, holdout=0.2), "RETURNS"), ["RMSE"])


@register(
    "var_vs_baseline",
    f"""
SELECT count(*) AS N_ENTITIES, count(CASE WHEN b.RMSE > m.RMSE THEN 1 END) AS MODEL_BETTER
FROM (SELECT CODE, round(abs(FORECAST - ACTUAL), 6) AS RMSE FROM {_var_sql('opanel', VAR_COLS, 'CODE', '1')}
      WHERE METRIC = 'RETURNS' AND FORECAST IS NOT NULL) m
JOIN (SELECT CODE, RMSE FROM ({_persist_sql(1)}) p) b USING (CODE)
""",
    ["opanel"],
)
def var_vs_baseline(spark, base):
    """How often the VAR beats persistence on the last year."""
    p = write_once(_panel(spark, base), "var-panel")
    model = rounded(S.var_rmse(S.var_forecast(p, VAR_COLS), "RETURNS").where("RMSE is not null"), ["RMSE"])
    return S.model_vs_baseline(model, rounded(S.persistence_rmse(p, "RETURNS", test_fraction=1.0), ["RMSE"]))


O.cte(
    "sector_series",
    f"""
SELECT SECTOR, YEAR, avg(RETURNS) AS RETURNS, avg(CSR__ROC_JOEL_GREENBLATT) AS CSR__ROC_JOEL_GREENBLATT FROM (
  SELECT coalesce(m.TO_, c.INDUSTRY01) AS SECTOR, o.YEAR, o.RETURNS, o.CSR__ROC_JOEL_GREENBLATT
  FROM opanel o JOIN companies c USING (CODE)
  LEFT JOIN (SELECT * FROM (VALUES {sector_values_sql()}) v(FROM_, TO_)
             UNION ALL SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) m
  ON c.INDUSTRY01 = m.FROM_) s
GROUP BY SECTOR, YEAR
""",
    ("opanel", "companies"),
)


@register(
    "var1_forecast_by_sector",
    f"SELECT SECTOR, {_VAR_SELECT} FROM {_var_sql('sector_series', VAR_COLS[:2], 'SECTOR', '1')}",
    ["sector_series"],
)
def var1_forecast_by_sector(spark, base):
    """VAR(1) per sector on the sector-year averages (one row per sector and year)."""
    return _var_rounded(S.var_forecast(_sector_series(spark, base), VAR_COLS[:2], "SECTOR", "YEAR", lags=1, holdout=1))


@register(
    "persistence_rmse_by_sector",
    """
SELECT SECTOR, max(n) AS N, round(arg_max(prev, pos), 9) AS PREDICTION,
       round(sqrt(avg(CASE WHEN pos > n - 1 THEN (RETURNS - prev) ^ 2 END)), 6) AS RMSE
FROM (SELECT SECTOR, YEAR, RETURNS, row_number() OVER w AS pos, count(*) OVER (PARTITION BY SECTOR) AS n,
             lag(RETURNS) OVER w AS prev
      FROM sector_series WINDOW w AS (PARTITION BY SECTOR ORDER BY YEAR)) t
GROUP BY SECTOR
""",
    ["sector_series"],
)
def persistence_rmse_by_sector(spark, base):
    """Persistence baseline per sector series (the per-industry view)."""
    r = S.persistence_rmse(_sector_series(spark, base), "RETURNS", key="SECTOR", test_fraction=1.0)
    return rounded(rounded(r, ["PREDICTION"], 9), ["RMSE"], 6)


@register(
    "min_max_inverse",
    "SELECT YEAR, CODE, round(RETURNS, 9) AS RETURNS FROM opanel",
    ["opanel"],
)
def min_max_inverse(spark, base):
    """Scaled to [0, 1] and back."""
    p = _panel(spark, base).select("YEAR", "CODE", "RETURNS")
    back = S.min_max_inverse(S.min_max_scale(p, ["RETURNS"]), "RETURNS", "RETURNS_SCALED", "BACK")
    return rounded(back.select("YEAR", "CODE", F.col("BACK").alias("RETURNS")), ["RETURNS"], 9)
