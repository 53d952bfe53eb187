"""Queries: yearly dataset, ranks, labels, top-N."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import labels as L
from panelforge.operators import ranks as R
from panelforge.operators.sectors import sector_pairs, sector_values_sql
from panelforge.plans import oracle as O
from panelforge.plans import pipelines as P
from panelforge.plans.catalog import Tables, register, rounded

_RATIOS = ", ".join(P.RATIO_COLUMNS)
_EXTRA = "VQ_MARKET_CAP, IS_EPS_BASIC, VR_PE_RATIO"

O.cte(
    "fund",
    f"SELECT CODE, try_cast(substr(FISCAL_YEAR, 1, 4) AS INTEGER) AS YEAR, {_RATIOS}, {_EXTRA} FROM financials",
    ("financials",),
)
O.cte(
    "fund_final",
    f"SELECT CODE, try_cast(substr(FISCAL_YEAR, 1, 4) AS INTEGER) AS YEAR, {_RATIOS} FROM financials WHERE PRELIMINARY <> 1",
    ("financials",),
)
O.cte(
    "index_yearly",
    """
SELECT YEAR, (arg_max(CLOSE, DATE) - arg_min(OPEN, DATE)) / NULLIF(arg_min(OPEN, DATE), 0) AS INDEX_RETURNS
FROM index_values GROUP BY YEAR
""",
    ("index_values",),
)
O.cte(
    "panel",
    """
SELECT *,
  lead(RETURNS) OVER w AS RETURNS_NEXT,
  lead(INDEX_RETURNS) OVER w AS INDEX_RETURNS_NEXT,
  CASE WHEN RETURNS > 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS RETURNS_CAT,
  CASE WHEN lead(RETURNS) OVER w > 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS RETURNS_NEXT_CAT,
  CASE WHEN RETURNS > INDEX_RETURNS THEN 'WINS' ELSE 'LOSES' END AS RETURNS_vs_INDEX,
  CASE WHEN lead(RETURNS) OVER w > lead(INDEX_RETURNS) OVER w THEN 'WINS' ELSE 'LOSES' END AS RETURNS_vs_INDEX_NEXT
FROM (SELECT f.*, y.PRICE_START, y.PRICE_END, y.RISK, y.RETURNS, i.INDEX_RETURNS
      FROM fund f JOIN yearly_prices y USING (YEAR, CODE) LEFT JOIN index_yearly i USING (YEAR)) b
WINDOW w AS (PARTITION BY CODE ORDER BY YEAR)
""",
    ("fund", "yearly_prices", "index_yearly"),
)


def _rank_sql(col: str, desc: bool = False, name: str | None = None) -> str:
    order = f"{col} DESC NULLS LAST" if desc else f"{col} ASC NULLS FIRST"
    return f"CAST(row_number() OVER (PARTITION BY YEAR ORDER BY {order}, CODE) AS INTEGER) AS {name or col + '_RANKING'}"


def _yearly_dataset_sql(fund: str) -> str:
    ranks = ",\n  ".join(_rank_sql(c) for c in P.RANKED_COLUMNS + ["TARGET"])
    return f"""
SELECT t.* REPLACE (round(RISK, 6) AS RISK),
  {ranks},
  c.INDUSTRY01, c.INDUSTRY02
FROM (SELECT b.*, lead(RETURNS) OVER (PARTITION BY CODE ORDER BY YEAR) AS TARGET
      FROM (SELECT f.*, y.PRICE_START, y.PRICE_END, y.RISK, y.RETURNS
            FROM {fund} f JOIN yearly_prices y USING (YEAR, CODE)) b) t
JOIN companies c USING (CODE)
"""


@register("yearly_dataset", _yearly_dataset_sql("(SELECT * EXCLUDE (VQ_MARKET_CAP, IS_EPS_BASIC, VR_PE_RATIO) FROM fund)"),
          ["fund", "yearly_prices", "companies"])
def yearly_dataset(spark, base):
    t = Tables(spark, base)
    return rounded(P.yearly_dataset(t.financials, t.price, t.companies, include_preliminary=True), ["RISK"])


@register("yearly_dataset_no_preliminary", _yearly_dataset_sql("fund_final"), ["fund_final", "yearly_prices", "companies"])
def yearly_dataset_no_preliminary(spark, base):
    t = Tables(spark, base)
    return rounded(P.yearly_dataset(t.financials, t.price, t.companies, include_preliminary=False), ["RISK"])


_GB = """
SELECT CODE, YEAR, CSR__ROC_JOEL_GREENBLATT AS ROC, VR__EV_TO_EBIT AS EV_TO_EBIT, VQ_MARKET_CAP AS CAP,
       IS_EPS_BASIC AS EPS, IS__REVENUE AS REVENUE, VR_PE_RATIO AS PER, VQ__PIOTROSKI_F_SCORE AS PIOTROSKI
FROM fund WHERE CSR__ROC_JOEL_GREENBLATT > 0 AND VR__EV_TO_EBIT > 0
"""
O.cte(
    "greenblatt",
    f"""
SELECT g.*, y.PRICE_START, y.PRICE_END, y.RISK, y.RETURNS,
  {_rank_sql('ROC', True, 'ROC_RANKING')},
  {_rank_sql('EV_TO_EBIT', False, 'EBIT_RANKING')}
FROM ({_GB}) g JOIN yearly_prices y USING (YEAR, CODE)
""",
    ("fund", "yearly_prices"),
)


@register("greenblatt_metrics", "SELECT * REPLACE (round(RISK, 6) AS RISK) FROM greenblatt", ["greenblatt"])
def greenblatt_metrics(spark, base):
    t = Tables(spark, base)
    return rounded(P.greenblatt_metrics(t.financials, t.price), ["RISK"])


@register(
    "greenblatt_top20",
    """
SELECT t.* REPLACE (round(RISK, 6) AS RISK), c.COMPANY, c.REGION, c.INDUSTRY01 FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY YEAR ORDER BY SCORE, CODE) AS INTEGER) AS RANKING
  FROM (SELECT *, ROC_RANKING + EBIT_RANKING AS SCORE FROM greenblatt) s
  QUALIFY row_number() OVER (PARTITION BY YEAR ORDER BY SCORE, CODE) <= 20) t
JOIN companies c USING (CODE)
""",
    ["greenblatt", "companies"],
)
def greenblatt_top20(spark, base):
    t = Tables(spark, base)
    return rounded(P.greenblatt_top_n(t.financials, t.price, t.companies, 20), ["RISK"])


@register(
    "metric_row_ranks",
    """
SELECT YEAR, CODE, METRIC, VALUE,
  CAST(row_number() OVER (PARTITION BY YEAR, METRIC ORDER BY VALUE ASC NULLS FIRST, CODE) AS INTEGER) AS RANKING
FROM (SELECT YEAR, CODE, """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in P.RANKED_COLUMNS) + """ FROM fund) s
UNPIVOT INCLUDE NULLS (VALUE FOR METRIC IN (""" + ", ".join(P.RANKED_COLUMNS) + """))
""",
    ["fund"],
)
def metric_row_ranks(spark, base):
    f = P.fundamentals(Tables(spark, base).financials)
    return R.row_rank_long(f, P.RANKED_COLUMNS)


@register(
    "metric_dense_ranks",
    """
SELECT YEAR, CODE, CSR__ROC_JOEL_GREENBLATT, VR__EV_TO_EBIT, RETURNS,
  CASE WHEN CSR__ROC_JOEL_GREENBLATT IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY YEAR ORDER BY CSR__ROC_JOEL_GREENBLATT DESC NULLS LAST) AS INTEGER) END AS ROC_RANK,
  CASE WHEN VR__EV_TO_EBIT IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY YEAR ORDER BY VR__EV_TO_EBIT ASC NULLS LAST) AS INTEGER) END AS EBIT_RANK,
  CASE WHEN RETURNS IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY YEAR ORDER BY RETURNS DESC NULLS LAST) AS INTEGER) END AS RETURNS_RANK
FROM (SELECT f.YEAR, f.CODE, f.CSR__ROC_JOEL_GREENBLATT, f.VR__EV_TO_EBIT, y.RETURNS FROM fund f JOIN yearly_prices y USING (YEAR, CODE)) b
""",
    ["fund", "yearly_prices"],
)
def metric_dense_ranks(spark, base):
    t = Tables(spark, base)
    b = P.fundamentals(t.financials, True, ["CSR__ROC_JOEL_GREENBLATT", "VR__EV_TO_EBIT"]).join(
        P.yearly_prices(t.price).select("YEAR", "CODE", "RETURNS"), ["YEAR", "CODE"]
    )
    b = R.dense_rank_by(b, "CSR__ROC_JOEL_GREENBLATT", ascending=False, out="ROC_RANK")
    b = R.dense_rank_by(b, "VR__EV_TO_EBIT", ascending=True, out="EBIT_RANK")
    return R.dense_rank_by(b, "RETURNS", ascending=False, out="RETURNS_RANK")


@register(
    "next_return_label",
    """
SELECT YEAR, CODE, RETURNS, lead(RETURNS) OVER w AS TARGET,
  CASE WHEN lead(YEAR) OVER w = YEAR + 1 THEN lead(RETURNS) OVER w END AS TARGET_STRICT
FROM yearly_prices WINDOW w AS (PARTITION BY CODE ORDER BY YEAR)
""",
    ["yearly_prices"],
)
def next_return_label(spark, base):
    y = P.yearly_prices(Tables(spark, base).price_sparse).select("YEAR", "CODE", "RETURNS")
    y = L.lead_value(y, "RETURNS", "CODE", "YEAR", "TARGET")
    return L.lead_value(y, "RETURNS", "CODE", "YEAR", "TARGET_STRICT", strict=True)


# price_sparse has year gaps: the label must bridge them (TARGET) or not (TARGET_STRICT).
ORACLE_SPARSE_NEXT = O.sql(
    """
SELECT YEAR, CODE, RETURNS, lead(RETURNS) OVER w AS TARGET,
  CASE WHEN lead(YEAR) OVER w = YEAR + 1 THEN lead(RETURNS) OVER w END AS TARGET_STRICT
FROM (SELECT YEAR, CODE, (arg_max(PRICE, DATE) - arg_min(PRICE, DATE)) / NULLIF(arg_min(PRICE, DATE), 0) AS RETURNS
      FROM price_sparse GROUP BY YEAR, CODE) y
WINDOW w AS (PARTITION BY CODE ORDER BY YEAR)
""",
    ("price_sparse",),
)
from panelforge.plans.catalog import ORACLE  # noqa: E402

ORACLE["next_return_label"] = ORACLE_SPARSE_NEXT


@register(
    "target_rank",
    """
SELECT YEAR, CODE, RETURNS, TARGET, """ + _rank_sql("TARGET") + """
FROM (SELECT YEAR, CODE, RETURNS, lead(RETURNS) OVER (PARTITION BY CODE ORDER BY YEAR) AS TARGET FROM yearly_prices) t
""",
    ["yearly_prices"],
)
def target_rank(spark, base):
    y = P.yearly_prices(Tables(spark, base).price).select("YEAR", "CODE", "RETURNS")
    return R.row_rank(L.lead_value(y, "RETURNS", "CODE", "YEAR", "TARGET"), ["TARGET"])


_LABEL_COLS = ["YEAR", "CODE", "RETURNS", "INDEX_RETURNS", "RETURNS_NEXT", "INDEX_RETURNS_NEXT", "RETURNS_CAT",
               "RETURNS_NEXT_CAT", "RETURNS_vs_INDEX", "RETURNS_vs_INDEX_NEXT"]


@register("vs_index_labels", "SELECT " + ", ".join(_LABEL_COLS) + " FROM panel", ["panel"])
def vs_index_labels(spark, base):
    t = Tables(spark, base).once("price")
    return P.labelled_panel(t.financials, t.price, t.index_values).select(*_LABEL_COLS)


@register(
    "compound_wins_label",
    """
SELECT YEAR, CODE, RETURNS_NEXT, INDEX_RETURNS_NEXT,
  CASE WHEN RETURNS_NEXT > 0 AND RETURNS_NEXT > INDEX_RETURNS_NEXT THEN 'WINS' ELSE 'LOSES' END AS RETURNS_vs_INDEX_NEXT
FROM panel
""",
    ["panel"],
)
def compound_wins_label(spark, base):
    t = Tables(spark, base).once("price")
    p = P.labelled_panel(t.financials, t.price, t.index_values)
    return L.compound_wins(p).select("YEAR", "CODE", "RETURNS_NEXT", "INDEX_RETURNS_NEXT", "RETURNS_vs_INDEX_NEXT")


@register(
    "encode_labels",
    """
SELECT p.YEAR, p.CODE, p.RETURNS_NEXT_CAT, p.RETURNS_vs_INDEX_NEXT, a.CAT_CODE, b.VS_CODE
FROM panel p
LEFT JOIN (SELECT RETURNS_NEXT_CAT, CAST(dense_rank() OVER (ORDER BY RETURNS_NEXT_CAT) - 1 AS INTEGER) AS CAT_CODE
           FROM (SELECT DISTINCT RETURNS_NEXT_CAT FROM panel WHERE RETURNS_NEXT_CAT IS NOT NULL) d) a USING (RETURNS_NEXT_CAT)
LEFT JOIN (SELECT RETURNS_vs_INDEX_NEXT, CAST(dense_rank() OVER (ORDER BY RETURNS_vs_INDEX_NEXT) - 1 AS INTEGER) AS VS_CODE
           FROM (SELECT DISTINCT RETURNS_vs_INDEX_NEXT FROM panel WHERE RETURNS_vs_INDEX_NEXT IS NOT NULL) d) b USING (RETURNS_vs_INDEX_NEXT)
""",
    ["panel"],
)
def encode_labels(spark, base):
    t = Tables(spark, base).once("price")
    p = P.labelled_panel(t.financials, t.price, t.index_values).select(
        "YEAR", "CODE", "RETURNS_NEXT_CAT", "RETURNS_vs_INDEX_NEXT"
    )
    p = L.encode_label(p, "RETURNS_NEXT_CAT", "CAT_CODE")
    return L.encode_label(p, "RETURNS_vs_INDEX_NEXT", "VS_CODE")


@register(
    "sector_rollup_mapping",
    f"""
SELECT SECTOR, YEAR, count(*) AS N_COMPANIES, round(avg(RETURNS), 6) AS AVG_RETURNS,
       round(avg(CSR__ROC_JOEL_GREENBLATT), 6) AS AVG_ROC
FROM (SELECT b.*, coalesce(m.TO_, b.INDUSTRY01) AS SECTOR
      FROM (SELECT f.YEAR, f.CODE, f.CSR__ROC_JOEL_GREENBLATT, y.RETURNS, c.INDUSTRY01
            FROM fund f JOIN yearly_prices y USING (YEAR, CODE) JOIN companies c USING (CODE)) b
      LEFT JOIN (SELECT * FROM (VALUES {sector_values_sql()}) v(FROM_, TO_)
                 UNION ALL
                 SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) m
      ON b.INDUSTRY01 = m.FROM_) s
GROUP BY SECTOR, YEAR
""",
    ["fund", "yearly_prices", "companies"],
)
def sector_rollup_mapping(spark, base):
    t = Tables(spark, base)
    fixed = spark.createDataFrame(sector_pairs(), "FROM string, TO string")
    nat = t.raw("nation").join(t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    mapping = fixed.unionByName(nat.select(F.col("n_name").alias("FROM"), F.col("r_name").alias("TO")))
    b = (
        P.fundamentals(t.financials, True, ["CSR__ROC_JOEL_GREENBLATT"])
        .join(P.yearly_prices(t.price).select("YEAR", "CODE", "RETURNS"), ["YEAR", "CODE"])
        .join(t.companies.select("CODE", "INDUSTRY01"), "CODE")
    )
    s = L.map_categories(b, mapping, "INDUSTRY01", "SECTOR")
    out = s.groupBy("SECTOR", "YEAR").agg(
        F.count(F.lit(1)).alias("N_COMPANIES"),
        F.avg("RETURNS").alias("AVG_RETURNS"),
        F.avg("CSR__ROC_JOEL_GREENBLATT").alias("AVG_ROC"),
    )
    return rounded(out, ["AVG_RETURNS", "AVG_ROC"])


_ALL = P.RATIO_COLUMNS + ["VQ_MARKET_CAP", "IS_EPS_BASIC", "VR_PE_RATIO"]


@register(
    "yearly_metrics_all_columns",
    "SELECT f.CODE, f.YEAR, " + ", ".join(f"f.{c}" for c in _ALL)
    + ", y.PRICE_START, y.PRICE_END, round(y.RISK, 6) AS RISK, y.RETURNS "
    "FROM (SELECT CODE, try_cast(substr(FISCAL_YEAR, 1, 4) AS INTEGER) AS YEAR, " + ", ".join(_ALL)
    + " FROM financials WHERE PRELIMINARY <> 1) f JOIN yearly_prices y USING (YEAR, CODE)",
    ["financials", "yearly_prices"],
)
def yearly_metrics_all_columns(spark, base):
    """Every fundamental column, final statements only, with the yearly price metrics."""
    t = Tables(spark, base)
    f = P.fundamentals(t.financials, include_preliminary=False, columns=_ALL)
    return rounded(f.join(P.yearly_prices(t.price), ["YEAR", "CODE"]), ["RISK"])


@register(
    "yearly_dataset_label_only",
    """
SELECT b.* REPLACE (round(RISK, 6) AS RISK), lead(RETURNS) OVER (PARTITION BY CODE ORDER BY YEAR) AS TARGET
FROM (SELECT f.*, y.PRICE_START, y.PRICE_END, y.RISK, y.RETURNS FROM fund_final f JOIN yearly_prices y USING (YEAR, CODE)) b
""",
    ["fund_final", "yearly_prices"],
)
def yearly_dataset_label_only(spark, base):
    """25 ratios, final statements only, yearly price metrics and the next-year label (no ranks)."""
    t = Tables(spark, base)
    return rounded(P.yearly_dataset(t.financials, t.price, None, include_preliminary=False, with_ranks=False), ["RISK"])


@register(
    "dense_ranks_all_columns",
    """
SELECT YEAR, CODE, METRIC, VALUE,
  CASE WHEN VALUE IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY YEAR, METRIC ORDER BY VALUE DESC NULLS LAST) AS INTEGER) END AS RANK
FROM (SELECT YEAR, CODE, """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in P.RATIO_COLUMNS) + """ FROM fund) s
UNPIVOT INCLUDE NULLS (VALUE FOR METRIC IN (""" + ", ".join(P.RATIO_COLUMNS) + """))
""",
    ["fund"],
)
def dense_ranks_all_columns(spark, base):
    """Dense descending rank of every ratio within its year, long form: one window
    partitioned by (YEAR, METRIC) instead of 25 sorts of the same partition."""
    f = P.fundamentals(Tables(spark, base).financials)
    long = f.select("YEAR", "CODE", *[F.col(c).cast("double").alias(c) for c in P.RATIO_COLUMNS]).unpivot(
        ["YEAR", "CODE"], P.RATIO_COLUMNS, "METRIC", "VALUE")
    return R.dense_rank_by(long, "VALUE", ("YEAR", "METRIC"), ascending=False, out="RANK")
