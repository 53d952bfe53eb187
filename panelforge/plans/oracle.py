"""DuckDB SQL twins of the logical tables and of every registered query.

The driver pre-registers the parquet tables as views; the logical tables of
``panelforge.sources.fixtures`` are rebuilt here as common table expressions.
``sql(body, needs)`` prepends the CTEs a statement depends on, in dependency
order.
"""

from __future__ import annotations

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, needs: tuple[str, ...] = ()) -> None:
    CTES[name] = (needs, body.strip())


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(body: str, needs: tuple[str, ...] = ()) -> str:
    names = _order(needs)
    if not names:
        return body.strip()
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in names]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


# ---------------------------------------------------------------- fixtures
cte(
    "price",
    """
SELECT CODE, DATE, PRICE, CAST(year(DATE) AS INTEGER) AS YEAR FROM (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS CODE, CAST(l_shipdate AS DATE) AS DATE,
         floor(avg(l_extendedprice / NULLIF(l_quantity, 0)) * 10000 + 0.5) / 10000 AS PRICE
  FROM lineitem GROUP BY 1, 2) t
""",
)

cte(
    "price_sparse",
    """
SELECT CODE, DATE, PRICE, CAST(year(DATE) AS INTEGER) AS YEAR FROM (
  SELECT 'C' || CAST(o_custkey AS VARCHAR) AS CODE, CAST(o_orderdate AS DATE) AS DATE,
         floor(avg(o_totalprice) * 10000 + 0.5) / 10000 AS PRICE
  FROM orders GROUP BY 1, 2) t
""",
)

cte(
    "index_values",
    """
SELECT DATE, arg_min(PRICE, CODE) AS OPEN, max(PRICE) AS HIGH, min(PRICE) AS LOW,
       arg_max(PRICE, CODE) AS CLOSE, count(*) AS VOLUME, arg_max(PRICE, CODE) AS ADJ_CLOSE,
       CAST(year(DATE) AS INTEGER) AS YEAR, 1 AS INDICE
FROM price GROUP BY DATE
""",
    ("price",),
)

cte(
    "index_table",
    """
SELECT 1 AS ID, arg_min(r_name, r_regionkey) AS NAME, arg_min(r_name, r_regionkey) AS REGION FROM region
""",
)

cte(
    "companies",
    """
SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS CODE, 'S' || CAST(s_suppkey AS VARCHAR) AS SYMBOL,
       s_name AS COMPANY, r_name AS REGION, n_name AS INDUSTRY01, r_name AS INDUSTRY02
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""",
)

_FIN_BODY = """
SELECT 'S' || CAST(SUPP AS VARCHAR) AS CODE,
  CAST(FY AS VARCHAR) || '-' || lpad(CAST(FM AS VARCHAR), 2, '0') AS FISCAL_YEAR,
  CAST(CASE WHEN SUPP % 17 = 0 THEN NULL
       WHEN FY * 100 + FM = max(FY * 100 + FM) OVER (PARTITION BY SUPP) THEN 1 ELSE 0 END AS INTEGER) AS PRELIMINARY,
  floor(((rev - cogs - tax) / NULLIF(abs(bal) + 1000, 0)) * 10000 + 0.5) / 10000 AS CSR__ROE,
  floor((bal / NULLIF(avg_tax, 0)) * 10000 + 0.5) / 10000 AS VR__EV_TO_EBIT,
  floor(((rev - 2 * cogs) / NULLIF(cogs, 0)) * 10000 + 0.5) / 10000 AS CSR__ROC_JOEL_GREENBLATT,
  floor(((rev - cogs) / NULLIF(rev, 0)) * 10000 + 0.5) / 10000 AS CSR__OPERATING_MARGIN,
  CAST(n % 10 AS INTEGER) AS VQ__PIOTROSKI_F_SCORE,
  floor((gross / NULLIF(n * 1000, 0)) * 10000 + 0.5) / 10000 AS VR__PS_RATIO,
  floor((rev / NULLIF(abs(bal) + 1000, 0)) * 10000 + 0.5) / 10000 AS VR__PB_RATIO,
  floor((disc / NULLIF(tax, 0)) * 10000 + 0.5) / 10000 AS VQ__ALTMAN_Z_SCORE,
  CASE WHEN SUPP % 11 = 0 THEN CAST(NULL AS DOUBLE) ELSE floor(((rev - cogs - tax) / NULLIF(gross, 0)) * 10000 + 0.5) / 10000 END AS CSR__ROA,
  floor(((rev - cogs - tax) / NULLIF(n, 0)) * 10000 + 0.5) / 10000 AS PSDA__EARNINGS_PER_SHARE_DILUTED,
  floor(((rev - cogs) / NULLIF(cogs + abs(bal), 0)) * 10000 + 0.5) / 10000 AS CSR__ROIC,
  floor(((gross - cogs) / NULLIF(gross, 0)) * 10000 + 0.5) / 10000 AS CSR__GROSS_MARGIN,
  floor((qty / NULLIF(n, 0)) * 10000 + 0.5) / 10000 AS VQ__YOY_EPS_GROWTH,
  floor((nret / NULLIF(n, 0)) * 10000 + 0.5) / 10000 AS VQ__YOY_EBITDA_GROWTH,
  floor(((rev - cogs) / NULLIF(n, 0)) * 10000 + 0.5) / 10000 AS PSDA__EBITDA_PER_SHARE,
  floor((tax / NULLIF(n, 0)) * 10000 + 0.5) / 10000 AS PSDA__TOTAL_DEBT_PER_SHARE,
  floor(((rev - cogs - tax) / NULLIF(rev, 0)) * 10000 + 0.5) / 10000 AS CSR__NET_MARGIN,
  floor((rev) * 100 + 0.5) / 100 AS IS__REVENUE,
  floor((rev - cogs - tax) * 100 + 0.5) / 100 AS IS__NET_INCOME,
  floor((cogs) * 100 + 0.5) / 100 AS IS__COST_OF_GOODS_SOLD,
  floor((abs(bal) * 10 + rev / 10) * 100 + 0.5) / 100 AS BS__TOTAL_EQUITY,
  floor((rev - cogs) * 100 + 0.5) / 100 AS IS__EBITDA,
  floor((gross) * 100 + 0.5) / 100 AS BS__TOTAL_ASSETS,
  floor((disc) * 100 + 0.5) / 100 AS BS__LONG_TERM_DEBT,
  floor((tax) * 100 + 0.5) / 100 AS BS__TOTAL_CURRENT_LIABILITIES,
  CASE WHEN SUPP % 23 = 0 THEN 0.0 ELSE floor((rev / 1000) * 10000 + 0.5) / 10000 END AS VQ_MARKET_CAP,
  floor(((rev - cogs - tax) / NULLIF(qty, 0)) * 10000 + 0.5) / 10000 AS IS_EPS_BASIC,
  floor((gross / NULLIF(qty, 0)) * 10000 + 0.5) / 10000 AS VR_PE_RATIO
FROM (
  SELECT l_suppkey AS SUPP, CAST(year(l_shipdate) AS INTEGER) AS FY, {month} AS FM,
    sum(l_extendedprice * (1 - l_discount)) AS rev, sum(l_quantity * p_retailprice) AS cogs,
    sum(l_extendedprice) AS gross, sum(l_tax * l_extendedprice) AS tax, avg(l_tax * l_extendedprice) AS avg_tax,
    sum(l_discount * l_extendedprice) AS disc, sum(l_quantity) AS qty, count(*) AS n,
    sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS nret
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3) g
JOIN (SELECT s_suppkey, s_acctbal AS bal FROM supplier) s ON g.SUPP = s.s_suppkey
"""

cte("financials", _FIN_BODY.format(month="12"))
cte("financials_quarterly", _FIN_BODY.format(month="CAST(quarter(l_shipdate) * 3 AS INTEGER)"))
