"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and their DuckDB twins.

Each query reads the driver's parquet tables through the logical tables of
``panelforge.sources.fixtures`` and runs the library operator on the whole
data. Doubles that come out of floating aggregates (avg, stddev, sums,
percentiles, correlations) are rounded on both sides, because summation order
differs between engines; values built only from rounded inputs by single IEEE
operations are bit-equal and left as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.plans import oracle as O
from panelforge.session import write_once
from panelforge.sources import fixtures as X

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle_body: str | None = None, needs: Sequence[str] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle_body is not None:
            ORACLE[name] = O.sql(oracle_body, tuple(needs))
        return fn

    return deco


def rounded(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


class Tables:
    """Lazily built logical tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        self._once: dict[str, DataFrame] = {}

    def once(self, *names: str) -> Tables:
        """Write the named logical tables once; a query with several branches then reads them instead of the raw tables."""
        for name in names:
            self._once[name] = write_once(getattr(self, name), name)
        return self

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base.rstrip('/')}/{name}.parquet")

    @property
    def price(self) -> DataFrame:
        return self._once["price"] if "price" in self._once else X.price(self.spark, self.base)

    @property
    def price_sparse(self) -> DataFrame:
        return X.price_sparse(self.spark, self.base)

    @property
    def index_values(self) -> DataFrame:
        return X.index_values(self.spark, self.base, self._once.get("price"))

    @property
    def index_table(self) -> DataFrame:
        return X.index_table(self.spark, self.base)

    @property
    def financials(self) -> DataFrame:
        return self._once["financials"] if "financials" in self._once else X.financials(self.spark, self.base, "year")

    @property
    def financials_quarterly(self) -> DataFrame:
        return X.financials(self.spark, self.base, "quarter")

    @property
    def companies(self) -> DataFrame:
        return X.companies(self.spark, self.base)
