"""Sources (S1-S5, S10).

Schemas are always declared: CSV schema inference costs one extra full pass
over the input and guesses wrong types (a ``2017-12`` fiscal year becomes a
timestamp). Text dates stay text here and are parsed once by
``panelforge.functions.parse_date``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.columns import parse_date, year_of_fiscal

PRICE_SCHEMA = T.StructType(
    [
        T.StructField("CODE", T.StringType()),
        T.StructField("DATE", T.StringType()),
        T.StructField("PRICE", T.DoubleType()),
    ]
)

INDEX_QUOTES_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Adj Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
    ]
)

COMPANIES_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("CODE", "SYMBOL", "COMPANY", "REGION", "INDUSTRY01", "INDUSTRY02")]
)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ",") -> DataFrame:
    """Headered CSV with a declared schema (S1, S2 with ``sep='|'``, S4 with a glob and ``sep=';'``)."""
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated company master file."""
    return read_csv(spark, path, COMPANIES_SCHEMA, sep="|")


def read_many(spark: SparkSession, glob: str, schema: T.StructType, sep: str = ";") -> DataFrame:
    """Stack every per-entity CSV under a folder (S4): one distributed read, no driver loop."""
    return read_csv(spark, glob, schema, sep=sep)


def drop_index_column(df: DataFrame, name: str = "Unnamed: 0") -> DataFrame:
    """Drop the unnamed row-number column of a pandas export (S5); no-op if absent."""
    return df.drop(name) if name in df.columns else df


def read_tables(spark: SparkSession, base: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Parquet tables of a folder as DataFrames and temp views."""
    out = {}
    for name in names:
        df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
        df.createOrReplaceTempView(name)
        out[name] = df
    return out


def normalize_price(df: DataFrame) -> DataFrame:
    """Raw price export (CODE, DATE text, PRICE) -> typed (CODE, DATE date, YEAR, PRICE).

    Rows with an unparseable date are dropped here, once, instead of failing
    the job later under ANSI mode.
    """
    return (
        df.select(F.col("CODE"), parse_date("DATE").alias("DATE"), F.col("PRICE").cast("double").alias("PRICE"))
        .where(F.col("DATE").isNotNull())
        .withColumn("YEAR", F.year("DATE"))
    )


def normalize_index_quotes(df: DataFrame, index_id: int = 1, floor: str = "1970-01-01") -> DataFrame:
    """Raw index export -> typed quotes with upper-case names, YEAR, INDICE."""
    renamed = df.withColumnsRenamed(
        {"Date": "DATE", "Open": "OPEN", "High": "HIGH", "Low": "LOW", "Close": "CLOSE", "Adj Close": "ADJ_CLOSE", "Volume": "VOLUME"}
    )
    return (
        renamed.withColumn("DATE", parse_date("DATE"))
        .where(F.col("DATE") > F.lit(floor).cast("date"))
        .withColumn("YEAR", F.year("DATE"))
        .withColumn("INDICE", F.lit(index_id))
    )


def normalize_financials(df: DataFrame, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Fundamentals: optional long->short rename (P2), then YEAR from FISCAL_YEAR."""
    if rename:
        df = df.withColumnsRenamed(dict(rename))
    return df.withColumn("YEAR", year_of_fiscal("FISCAL_YEAR"))


# Vendor column prefixes of the fundamentals and their short forms.
LONG_TO_SHORT_PREFIX = {
    "COMMON_SIZE_RATIOS__": "CSR__",
    "VALUATION_RATIOS__": "VR__",
    "VALUATION_AND_QUALITY__": "VQ__",
    "PER_SHARE_DATA_ARRAY__": "PSDA__",
    "INCOME_STATEMENT__": "IS__",
    "BALANCE_SHEET__": "BS__",
}
# Three panel columns whose short form keeps a single underscore.
SHORT_NAME_EXCEPTIONS = {
    "VALUATION_AND_QUALITY__MARKET_CAP": "VQ_MARKET_CAP",
    "INCOME_STATEMENT__EPS_BASIC": "IS_EPS_BASIC",
    "VALUATION_RATIOS__PE_RATIO": "VR_PE_RATIO",
}


def short_name(name: str) -> str:
    """Long vendor name -> short prefixed name; other names unchanged."""
    if name in SHORT_NAME_EXCEPTIONS:
        return SHORT_NAME_EXCEPTIONS[name]
    for long, short in LONG_TO_SHORT_PREFIX.items():
        if name.startswith(long):
            return short + name[len(long):]
    return name


def long_name(name: str) -> str:
    """Inverse of ``short_name``."""
    for long, short in SHORT_NAME_EXCEPTIONS.items():
        if name == short:
            return long
    for long, short in LONG_TO_SHORT_PREFIX.items():
        if name.startswith(short):
            return long + name[len(short):]
    return name


def shorten_columns(df: DataFrame) -> DataFrame:
    """Rename every long vendor column to its short form (one projection)."""
    return df.withColumnsRenamed({c: short_name(c) for c in df.columns if short_name(c) != c})


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Positional rename of a header-less or badly headed export (``toDF``)."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)
