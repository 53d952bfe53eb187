import datetime as dt
import pathlib
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.session import shared_scratch
from panelforge.sources import readers as RD
from panelforge.sources import writers as WR


def test_normalize_price_parses_both_formats_and_drops_bad_dates(spark):
    raw = spark.createDataFrame([("A", "01-02-1990", 1.0), ("A", "1991-01-02", 2.0), ("A", "31-31-1990", 3.0)],
                                "CODE string, DATE string, PRICE double")
    got = sorted((r.DATE, r.YEAR) for r in RD.normalize_price(raw).collect())
    assert got == [(dt.date(1990, 1, 2), 1990), (dt.date(1991, 1, 2), 1991)]


def test_text_dates_order_by_parsed_date(spark):
    raw = spark.createDataFrame([("A", "01-03-1990", 1.0), ("A", "01-02-1991", 2.0)], "CODE string, DATE string, PRICE double")
    first = RD.normalize_price(raw).orderBy("DATE").first()
    assert first.DATE == dt.date(1990, 1, 3)  # text order would put 1991 first


def test_normalize_index_quotes(spark):
    raw = spark.createDataFrame([("1969-12-31", 1.0, 1.0, 1.0, 1.0, 1.0, 5), ("1970-01-02", 2.0, 2.0, 2.0, 2.0, 2.5, 6)],
                                RD.INDEX_QUOTES_SCHEMA)
    rows = RD.normalize_index_quotes(raw).collect()
    assert len(rows) == 1 and rows[0].ADJ_CLOSE == 2.5 and rows[0].YEAR == 1970 and rows[0].INDICE == 1


def test_fundamentals_fiscal_year_and_preliminary_filter(spark):
    from panelforge.plans.pipelines import fundamentals

    f = spark.createDataFrame([("A", "2017-12", 1, 0.5), ("A", "2016-12", 0, 0.4), ("A", "2015-12", None, 0.3)],
                              "CODE string, FISCAL_YEAR string, PRELIMINARY int, CSR__ROE double")
    got = sorted(r.YEAR for r in fundamentals(f, include_preliminary=False, columns=["CSR__ROE"]).collect())
    assert got == [2016]  # PRELIMINARY <> 1 also drops the null flag
    assert len(fundamentals(f, True, ["CSR__ROE"]).collect()) == 3


def test_bucketed_tables_join_without_exchange(spark):
    a = spark.range(2000).selectExpr("cast(id % 7 as int) AS YEAR", "cast(id % 300 as string) AS CODE", "id AS X")
    b = spark.range(500).selectExpr("cast(id % 7 as int) AS YEAR", "cast(id as string) AS CODE", "id AS Z")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = [WR.write_bucketed(d, f"bucketed_test_{n}", shared_scratch(spark, n), buckets=4) for n, d in (("a", a), ("b", b))]
        joined = stored[0].join(stored[1], ["YEAR", "CODE"])
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in a.join(b, ["YEAR", "CODE"])._jdf.queryExecution().executedPlan().toString()
        assert joined.exceptAll(a.join(b, ["YEAR", "CODE"])).isEmpty() and joined.count() == a.join(b, ["YEAR", "CODE"]).count()
        assert "Exchange" not in stored[0].groupBy("YEAR", "CODE").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        for n in ("a", "b"):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_test_{n}")


def files_of(folder):
    return {str(f): f.stat().st_mtime_ns for f in pathlib.Path(folder).rglob("*.parquet")}


def test_a_build_that_was_killed_goes_on(spark):
    df = spark.range(400).selectExpr("nullif(concat('T', id % 40), 'T3') AS Ticker", "id AS X")
    path = shared_scratch(spark, "entities")
    batch = F.pmod(F.xxhash64("Ticker"), F.lit(5))
    dies = df.withColumn("X", F.when(batch == 2, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("X")))
    with pytest.raises(Exception, match="lost"):
        WR.write_entities(dies, path, "Ticker", batches=5)
    first = {r.Ticker for r in WR.finished_entities(spark, path, "Ticker", "string").collect()}
    assert first == {r.Ticker for r in df.where(batch < 2).select("Ticker").collect()} and 0 < len(first) < 40
    before = files_of(path)
    assert WR.write_entities(df, path, "Ticker", batches=5) == 3
    after = files_of(path)
    done = [f for f in before if re.search("Ticker=([^/]+)/", f)[1].replace("__HIVE_DEFAULT_PARTITION__", "") in {t or "" for t in first}]
    assert done and all(after[f] == before[f] for f in done)
    back = spark.read.schema(df.schema).parquet(path).select("Ticker", "X")
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    assert WR.write_entities(df, path, "Ticker", batches=5) == 0 and files_of(path) == after


def test_entities_of_an_empty_table(spark):
    path = shared_scratch(spark, "no-entities")
    assert WR.write_entities(spark.createDataFrame([], "Ticker string, X long"), path, "Ticker") == 0


def test_entity_files_are_dealt_to_all_tasks_and_read_as_one_folder(spark):
    from pyspark.sql import Window

    names = "element_at(array(null, '007', 'A B', 'x=y', 'a/b;c'), cast(id % 5 + 1 as int))"
    df = spark.range(500).selectExpr(f"if(id < 50, {names}, concat('T', id % 90)) AS Ticker", "concat('2000-', id) AS FISCAL_YEAR", "id / 7 AS PRICE_INI", "id * 1.5D AS PRICE_FIN", "id * 2.5D AS RETURNS")
    df = df.withColumn("Unnamed: 0", F.row_number().over(Window.partitionBy("Ticker").orderBy("FISCAL_YEAR")).cast("long") - 1)
    path = shared_scratch(spark, "entity-files")
    WR.write_entity_files(df, path, "Ticker", "csv", header="true", sep=";")
    files = list(pathlib.Path(path).rglob("*.csv"))
    assert len(files) == len({f.parent for f in files}) == df.select("Ticker").distinct().count()
    # a few rows: merged by their bytes, one task wrote all the files
    assert len({re.match(r"part-(\d+)", f.name)[1] for f in files}) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    back = RD.read_many(spark, path, T.StructType([f for f in df.schema if f.name != "Ticker"] + [df.schema["Ticker"]]), sep=";").select(*df.columns)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_no_entity_files(spark):
    path = shared_scratch(spark, "no-entity-files")
    WR.write_entity_files(spark.createDataFrame([], "Ticker string, X long"), path, "Ticker")
    assert RD.read_many(spark, path, "X long, Ticker string").isEmpty()


def test_per_entity_files_writes_by_all_tasks(spark, monkeypatch):
    from panelforge.plans.registry import all_queries

    seen = []
    read_many = RD.read_many
    monkeypatch.setattr(RD, "read_many", lambda s, path, *a, **k: seen.append(path) or read_many(s, path, *a, **k))
    all_queries()["per_entity_files"](spark, "/root/testdata/sf0.001").collect()
    files = list(pathlib.Path(seen[0].replace("file:", "")).glob("**/*.csv")) if "*" not in seen[0] else []
    assert len({re.match(r"part-(\d+)", f.name)[1] for f in files}) > 1  # ten tickers; before, one task and a glob of all files
