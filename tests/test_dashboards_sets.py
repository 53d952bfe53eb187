from pyspark.sql import functions as F

from panelforge.operators import dashboards as D
from panelforge.operators import sets as SE


def test_picks_year_cap_and_unique_rank(spark):
    m = spark.createDataFrame(
        [(1999, "A", 100.0, 1, 1.0, 2.0, 1.0), (1999, "B", None, 1, 1.0, 3.0, 2.0), (1999, "C", 10.0, 0, 1.0, 1.0, 0.0),
         (1999, "D", 60.0, 3, 2.0, 2.0, 0.0), (2000, "E", 100.0, 0, 1.0, 1.0, 0.0)],
        "YEAR int, CODE string, CAP double, RANKING int, PRICE_START double, PRICE_END double, RETURNS double")
    c = spark.createDataFrame([(x, f"co {x}", "EUROPE" if x != "D" else "ASIA") for x in "ABCDE"], "CODE string, COMPANY string, REGION string")
    got = {r.CODE: r for r in D.picks(m, c, 2000, n=2, url_prefix="https://quotes.example/").collect()}
    assert set(got) == {"A", "B"}                       # C: cap below 50; E: other year; D: rank 3
    assert got["A"].RANK_UNIQUE == 1 and got["B"].RANK_UNIQUE == 2  # tie on the sum broken by CODE
    assert got["B"].CAP is None and got["A"].PRICE_DIFF == 1.0
    assert got["A"].URL.endswith("/A")
    assert {r.CODE for r in D.picks(m, c, 2000, n=5, regions=["ASIA"]).collect()} == {"D"}


def test_portfolio_growth_compounds(spark):
    picks = spark.createDataFrame([(2000, "A", 0.1), (2000, "B", 0.3), (2001, "A", -0.5)], "YEAR int, CODE string, RETURNS_NEXT double")
    idx = spark.createDataFrame([(2000, 0.1), (2001, 0.0)], "YEAR int, INDEX_RETURNS_NEXT double")
    got = {r.YEAR: r for r in D.portfolio_vs_index(picks, idx).collect()}
    assert abs(got[2000].PORTFOLIO_GROWTH - 1.2) < 1e-12 and abs(got[2001].PORTFOLIO_GROWTH - 0.6) < 1e-12
    assert abs(got[2001].INDEX_GROWTH - 1.1) < 1e-12


def test_left_join_suffixed_and_union_missing(spark):
    a = spark.createDataFrame([("A", 1, 0.1), ("B", 1, 0.2)], "CODE string, M int, RETURNS double")
    b = spark.createDataFrame([("A", 1, 0.5, 9.0)], "CODE string, M int, RETURNS double, REV double")
    j = SE.left_join_suffixed(a, b, ["CODE", "M"])
    assert sorted(j.columns) == ["CODE", "M", "RETURNS_fin", "RETURNS_prices", "REV"]
    assert j.count() == 2
    u = SE.union_by_name([a, b.select("CODE", "REV")], allow_missing=True)
    assert u.count() == 3 and u.where(F.col("REV").isNull()).count() == 2
