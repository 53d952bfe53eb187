import datetime as dt
import math
import random

from pyspark.sql import functions as F

from panelforge.operators import returns as T
from panelforge.plans import pipelines as P


def d(s):
    return dt.date.fromisoformat(s)


def test_first_row_and_zero_previous_price(spark):
    df = spark.createDataFrame([("A", d("2000-01-03"), 0.0), ("A", d("2000-01-04"), 5.0), ("A", d("2000-01-05"), 10.0)],
                               "CODE string, DATE date, PRICE double").withColumn("YEAR", F.year("DATE"))
    got = {r.DATE: r.RETURNS for r in T.daily_return(df).collect()}
    assert got[d("2000-01-03")] is None          # first row of the series
    assert got[d("2000-01-04")] is None          # previous price 0: null, not an ANSI error
    assert got[d("2000-01-05")] == 1.0


def test_current_denominator(spark):
    df = spark.createDataFrame([("A", d("2000-01-03"), 4.0), ("A", d("2000-01-04"), 5.0)], "CODE string, DATE date, PRICE double")
    df = df.withColumn("YEAR", F.year("DATE"))
    r = {x.DATE: x.RETURNS for x in T.daily_return(df, denominator="current").collect()}
    assert r[d("2000-01-04")] == (5.0 - 4.0) / 5.0


def test_bucketed_lag_equals_plain_lag_across_years_and_gaps(spark):
    rnd = random.Random(7)
    rows = []
    for code in ("A", "B", "C"):
        day = d("1995-12-20")
        for _ in range(60):
            day += dt.timedelta(days=rnd.choice([1, 1, 2, 40, 400]))
            rows.append((code, day, round(rnd.uniform(1, 100), 4)))
    df = spark.createDataFrame(rows, "CODE string, DATE date, PRICE double").withColumn("YEAR", F.year("DATE"))
    a = {(r.CODE, r.DATE): r.RETURNS for r in T.daily_return(df, period="YEAR").collect()}
    b = {(r.CODE, r.DATE): r.RETURNS for r in T.daily_return(df, period=None).collect()}
    assert a == b


def test_daily_returns_compound_to_ytd(spark):
    rnd = random.Random(3)
    rows, day = [], d("2001-01-02")
    for _ in range(50):
        rows.append(("A", day, round(rnd.uniform(10, 20), 4)))
        day += dt.timedelta(days=1)
    df = spark.createDataFrame(rows, "CODE string, DATE date, PRICE double").withColumn("YEAR", F.year("DATE"))
    out = sorted(P.price_returns_job(df).collect(), key=lambda r: r.DATE)
    prod = 1.0
    for r in out[1:]:
        prod *= 1 + r.RETURNS
        assert math.isclose(prod, 1 + r.CUMULATIVE_RETURNS, rel_tol=1e-9)


def test_period_summary_single_row_risk_is_null(spark):
    df = spark.createDataFrame([("A", d("2000-05-01"), 3.0, 2000), ("B", d("2000-05-01"), 2.0, 2000), ("B", d("2000-06-01"), 4.0, 2000)],
                               "CODE string, DATE date, PRICE double, YEAR int")
    got = {r.CODE: r for r in T.period_summary(df).collect()}
    assert got["A"].RISK is None and got["A"].RETURNS == 0.0
    assert got["B"].PRICE_START == 2.0 and got["B"].PRICE_END == 4.0 and got["B"].RETURNS == 1.0


def _quarter(spark, prices, fiscal):
    p = spark.createDataFrame(prices, "CODE string, DATE date, PRICE double")
    q = spark.createDataFrame([("A", f) for f in fiscal], "CODE string, FISCAL_YEAR string")
    return {r.FISCAL_YEAR: r for r in T.quarterly_return(q, p).collect()}


def test_quarter_rules(spark):
    prices = [
        ("A", d("2001-04-01"), 0.0),   # price 0 on the first day: search goes on
        ("A", d("2001-04-02"), 10.0),
        ("A", d("2001-06-30"), 12.0),
        ("A", d("2001-09-30"), 11.0),  # September: day 30 counts
        ("A", d("2001-07-03"), 8.0),
        ("A", d("2001-10-05"), 9.0),
        ("A", d("2001-12-31"), 18.0),  # December: day 31 counts
        ("A", d("2001-08-31"), 99.0),  # day 31 of another month: never an end price
    ]
    r = _quarter(spark, prices, ["2001-06", "2001-09", "2001-12", "2001-03", "2001-02"])
    assert (r["2001-06"].PRICE_INI, r["2001-06"].PRICE_FIN, r["2001-06"].RETURNS) == (10.0, 12.0, 0.2)
    assert r["2001-09"].PRICE_INI == 8.0 and r["2001-09"].PRICE_FIN == 11.0
    assert r["2001-12"].PRICE_INI == 9.0 and r["2001-12"].PRICE_FIN == 18.0 and r["2001-12"].RETURNS == 1.0
    assert r["2001-03"].PRICE_INI == 0.0 and r["2001-03"].RETURNS == 0.0      # no start price
    assert r["2001-02"].RETURNS == 0.0                                          # month 2: no start month


def test_quarter_without_end_price(spark):
    r = _quarter(spark, [("A", d("2001-04-03"), 10.0)], ["2001-06"])
    assert r["2001-06"].PRICE_FIN == 0.0 and r["2001-06"].RETURNS == -1.0


def test_monthly_ohlc(spark):
    df = spark.createDataFrame([("A", d("2001-04-02"), 3.0), ("A", d("2001-04-03"), 5.0), ("A", d("2001-04-30"), 4.0)],
                               "CODE string, DATE date, PRICE double").withColumn("YEAR", F.year("DATE"))
    r = T.monthly_ohlc(df).collect()[0]
    assert (r.OPEN, r.HIGH, r.LOW, r.CLOSE) == (3.0, 5.0, 3.0, 4.0)
    assert math.isclose(r.RETURNS, 1 / 3)


def test_bucketed_rolling_sum_equals_plain_window(spark):
    rnd = random.Random(11)
    rows = []
    for code in ("A", "B", "C", "D"):
        day = d("1995-12-25")
        for _ in range(rnd.randint(1, 40)):
            day += dt.timedelta(days=rnd.choice([1, 2, 3, 200, 400, 800]))
            rows.append((code, day, float(rnd.randint(1, 9))))
    df = spark.createDataFrame(rows, "CODE string, DATE date, PRICE double").withColumn("YEAR", F.year("DATE"))
    for n in (2, 3, 5):
        a = {(r.CODE, r.DATE): r[f"PRICE_SUM{n}"] for r in T.rolling_sum(df, n).collect()}
        b = {(r.CODE, r.DATE): r[f"PRICE_SUM{n}"] for r in T.rolling_sum(df, n, period=None).collect()}
        assert a == b, n
