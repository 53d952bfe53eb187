import math

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from panelforge.operators import evaluate as EV
from panelforge.operators import models as M
from panelforge.operators import series as S


def test_interpolation_leading_inner_trailing(spark):
    vals = [None, 1.0, None, None, 4.0, None]
    df = spark.createDataFrame([("u", i, v) for i, v in enumerate(vals)], "K string, T int, V double")
    got = [r.V for r in S.linear_interpolation(df, ["V"], "K", "T").orderBy("T").collect()]
    assert got == [1.0, 2.0, 3.0, 4.0, 4.0]


def test_series_to_supervised_names(spark):
    df = spark.createDataFrame([("A", y, float(y), float(-y)) for y in range(2000, 2005)], "CODE string, YEAR int, X double, Y double")
    out = S.series_to_supervised(df, ["X", "Y"], n_in=1, n_out=2)
    assert out.columns == ["CODE", "YEAR", "var1(t-1)", "var2(t-1)", "var1(t)", "var2(t)", "var1(t+1)", "var2(t+1)"]
    assert out.count() == 3


def test_persistence_last_row(spark):
    df = spark.createDataFrame([("A", 2000, 1.0), ("A", 2001, 3.0), ("A", 2002, 2.0)], "CODE string, YEAR int, R double")
    r = S.persistence_rmse(df, "R").first()
    assert r.PREDICTION == 3.0 and r.RMSE == 1.0


def test_var_univariate_equals_closed_form(spark):
    rng = np.random.default_rng(1)
    rows = []
    for code in ("A", "B"):
        y = 0.5
        for t in range(12):
            y = 0.3 + 0.6 * y + rng.normal(0, 0.1)
            rows.append((code, 2000 + t, float(y)))
    df = spark.createDataFrame(rows, "CODE string, YEAR int, R double")
    var = {r.CODE: r.FORECAST for r in S.var_forecast(df, ["R"], lags=1, holdout=1).collect()}
    ar = {r.CODE: r.FORECAST for r in S.ar1_forecast(df, "R").collect()}
    for k in var:
        assert math.isclose(var[k], ar[k], rel_tol=1e-9)


def test_var_reports_short_and_broken_series(spark):
    rows = [("A", 2000, 1.0, 2.0), ("A", 2001, 2.0, 1.0)] + [("B", 2000 + i, float(i), None if i == 3 else 1.0) for i in range(9)]
    got = S.var_forecast(spark.createDataFrame(rows, "CODE string, YEAR int, X double, Y double"), ["X", "Y"]).collect()
    assert {(r.CODE, r.METRIC, r.STATUS, r.FORECAST) for r in got} == {
        ("A", "X", "too short", None), ("A", "Y", "too short", None), ("B", "X", "null in the series", None), ("B", "Y", "null in the series", None)}


def test_var_forecasts_several_steps(spark):
    x = [(1.0, 2.0)]
    for _ in range(11):  # an exact VAR(1): the forecast meets every held-out row
        a, b = x[-1]
        x.append((0.5 + 0.6 * a - 0.2 * b, 1.0 + 0.1 * a + 0.7 * b))
    df = spark.createDataFrame([("A", 2000 + i, a, b) for i, (a, b) in enumerate(x)], "CODE string, YEAR int, X double, Y double")
    got = S.var_forecast(df, ["X", "Y"], holdout=0.25)
    assert sorted((r.METRIC, r.STEP) for r in got.collect()) == [("X", 1), ("X", 2), ("X", 3), ("Y", 1), ("Y", 2), ("Y", 3)]
    r = S.var_rmse(got, "X").first()
    assert r.STEPS == 3 and r.RMSE < 1e-6


def test_var_equals_least_squares_of_numpy(spark):
    rng = np.random.default_rng(7)
    lags, holdout, series = 2, 3, {}
    for code, n in (("A", 20), ("B", 40), ("C", 9)):  # C: four observations for five parameters
        y = rng.normal(0, 1, (n, 2)).cumsum(axis=0) * [1.0, 1000.0] + [0.1, 5e4]
        series[code] = y
    series["D"] = np.column_stack([np.full(20, 0.1), rng.normal(0, 1, 20)])  # a constant series: its lags explain nothing
    rows = [(c, 2000 + t, float(a), float(b)) for c, y in series.items() for t, (a, b) in enumerate(y)]
    df = spark.createDataFrame(rows, "CODE string, YEAR int, X double, Y double").repartition(5)
    got = {(r.CODE, r.METRIC, r.STEP): r for r in S.var_forecast(df, ["X", "Y"], lags=lags, holdout=holdout).collect()}
    assert len(got) == 4 * 2 * holdout
    assert {r.STATUS for r in got.values() if r.CODE == "C"} == {"too short"}
    assert {c: {r.RANK for r in got.values() if r.CODE == c} for c in "ABD"} == {"A": {5}, "B": {5}, "D": {3}}
    for code in "ABD":
        y = series[code]
        train = y[:-holdout]
        x = np.hstack([np.ones((len(train) - lags, 1))] + [train[lags - 1 - i : len(train) - 1 - i] for i in range(lags)])
        coef = np.linalg.lstsq(x, train[lags:], rcond=None)[0]
        seen = list(train)
        for step in range(holdout):
            seen.append(np.concatenate([[1.0], seen[-1], seen[-2]]) @ coef)
            for j, c in enumerate("XY"):
                r = got[code, c, step + 1]
                assert math.isclose(r.FORECAST, seen[-1][j], rel_tol=1e-7, abs_tol=1e-9) and r.ACTUAL == y[len(train) + step][j]


def test_var_plan_has_no_python(spark):
    df = spark.createDataFrame([("A", 2000, 1.0)], "CODE string, YEAR int, X double")
    plan = S.var_forecast(df, ["X"])._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Python" not in plan


def test_metrics_use_complete_pairs_only(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 2.5), (9.0, None), (None, 3.0)], "Y double, P double")
    r = EV.regression_metrics(df, "Y", "P").first()
    assert r.N == 3 and math.isclose(r.MSE, 2.5 / 3) and math.isclose(r.R2, 1 - 2.5 / (14 / 3))
    a = EV.accuracy(spark.createDataFrame([(1, 1), (0, 1), (None, 1), (1, None)], "L int, P int"), "L", "P").first()
    assert (a.ACCURACY, a.N) == (0.5, 2)


def test_one_index_only(spark):
    import pytest

    from panelforge.plans import pipelines as P

    q = spark.createDataFrame([(i, 2000, d, o, o + i) for i in (1, 2) for d, o in ((1, 2.0), (2, 3.0))], "INDICE int, YEAR int, DATE int, OPEN double, CLOSE double")
    got = {r.INDICE: r.INDEX_RETURNS for r in P.index_yearly_returns(q).collect()}
    assert got == {1: 1.0, 2: 1.5}
    assert P.one_index(q, 2).count() == 2
    with pytest.raises(Exception, match="several indices"):
        P.one_index(q).collect()


def _walk_rows(years, later=0.0):
    rng = np.random.default_rng(4)
    rows = []
    for y in years:
        for i in range(12):
            x = float(rng.integers(1, 30))
            rows.append((y, f"C{i}", None if i == 5 else x, 2.0 * x + 1.0 + (later if y >= 2003 else 0.0)))
    return rows


def test_walk_forward_sees_no_later_year_and_returns_every_row(spark):
    schema = "YEAR int, CODE string, X double, Y double"
    est = M.regression_estimator("tree")
    got = []
    for later in (0.0, 500.0):
        df = spark.createDataFrame(_walk_rows(range(2000, 2005), later), schema)
        s = M.walk_forward_fit_predict(df, ["X"], "Y", [2000, 2002, 2003, 2004], 2, est, df, fill=True)
        got.append({(r.YEAR, r.CODE): r.PREDICTION for r in s.collect()})
    assert len(got[0]) == 48
    assert all(p is None for (y, _), p in got[0].items() if y == 2000)  # no year before it
    assert all(p is not None for (y, _), p in got[0].items() if y > 2000)
    for key in got[0]:
        assert key[0] == 2004 or got[0][key] == got[1][key]
    df = spark.createDataFrame(_walk_rows(range(2000, 2003)), schema)
    blank = M.walk_forward_fit_predict(df, ["X"], "Y", [2002], 2, est, df).where("PREDICTION is null").collect()
    assert [r.CODE for r in blank] == ["C5"]  # without a feature, not imputed


def test_impute_and_medians(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None), (8.0, None)], "A double, B double")
    m = M.fit_medians(df, ["A", "B"])
    assert m == {"A": 3.0, "B": 0.0}
    out = M.impute(df, m, indicators=True).collect()
    assert sorted(r.A for r in out) == [1.0, 3.0, 3.0, 8.0] and sum(r.A_ISNULL for r in out) == 1 and all(r.B == 0.0 for r in out)


def test_grid_search_classifier_finds_the_useful_depth(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rows = [(float(i % 4), float((i % 4) in (1, 2))) for i in range(160)]
    df = spark.createDataFrame(rows, "X double, LABEL double")
    est = M.classifier_estimator("forest", 1, numTrees=1)
    got = M.grid_search(df, ["X"], "LABEL", est, {"maxDepth": [1, 3]}, folds=3, evaluator=MulticlassClassificationEvaluator(metricName="accuracy"))
    score = {r.PARAMS: r.MEAN_METRIC for r in got.collect()}
    assert score["maxDepth=3"] == 1.0 > score["maxDepth=1"]


def test_interpolation_is_linear_in_the_length(spark):
    n = 20_000
    df = spark.range(n).select(F.lit("A").alias("K"), F.col("id").alias("D"), F.when(F.col("id") % 100 == 0, F.col("id") * 2.0).alias("V"))
    got = S.linear_interpolation(df, ["V"], "K", "D").agg(F.count("*").alias("n"), F.sum("V").alias("s")).first()
    last = (n - 1) // 100 * 100
    assert got.n == n and math.isclose(got.s, sum(2.0 * min(i, last) for i in range(n)))


def test_min_max_inverse(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (5.0,)], "X double")
    s = S.min_max_scale(df, ["X"])
    back = S.min_max_inverse(s, "X", "X_SCALED", "X_BACK").collect()
    assert sorted(r.X_SCALED for r in back) == [0.0, 0.5, 1.0]
    assert all(math.isclose(r.X, r.X_BACK) for r in back)


def _lr_data(spark, n=200):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        x1, x2 = float(rng.integers(1, 50)), float(rng.integers(1, 50))
        rows.append((str(i), 1999, x1, x2, 3.0 + 0.5 * x1 - 0.25 * x2 + float(rng.normal(0, 1))))
    return spark.createDataFrame(rows, "CODE string, YEAR int, X1 double, X2 double, Y double").withColumn("TARGET_YEAR", F.lit(2000))


def test_closed_form_lr_equals_mllib_and_normal_equations(spark):
    df = _lr_data(spark)
    c = M.linear_fit_two(df, "X1", "X2", "Y").first()
    n = M.linear_fit(df, ["X1", "X2"], "Y").first()
    mllib = LinearRegression(solver="normal", regParam=0.0).fit(M.assemble(df, ["X1", "X2"]).withColumnRenamed("Y", "label"))
    assert math.isclose(c.B0, mllib.intercept, rel_tol=1e-6)
    assert math.isclose(c.B1, mllib.coefficients[0], rel_tol=1e-6) and math.isclose(c.B2, mllib.coefficients[1], rel_tol=1e-6)
    assert math.isclose(c.B1, n.B1, rel_tol=1e-6) and math.isclose(c.B0, n.B0, rel_tol=1e-6)


def test_sliding_windows_equal_a_fit_per_window(spark):
    rng = np.random.default_rng(11)
    rows = [(str(i), int(rng.integers(1995, 2004)), float(rng.normal(1e4, 3)), float(rng.normal(0, 1)), float(rng.normal(5, 2))) for i in range(600)]
    rows += [("n", 1998, None, 1.0, 1.0), ("m", 1999, 1.0, 1.0, None)]  # incomplete rows train nothing
    df = spark.createDataFrame(rows, "CODE string, YEAR int, X1 double, X2 double, Y double")
    years = [1998, 2000, 2003, 2009]  # 2009 has no row in its window
    windows = M.window_moments(df, ["X1", "X2"], "Y", years, 3)
    two = {r.TARGET_YEAR: r for r in M.solve_two(windows).collect()}
    some = {r.TARGET_YEAR: r for r in M.solve_linear(windows, 2).collect()}
    assert sorted(two) == sorted(some) == [1998, 2000, 2003]
    for year in two:
        own = [r for r in rows if year - 3 <= r[1] < year and None not in r]
        a = np.array([[1.0, r[2], r[3]] for r in own])
        want = np.linalg.lstsq(a, np.array([r[4] for r in own]), rcond=None)[0]
        for got in (two[year], some[year]):
            assert got.N == len(own) and np.allclose([got.B0, got.B1, got.B2], want, rtol=1e-6, atol=1e-9)


def test_sliding_windows_copy_years_not_rows(spark):
    df = spark.range(100).selectExpr("cast(id as string) CODE", "cast(1990 + id % 9 as int) YEAR", "double(id) X1", "double(id * id) X2", "double(id % 7) Y")
    plan = M.solve_linear(M.window_moments(df, ["X1", "X2"], "Y", [1994, 1995], 3), 2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and "Pandas" not in plan
    assert "Aggregate [YEAR" in plan[plan.index("Generate"):]  # the rows below the copies are one per year


def test_collinear_features_weigh_nothing(spark):
    df = spark.range(50).selectExpr("2000 TARGET_YEAR", "double(id) X1", "double(2 * id + 1) X2", "double(3 * id) Y", "0.1 X3")
    r = M.linear_fit(df, ["X1", "X2", "X3"], "Y").first()
    assert math.isclose(r.B1, 3.0, rel_tol=1e-9) and (r.B2, r.B3) == (0.0, 0.0) and abs(r.B0) < 1e-9
    assert M.linear_fit_two(df, "X1", "X2", "Y").first().N == 50


def test_training_windows_have_no_look_ahead(spark):
    df = spark.createDataFrame([(str(i), y) for i in range(3) for y in range(1995, 2002)], "CODE string, YEAR int")
    t = M.training_windows(df, [1998, 1999, 2000, 2001], 3)
    assert t.where(F.col("YEAR") >= F.col("TARGET_YEAR")).count() == 0
    assert t.where(F.col("YEAR") < F.col("TARGET_YEAR") - 3).count() == 0
    assert t.where(F.col("TARGET_YEAR") == 1998).count() == 9


def test_auc_equals_mllib_with_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(int(l), float(round(s, 1))) for l, s in zip(rng.integers(0, 2, 300), rng.random(300))]
    df = spark.createDataFrame(rows, "LABEL int, SCORE double")
    ours = EV.roc_auc(df, "LABEL", "SCORE").first().AUC
    ref = BinaryClassificationEvaluator(rawPredictionCol="SCORE", labelCol="LABEL").evaluate(df.withColumn("LABEL", F.col("LABEL").cast("double")))
    assert math.isclose(ours, ref, rel_tol=1e-9)


def test_confusion_with_empty_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "Y int, P int")
    r = EV.confusion_metrics(df, "Y", "P").first()
    assert r.TN == 2 and r.SEN is None and r.PPV is None and r.ESP == 1.0 and r.ACC == 1.0


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "L string")
    w = {r.L: r.WEIGHT for r in M.class_weights(df, "L").collect()}
    assert math.isclose(w["a"], 4 / (2 * 3)) and math.isclose(w["b"], 4 / (2 * 1))


def test_hash_split_is_repeatable(spark):
    df = spark.range(1000).withColumn("YEAR", F.lit(2000))
    a, _ = M.hash_split(df, ["id", "YEAR"], 0.75)
    b, _ = M.hash_split(df.repartition(7), ["id", "YEAR"], 0.75)
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect())


def test_calendar_fill_inserts_missing_days(spark):
    import datetime as dt

    df = spark.createDataFrame([("u", dt.date(2024, 1, 1), 1.0), ("u", dt.date(2024, 1, 4), 4.0), ("v", dt.date(2024, 1, 2), 2.0)],
                               "K string, DAY date, V double")
    got = sorted((r.K, r.DAY.day, r.V) for r in S.calendar_fill(df, "K", "DAY").collect())
    assert got == [("u", 1, 1.0), ("u", 2, None), ("u", 3, None), ("u", 4, 4.0), ("v", 2, 2.0)]


def test_standard_scale_population_std(spark):
    df = spark.createDataFrame([(2000, 1.0), (2000, 3.0), (2001, 5.0), (2001, 5.0)], "YEAR int, X double")
    got = sorted((r.YEAR, r.X) for r in S.standard_scale(df, ["X"]).collect())
    assert got[0] == (2000, -1.0) and got[1] == (2000, 1.0)   # population std of (1, 3) is 1
    assert got[2][1] is None                                   # zero spread: null, not an error
