import re

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from panelforge.operators import models as M
from panelforge.operators import newton as N
from panelforge.operators import selection as S
from panelforge.operators import trees as T

XS = ["A", "B", "C"]


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(4)
    x = rng.random((360, 3)) * [10, 5, 1]
    y = x[:, 0] * x[:, 1] + np.sin(x[:, 0] * 3) * 4 + rng.standard_normal(360)
    rows = [(k, *map(float, r), float(v), float(v > np.median(y) + 4)) for k, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "ID long, A double, B double, C double, Y double, Z double")
    return S.write_once(S.stratified_folds(df, ["ID"], 3, ["Z"]), "panel")


def test_exact_split_and_folds(spark, panel):
    counts = {r.Z: r["count"] for r in panel.groupBy("Z").count().collect()}
    split = S.exact_split(panel, ["ID"], 0.75, ["Z"])
    got = {(r.Z, r.TRAIN): r["count"] for r in split.groupBy("Z", "TRAIN").count().collect()}
    assert all(got[z, True] == int(n * 0.75) and got[z, False] == n - int(n * 0.75) for z, n in counts.items())
    again = S.exact_split(panel.repartition(7), ["ID"], 0.75, ["Z"])
    assert split.exceptAll(again).isEmpty() and split.count() == 360
    sizes = [r["count"] for r in panel.groupBy("Z", "FOLD").count().where("Z = 1").collect()]
    assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1
    whole = S.exact_split(panel.withColumn("Z", F.lit(None).cast("double")), ["ID"], 0.5, ["Z"])
    assert whole.where("TRAIN").count() == 180 and S.exact_split(panel, ["ID"], 0.1).where("TRAIN").count() == 36


def test_preprocessing_never_sees_validation_rows(panel):
    """Changing the validation rows of a fold changes neither its medians and moments nor its weights."""
    holes = panel.withColumn("A", F.when(F.col("ID") % 7 != 0, F.col("A")))
    wild = holes.withColumns({"A": F.when(F.col("FOLD") == 1, 1e9).otherwise(F.col("A")), "Z": F.when(F.col("FOLD") == 1, 1.0).otherwise(F.col("Z"))})
    steps = S.classifier_steps(XS, "Z", weighted=True, indicators=True)
    sides = [S.fold_sides(df, 1, steps) for df in (holes, wild)]
    cols = ["ID", *XS, "A_ISNULL", "WEIGHT"]
    rows = [sorted(map(tuple, train.select(*cols).collect())) for train, _ in sides]
    assert rows[0] == rows[1] and sum(r[4] for r in rows[0]) == holes.where("FOLD <> 1 AND A IS NULL").count() > 0
    train = holes.where("FOLD <> 1")
    known = np.array([r.A for r in train.select("A").collect() if r.A is not None])
    filled = np.array([r.A if r.A is not None else np.median(known) for r in train.orderBy("ID").select("A").collect()])
    assert np.allclose([r[1] for r in rows[0]], (filled - filled.mean()) / filled.std())
    assert sides[1][1].where("A > 1e6").count() == wild.where("FOLD = 1").count()
    n, ones = train.count(), train.where("Z = 1").count()
    assert {round(r[-1], 9) for r in rows[0]} == {round(n / (2 * ones), 9), round(n / (2 * (n - ones)), 9)}


@pytest.mark.parametrize("loss", ["logistic", "squared_hinge"])
def test_penalty_is_that_of_c(panel, loss):
    """At the optimum C * sum(weight * slope * x) + w is zero, and the intercept's slope too."""
    steps = S.classifier_steps(XS, "Z", weighted=True)
    train = steps.fit(panel).transform(panel)
    rows = train.select(*XS, "Z", "WEIGHT").collect()
    x, y, w = np.array([[*r[:3], 1.0] for r in rows]), np.array([r.Z for r in rows]), np.array([r.WEIGHT for r in rows])
    points = [N.Point(c) for c in (1e-4, 0.01, 1.0, 1000.0)]
    for point, beta in zip(points, N.fit_points(train, XS, "Z", points, loss, "WEIGHT")):
        _, slope, _ = N.LOSSES[loss](x @ beta, y)
        gradient = point.c * x.T @ (w * slope) + beta * [1, 1, 1, 0]
        assert np.abs(gradient).max() < 1e-6 * max(1, point.c * len(rows))


def test_logistic_equals_the_library_fit(panel):
    steps = S.classifier_steps(XS, "Z", weighted=True)
    train = steps.fit(panel).transform(panel)
    n = train.count()
    beta = N.fit_points(train, XS, "Z", [N.Point(0.1)], "logistic", "WEIGHT")[0]
    est = M.classifier_estimator("logistic", 3, regParam=1 / (0.1 * n), maxIter=500, tol=1e-14, weightCol="WEIGHT")
    model = est.setFeaturesCol("features").setLabelCol("Z").fit(train)
    assert np.allclose([*model.coefficients.toArray(), model.intercept], beta, atol=1e-5)
    ours = N.predict(train, XS, N.Point(0.1), beta, probability=True).orderBy("ID").collect()
    theirs = model.transform(train).orderBy("ID").collect()
    assert all(a.PREDICTED == b.prediction and abs(a.PROBABILITY - b.probability[1]) < 1e-5 for a, b in zip(ours, theirs))


def test_newton_grid_equals_separate_fits(panel):
    points = [N.Point(1e-3), N.Point(1.0)]
    got = S.newton_grid(panel, XS, "Z", points, "logistic", 3, weighted=True).orderBy("C").collect()
    steps = S.classifier_steps(XS, "Z", weighted=True)
    for point, row in zip(points, got):
        scores = []
        for fold in range(3):
            train, valid = panel.where(F.col("FOLD") != fold), panel.where(F.col("FOLD") == fold)
            fitted = steps.fit(train)
            est = M.classifier_estimator("logistic", 3, regParam=1 / (point.c * train.count()), maxIter=500, tol=1e-14, weightCol="WEIGHT")
            model = est.setFeaturesCol("features").setLabelCol("Z").fit(fitted.transform(train))
            scores.append(MulticlassClassificationEvaluator(labelCol="Z", metricName="accuracy").evaluate(model.transform(fitted.transform(valid))))
        assert abs(row.MEAN_METRIC - np.mean(scores)) < 1e-12 and abs(row.STD_METRIC - np.std(scores)) < 1e-12
    assert sum(r.BEST for r in got) == 1 and S.best_point(S.newton_grid(panel, XS, "Z", points, "logistic", 3)) in points


def test_rbf_features_separate_rings(spark):
    rng = np.random.default_rng(6)
    angle, ring = rng.random(400) * 2 * np.pi, np.arange(400) % 2
    rows = [(k, float(np.cos(a) * (1 + 2 * r)), float(np.sin(a) * (1 + 2 * r)), float(r)) for k, (a, r) in enumerate(zip(angle, ring))]
    df = S.write_once(S.stratified_folds(spark.createDataFrame(rows, "ID long, A double, B double, Z double"), ["ID"], 4, ["Z"]), "rings")
    points = [N.Point(1.0), N.Point(0.01, 1e-5), N.Point(1.0, 1.0)]
    got = S.newton_grid(df, ["A", "B"], "Z", points, "squared_hinge", 4).collect()
    assert got[0].MEAN_METRIC < 0.7 and got[2].MEAN_METRIC > 0.99 and got[2].BEST
    x = rng.standard_normal((6, 2))
    lift = N.fourier(2, 0.3, 20_000)(x)[:, :-1]
    assert np.allclose(lift @ lift.T, np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(-1)), atol=0.05)


def test_newton_steps_leave_no_hessian_on_the_driver(panel, monkeypatch):
    """What a pass brings to the driver grows with the coefficients of a point, not with their square."""
    train = S.classifier_steps(XS, "Z").fit(panel).transform(panel)
    kind, got = type(train), []
    collect, to_pandas = kind.collect, kind.toPandas

    def numbers(rows):
        return sum(len(v) if isinstance(v, (list, np.ndarray)) else 1 for r in rows for v in r)

    monkeypatch.setattr(kind, "collect", lambda df: (rows := collect(df), got.append(numbers(rows)))[0])
    monkeypatch.setattr(kind, "toPandas", lambda df: (rows := to_pandas(df), got.append(rows.size))[0])
    points = [N.Point(c, 0.1) for c in (0.1, 1.0)]
    N.fit_points(train, XS, "Z", points, "squared_hinge", size=40, passes=2)
    assert 0 < max(got) <= len(points) * (2 * 41 + 4)


def test_hessians_of_neighbours_equal_those_from_all_rows():
    rng = np.random.default_rng(8)
    z, curves = rng.standard_normal((50, 4)), np.repeat((rng.random((50, 1)) > 0.4) * 2.0, 4, axis=1)
    curves[:3, 1], curves[:, 2], curves[5:9, 3] = 2.0, 0.0, 0.7
    for curve, upper in zip(curves.T, N._hessians(z, curves)):
        assert np.allclose(upper, ((z * curve[:, None]).T @ z)[np.triu_indices(4)])


@pytest.mark.parametrize("kind", ["tree", "all features", "classes"])
def test_cut_trees_equal_fits_of_each_depth(panel, kind):
    """Where draws do not depend on the depth; a forest that draws features per node is another forest at each depth."""
    label, loss = ("Z", "wrong_class") if kind == "classes" else ("Y", "squared")
    if kind == "tree":
        make = lambda: M.regression_estimator("tree")
    elif kind == "classes":
        make = lambda: M.classifier_estimator("forest", 3, numTrees=7).setFeatureSubsetStrategy("all")
    else:
        make = lambda: M.regression_estimator("forest", numTrees=7).setFeatureSubsetStrategy("all")
    data = M.assemble(panel, XS)
    train, valid = data.where("FOLD <> 0"), data.where("FOLD = 0")
    depths = range(1, 8)
    deep = make().setFeaturesCol("features").setLabelCol(label).setMaxDepth(7).fit(train)
    got = {r.STAGE: r.LOSS / r.N for r in T.depth_loss(deep, valid, XS, label, depths, loss).collect()}
    for k, d in enumerate(depths):
        scored = make().setFeaturesCol("features").setLabelCol(label).setMaxDepth(d).fit(train).transform(valid)
        error = (F.col("prediction") != F.col(label)).cast("double") if kind == "classes" else (F.col("prediction") - F.col(label)) ** 2
        assert abs(got[k] - scored.agg(F.avg(error)).first()[0]) < 1e-9, d


def test_drawn_forest_cut_at_its_own_depth(panel):
    data = M.assemble(panel, XS)
    model = M.regression_estimator("forest", numTrees=9, maxDepth=5).setFeaturesCol("features").setLabelCol("Y").fit(data)
    got = T.depth_loss(model, data, XS, "Y", [5], "squared").first()
    assert abs(got.LOSS / got.N - model.transform(data).agg(F.avg((F.col("prediction") - F.col("Y")) ** 2)).first()[0]) < 1e-9


def test_depth_grid_and_best(panel):
    got = S.depth_grid(panel, XS, "Y", M.regression_estimator("tree"), range(1, 6), 3, "squared").orderBy("DEPTH").collect()
    assert [r.DEPTH for r in got] == [1, 2, 3, 4, 5] and got[0].MEAN_METRIC > got[-1].MEAN_METRIC
    assert [r.BEST for r in got].index(True) == int(np.argmin([r.MEAN_METRIC for r in got]))


@pytest.mark.parametrize(("label", "loss"), [("Y", "squared"), ("Z", "log"), ("Z", "wrong_sign")])
def test_rounds_equal_a_fit_per_round(panel, label, loss):
    est = M.regression_estimator("gbt", maxDepth=3, stepSize=0.4) if label == "Y" else M.classifier_estimator("gbt", 3, maxDepth=3, stepSize=0.4)
    data = S.write_once(M.assemble(panel, XS), "rounds")
    got, curve = S.boosting_curve(data, XS, label, est, 3, loss, patience=2, most=6, first=2)
    brute = []
    for m in range(1, 7):
        means = []
        for fold in range(3):
            model = est.copy().setFeaturesCol("features").setLabelCol(label).setMaxIter(m).fit(data.where(F.col("FOLD") != fold))
            scored = model.transform(data.where(F.col("FOLD") == fold))
            if label == "Y":
                error = (F.col("prediction") - F.col("Y")) ** 2
            elif loss == "wrong_sign":
                error = (F.col("prediction") != F.col("Z")).cast("double")
            else:
                p = M.vector_to_array("probability")
                error = -F.log(F.when(F.col("Z") == 1, p[1]).otherwise(p[0]))
            means.append(scored.agg(F.avg(error)).first()[0])
        brute.append(np.mean(means))
        if S.early_stop(brute, 2):
            break
    assert np.allclose(curve, brute[: len(curve)], atol=1e-9)
    assert got == (S.early_stop(brute, 2) or int(np.argmin(brute)) + 1)


def test_deep_forests_are_fitted_on_spread_rows_with_kept_nodes(panel, monkeypatch):
    """A small table is dealt to several tasks, and the kept nodes change nothing in the trees."""
    kind, seen = M.RandomForestClassifier, []
    fit = kind._fit
    monkeypatch.setattr(kind, "_fit", lambda est, df: (seen.append((est.getCacheNodeIds(), df.rdd.getNumPartitions())), fit(est, df))[1])
    est = M.classifier_estimator("forest", 3, numTrees=3)
    S.depth_grid(panel, XS, "Z", est, range(1, 4), 2, "wrong_class")
    assert len(seen) == 2 and all(kept and n >= 8 for kept, n in seen)
    rows = S.write_once(M.assemble(panel, XS), "forest")
    said = [est.copy().setCacheNodeIds(kept).setFeaturesCol("features").setLabelCol("Z").fit(rows).toDebugString.split("\n", 1)[1] for kept in (True, False)]
    assert said[0] == said[1]


def test_early_stop_rule():
    assert S.early_stop([5, 4, 3, 3, 3], 2) == 3 and S.early_stop([5, 4, 3, 2], 2) is None and S.early_stop([1, 2, 0.5, 1, 1], 2) == 3
    assert S.early_stop([1, 2, 2, 0], 2) == 1 and S.early_stop([], 2) is None


def test_importance_counts_the_splits(spark, panel):
    data = M.assemble(panel, XS)
    model = M.regression_estimator("forest", numTrees=6, maxDepth=4).setFeaturesCol("features").setLabelCol("Y").fit(data)
    got = {r.FEATURE: r for r in T.importance_table(model, XS, spark).collect()}
    said = re.findall(r"If \(feature (\d+) ", model.toDebugString)
    assert {f: r.WEIGHT for f, r in got.items()} == {f: said.count(str(k)) for k, f in enumerate(XS)}
    assert all(abs(r.GAIN * r.WEIGHT - r.TOTAL_GAIN) < 1e-6 for r in got.values())
    tree = M.regression_estimator("tree", maxDepth=4).setFeaturesCol("features").setLabelCol("Y").fit(data)
    one = T.importance_table(tree, [*XS], spark).collect()
    total = sum(r.TOTAL_GAIN for r in one)
    assert all(abs(r.TOTAL_GAIN / total - r.IMPORTANCE) < 1e-9 for r in one)


def test_pipeline_stages_can_be_reused(panel):
    steps = Pipeline(stages=[S.MedianImputer(XS), S.Assembler(XS)])
    first, second = steps.fit(panel.where("FOLD = 0")), steps.fit(panel.where("FOLD = 1"))
    assert first.stages[0].learned != second.stages[0].learned and "features" in first.transform(panel).columns


def fold_rows(spark):
    import random

    random.seed(3)
    odd = [None, float("nan"), 0.0, -0.0]
    rows = [(i, random.choice([*odd, *[random.gauss(0, 1) for _ in range(6)]]), None, 0.1, float(i), random.choice([1.0, 2.0, 2.0]), 3.0 if i % 5 == 4 else None,
             float(i % 3 == 0), None if i == 7 else i % 5 if i % 2 else (i // 2) % 5) for i in range(400)]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, d double, e double, f double, y double, FOLD int")


def test_steps_of_all_folds_equal_those_fitted_fold_by_fold(spark, monkeypatch):
    df, features = fold_rows(spark), ["a", "b", "c", "d", "e", "f"]
    alone = [S.classifier_steps(features, "y", weighted=True).fit(df.where(F.col("FOLD") != k)) for k in range(5)]
    monkeypatch.setattr(S.M, "fit_medians", lambda *a: pytest.fail("a pass per fold"))
    together = S.fold_steps(df, features, "y", 5, weighted=True)
    for one, other in zip(alone, together):
        assert one.stages[0].learned == other.stages[0].learned  # medians: the same bits
        for c in features:
            assert one.stages[1].learned[c] == pytest.approx(other.stages[1].learned[c], rel=1e-12, abs=1e-12), c
        assert one.stages[2].learned == other.stages[2].learned
        a, b = (np.array([[*r.features, r.WEIGHT] for r in m.transform(df).orderBy("id").collect()]) for m in (one, other))
        assert np.allclose(a, b, rtol=1e-9, atol=1e-9)


def test_medians_of_folds_that_part_the_values(spark):
    # ten thousand values and more: the bracket is narrow; folds cut by value have medians outside it
    df = spark.range(30_000).selectExpr("cast(id as double) AS x", "pmod(xxhash64(id), 1000) / 8D AS z", "cast(id div 10000 as int) AS FOLD")
    inside = S.M.fold_medians_in_bracket(df, "FOLD", 3, ["x", "z"])
    assert [k for k in range(3) if inside[k]["x"] is None] == [0, 1, 2]
    found = S.M.fold_medians(df, ["x", "z"], 3)
    assert found == [S.M.fit_medians(df.where(F.col("FOLD") != k), ["x", "z"]) for k in range(3)]
    dealt = df.withColumn("FOLD", (F.col("x") % 3).cast("int"))
    assert S.M.fold_medians_in_bracket(dealt, "FOLD", 3, ["x", "z"]) == [S.M.fit_medians(dealt.where(F.col("FOLD") != k), ["x", "z"]) for k in range(3)]


def test_steps_of_folds_without_rows(spark):
    df = fold_rows(spark).where("FOLD = 1")
    for k, steps in enumerate(S.fold_steps(df, ["a", "d"], "y", 3, weighted=True)):
        alone = S.classifier_steps(["a", "d"], "y", weighted=True).fit(df.where(F.col("FOLD") != k))
        assert [s.learned for s in alone.stages[:1]] == [s.learned for s in steps.stages[:1]] and alone.stages[2].learned == steps.stages[2].learned


def test_places_of_a_split_are_the_places_of_its_training_rows(spark, monkeypatch):
    df = spark.range(300).selectExpr("cast(id % 9 as int) AS YEAR", "concat('S', id) AS CODE", "if(id % 7 = 0, null, id % 3) AS L")
    monkeypatch.setattr(S, "write_once", lambda *a: pytest.fail("the rows are written a second time"))
    split = S.exact_split(df, ["YEAR", "CODE"], 0.8, ["L"], place="PLACE")
    got = split.where("TRAIN").withColumn("FOLD", (F.col("PLACE") - 1) % 4).drop("PLACE", "TRAIN")
    want = S.stratified_folds(split.where("TRAIN").drop("PLACE", "TRAIN"), ["YEAR", "CODE"], 4, ["L"])
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() == sum(int(n * 0.8) for n in (43, 86, 85, 86))
