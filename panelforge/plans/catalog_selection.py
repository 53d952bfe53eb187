"""Queries: splits, grids with preprocessing inside the folds, chosen rounds, refitted winners, importances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators import evaluate as EV
from panelforge.operators import models as M
from panelforge.operators import networks as NW
from panelforge.operators import quality as Q
from panelforge.operators import selection as S
from panelforge.operators import trees as T
from panelforge.operators.newton import Point
from panelforge.plans.catalog import register
from panelforge.plans.catalog_models import CLASS_FEATURES, CLASS_YEARS, _class_panel, _labelled, greenblatt_training
from panelforge.session import write_once

KEYS = ["YEAR", "CODE"]
#: 20 inverse penalties from 1e-5 to 1e3 for the logistic model, 10 from 1e-2 to 1e2 for the support vector classifier.
LOGISTIC = [Point(10.0 ** (-5 + 8 * i / 19)) for i in range(20)]
SVM = [Point(10.0 ** (-2 + 4 * i / 9)) for i in range(10)]
#: The same with 8 widths of the RBF kernel from 1e-5 to 10.
RBF = [Point(p.c, 10.0 ** (-5 + 6 * j / 7)) for p in SVM for j in range(8)]


@register(
    "exact_split",
    """
SELECT YEAR, CODE, RETURNS_CAT, row_number() OVER (PARTITION BY RETURNS_CAT ORDER BY md5('10|' || CAST(YEAR AS VARCHAR) || '|' || CODE), YEAR, CODE)
       <= floor(count(*) OVER (PARTITION BY RETURNS_CAT) * 0.75) AS TRAIN
FROM panel
""",
    ["panel"],
)
def exact_split(spark, base):
    """Exact 75/25 split of every class in a repeatable shuffled order."""
    return S.exact_split(_labelled(spark, base).select(*KEYS, "RETURNS_CAT"), KEYS, 0.75, ["RETURNS_CAT"])


@register(
    "stratified_folds",
    """
SELECT YEAR, CODE, RETURNS_CAT, CAST((row_number() OVER (PARTITION BY RETURNS_CAT ORDER BY md5('10|' || CAST(YEAR AS VARCHAR) || '|' || CODE), YEAR, CODE) - 1) % 10 AS INTEGER) AS FOLD
FROM panel
""",
    ["panel"],
)
def stratified_folds(spark, base):
    """Ten folds of equal size in every class."""
    return S.stratified_folds(_labelled(spark, base).select(*KEYS, "RETURNS_CAT"), KEYS, 10, ["RETURNS_CAT"])


# ---------------------------------------------------------------- classifiers


def _class_split(spark, base) -> DataFrame:
    """Labelled rows of the training years with an exact 80/20 split of each class (TRAIN), and their places in it (PLACE)."""
    p = _class_panel(spark, base).where(F.col("LABEL").isNotNull() & Q.between_closed("YEAR", *CLASS_YEARS))
    return write_once(S.exact_split(p, KEYS, 0.8, ["LABEL"], place="PLACE"), "class-split")


def _class_folds(split: DataFrame, folds: int) -> DataFrame:
    return write_once(S.stratified_folds(split.where("TRAIN").drop("PLACE"), KEYS, folds, ["LABEL"]), "class-folds")


def _grid(split: DataFrame, points, loss: str, folds: int, weighted: bool = False) -> DataFrame:
    # the training rows are the first of their class in the order in which folds are dealt: no second sort
    dealt = split.where("TRAIN").withColumn("FOLD", (F.col("PLACE") - 1) % folds)
    return S.newton_grid(dealt, CLASS_FEATURES, "LABEL", points, loss, folds, weighted)


def _best(spark, base, points, loss: str, folds: int, weighted: bool = False) -> tuple[Point, DataFrame]:
    """The best point and both sides scored by it, refitted on the training side."""
    split = _class_split(spark, base)
    point = S.best_point(_grid(split, points, loss, folds, weighted))
    scored = S.newton_refit(split, CLASS_FEATURES, "LABEL", point, loss, weighted)
    return point, write_once(scored.select(*KEYS, "LABEL", "TRAIN", "PREDICTED", *[c for c in ("PROBABILITY",) if c in scored.columns]), "scored")


def _sides(point: Point, scored: DataFrame, auc: bool) -> DataFrame:
    """Confusion matrix, rates and, from probabilities, the area under the curve on both sides."""
    parts = []
    for side, rows in (("train", scored.where("TRAIN")), ("test", scored.where("NOT TRAIN"))):
        part = EV.confusion_metrics(rows, "LABEL", "PREDICTED").withColumns({"SIDE": F.lit(side), "C": F.lit(point.c), "GAMMA": F.lit(point.gamma).cast("double")})
        parts.append(part.withColumn("AUC", EV.roc_auc(rows, "LABEL", "PROBABILITY").select("AUC").scalar()) if auc else part)
    return reduce(DataFrame.unionByName, parts)


@register("grid_search_logistic")
def grid_search_logistic(spark, base):
    """Balanced logistic regression over 20 inverse penalties: mean accuracy over 10 stratified folds, medians, moments and weights of each fold's training rows; rows-only."""
    return _grid(_class_split(spark, base), LOGISTIC, "logistic", 10, weighted=True)


@register("logistic_balanced")
def logistic_balanced(spark, base):
    """Hold-out scores of the best balanced logistic regression, refitted on the whole training side; rows-only."""
    return _best(spark, base, LOGISTIC, "logistic", 10, weighted=True)[1].where("NOT TRAIN").drop("TRAIN")


@register("holdout_confusion")
def holdout_confusion(spark, base):
    """The best logistic regression on its training side and its hold-out: confusion matrix, rates, area under the curve; rows-only."""
    return _sides(*_best(spark, base, LOGISTIC, "logistic", 10, weighted=True), auc=True)


@register("grid_search_svm")
def grid_search_svm(spark, base):
    """Linear support vector classifier (squared hinge) over 10 inverse penalties, 5 stratified folds; rows-only."""
    return _grid(_class_split(spark, base), SVM, "squared_hinge", 5)


@register("linear_svm")
def linear_svm(spark, base):
    """Hold-out scores of the best linear support vector classifier; rows-only."""
    return _best(spark, base, SVM, "squared_hinge", 5)[1].where("NOT TRAIN").drop("TRAIN")


@register("grid_search_rbf_svm")
def grid_search_rbf_svm(spark, base):
    """Support vector classifier on random Fourier features of the RBF kernel over C x gamma (10 x 8), 5 stratified folds; rows-only."""
    return _grid(_class_split(spark, base), RBF, "squared_hinge", 5)


@register("rbf_svm_best")
def rbf_svm_best(spark, base):
    """The best C and gamma of the RBF classifier, refitted: confusion matrix and rates on both sides; rows-only."""
    return _sides(*_best(spark, base, RBF, "squared_hinge", 5), auc=False)


@register("grid_search_forest_classifier")
def grid_search_forest_classifier(spark, base):
    """Random forest classifier (200 trees, sqrt features) over depth 1..19: share of errors over 10 folds from one fit of depth 19 each; rows-only."""
    folds = _class_folds(_class_split(spark, base), 10)
    est = M.classifier_estimator("forest", len(CLASS_FEATURES))
    return S.depth_grid(folds, CLASS_FEATURES, "LABEL", est, range(1, 20), 10, "wrong_class", steps=S.classifier_steps(CLASS_FEATURES, "LABEL", scaled=False), together=True)


#: Hidden layers of the three fixed networks, and the sizes of the grid.
FIXED_SHAPES = [(12, 8), (6, 10), (50, 8)]
SIZES = [(n,) for n in range(1, 31)]


@register("mlp_epochs")
def mlp_epochs(spark, base):
    """Training and validation loss of three dense networks after every epoch, and the epoch that is kept; rows-only."""
    split = _class_split(spark, base)
    fitted = S.classifier_steps(CLASS_FEATURES, "LABEL").fit(split.where("TRAIN"))
    rows = write_once(fitted.transform(split), "networks")
    return NW.loss_curves(spark, NW.fit_networks(rows.where("TRAIN"), rows.where("NOT TRAIN"), CLASS_FEATURES, "LABEL", FIXED_SHAPES))


@register("grid_search_mlp")
def grid_search_mlp(spark, base):
    """Dense networks with one hidden layer of 1..30 neurons: mean accuracy over 3 stratified folds, stopped at the lowest validation loss; rows-only."""
    return NW.network_grid(_class_folds(_class_split(spark, base), 3), CLASS_FEATURES, "LABEL", SIZES, 3)


@register("mlp_best")
def mlp_best(spark, base):
    """The network of the best size, refitted: a fifth of the training side ends the training; confusion matrix and rates on both sides; rows-only."""
    split = _class_split(spark, base)
    best = NW.network_grid(_class_folds(split, 3), CLASS_FEATURES, "LABEL", SIZES, 3).where("BEST").first().SHAPE
    hidden = tuple(map(int, best.split("-")[1:-1]))
    inner = S.exact_split(split.where("TRAIN"), KEYS, 0.8, ["LABEL"], seed=11, out="FIT")
    marked = write_once(inner.unionByName(split.where("NOT TRAIN"), allowMissingColumns=True), "network-split")
    rows = write_once(S.classifier_steps(CLASS_FEATURES, "LABEL").fit(marked.where("FIT")).transform(marked), "networks")
    nets = NW.fit_networks(rows.where("FIT"), rows.where("NOT FIT"), CLASS_FEATURES, "LABEL", [hidden])
    scored = NW.predict(rows, CLASS_FEATURES, nets).withColumn("PROBABILITY", F.col("SCORES")[0])
    scored = write_once(scored.select(*KEYS, "LABEL", "TRAIN", "PROBABILITY", (F.col("PROBABILITY") > 0.5).cast("double").alias("PREDICTED")), "scored")
    return _sides(Point(1.0), scored, auc=True).drop("C", "GAMMA").withColumn("SHAPE", F.lit(best))


# ---------------------------------------------------------------- regressors


def _rank_split(spark, base) -> DataFrame:
    """Rank features and label of the training universe with an exact 75/25 split (TRAIN)."""
    g = greenblatt_training(_labelled(spark, base)).withColumn("Y", F.col("Y").cast("double"))
    return write_once(S.exact_split(g.select(*KEYS, "X1", "X2", "Y"), KEYS, 0.75), "rank-split")


def _depth_grid(split: DataFrame, kind: str, depths) -> DataFrame:
    folds = write_once(S.stratified_folds(split.where("TRAIN"), KEYS, 10), "rank-folds")
    return S.depth_grid(folds, ["X1", "X2"], "Y", M.regression_estimator(kind), depths, 10, "squared")


def _best_depth(spark, base, kind: str, depths) -> DataFrame:
    split = _rank_split(spark, base)
    depth = int(S.best_of(_depth_grid(split, kind, depths), "DEPTH"))
    rows = M.assemble(split, ["X1", "X2"])
    model = M.regression_estimator(kind, maxDepth=depth).setFeaturesCol("features").setLabelCol("Y").fit(M.spread(rows.where("TRAIN")))
    return S.refit_scores(model.transform(rows), "Y", "prediction").withColumn("DEPTH", F.lit(depth))


@register("grid_search_tree")
def grid_search_tree(spark, base):
    """Decision tree over depth 1..9: mean squared error over 10 folds from one fit of depth 9 each; rows-only."""
    return _depth_grid(_rank_split(spark, base), "tree", range(1, 10))


@register("tree_best_depth")
def tree_best_depth(spark, base):
    """The decision tree of the best depth, refitted: MSE and R2 on both sides; rows-only."""
    return _best_depth(spark, base, "tree", range(1, 10))


@register("grid_search_forest")
def grid_search_forest(spark, base):
    """Random forest (200 trees, sqrt features) over depth 2..11: mean squared error over 10 folds from one fit of depth 11 each; rows-only."""
    return _depth_grid(_rank_split(spark, base), "forest", range(2, 12))


@register("forest_best_depth")
def forest_best_depth(spark, base):
    """The random forest of the best depth, refitted: MSE and R2 on both sides; rows-only."""
    return _best_depth(spark, base, "forest", range(2, 12))


@register("network_regression")
def network_regression(spark, base):
    """Dense network with two hidden layers of 4 on the two rank features, scaled: MSE and R2 on both sides at the epoch of the lowest held-out loss; rows-only."""
    split = _rank_split(spark, base)
    moments = M.fit_scale(split.where("TRAIN"), ["X1", "X2", "Y"])
    rows = write_once(M.scale(split, moments), "networks")
    nets = NW.fit_networks(rows.where("TRAIN"), rows.where("NOT TRAIN"), ["X1", "X2"], "Y", [(4, 4)], "squared")
    scored = NW.predict(rows, ["X1", "X2"], nets, "squared").withColumn("prediction", F.col("SCORES")[0])
    return S.refit_scores(scored, "Y", "prediction").withColumn("EPOCH", F.lit(nets[0].epoch))


@register("boosting_rounds")
def boosting_rounds(spark, base):
    """Boosted trees: mean validation loss after every round over 3 folds up to the stop, and the chosen round; rows-only."""
    g = greenblatt_training(_labelled(spark, base)).withColumn("Y", F.col("Y").cast("double"))
    rows = write_once(M.assemble(S.stratified_folds(g, KEYS, 3), ["X1", "X2"]), "boosting")
    est = M.regression_estimator("gbt", featureSubsetStrategy="all")
    best, curve = S.boosting_curve(rows, ["X1", "X2"], "Y", est, 3, "squared", 10, 500)
    return spark.createDataFrame([(k, float(v), k == best) for k, v in enumerate(curve, 1)], "ROUND int, MEAN_LOSS double, BEST boolean")


@register("feature_importance")
def feature_importance(spark, base):
    """Importance, weight and gain of every feature in a forest of 200 trees; rows-only."""
    p = _class_panel(spark, base).where(F.col("RETURNS_NEXT").isNotNull())
    rows = S.classifier_steps(CLASS_FEATURES, "RETURNS_NEXT", scaled=False).fit(p).transform(p)
    model = M.regression_estimator("forest", maxDepth=5).setFeaturesCol("features").setLabelCol("RETURNS_NEXT").fit(rows)
    return T.importance_table(model, CLASS_FEATURES, spark)
