"""Walk-forward training and model operators.

* Linear regression is solved for every target year at once: one aggregate gives
  the means and covariances of each year, the years of a window are pooled (one
  row per year and window, no panel row is copied), and column expressions solve
  the normal equations on a table with one row per target year.
* Tree ensembles, logistic regression, MLP and linear SVM use MLlib; boosting
  is ``boosting.BoostedTrees``, all folds of a window in one job per ten rounds.
  The panel is written once, partitioned by year; each target year reads only the
  years of its window. The driver loops over target years, never over rows.
  Medians, means and the number of boosting rounds are taken from the window
  alone, so that no later year can change an earlier year's score.

XGBoost is not available here; gradient-boosted trees as MLlib defines them
stand in. L1 regularisation, per-tree column sampling and native missing-value
handling have no counterpart there: features are imputed first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.ml import Estimator
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators import least_squares
from panelforge.operators.boosting import BoostedTrees
from panelforge.operators.quantiles import exact_quantiles, fold_medians_in_bracket
from panelforge.session import materialize, release_shuffles, shared_scratch, write_once


def training_windows(panel: DataFrame, target_years: Sequence[int], n_back: int, year: str = "YEAR") -> DataFrame:
    """Rows of years ``x-n_back .. x-1`` for every target year x, keyed by TARGET_YEAR."""
    t = panel.withColumn("TARGET_YEAR", F.explode(F.sequence(F.col(year) + 1, F.col(year) + n_back)))
    return t.where(F.col("TARGET_YEAR").isin(list(target_years)))


def _bucket(keys: Sequence[str], seed: int):
    """0..9999 from the MD5 of the keys: the same in every engine and run."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 10_000


def hash_split(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 10) -> tuple[DataFrame, DataFrame]:
    """Repeatable split on a hash of the keys (reruns and re-partitioning agree)."""
    cut = int(round(fraction * 10_000))
    return df.where(_bucket(keys, seed) < cut), df.where(_bucket(keys, seed) >= cut)


def year_holdout(df: DataFrame, year_held_out: int, year: str = "YEAR") -> tuple[DataFrame, DataFrame]:
    """(rows of earlier years, rows of the held-out year)."""
    return df.where(F.col(year) < year_held_out), df.where(F.col(year) == year_held_out)


def target_years(panel: DataFrame, n_back: int, year: str = "YEAR") -> list[int]:
    """The years of the panel that have a full window of ``n_back`` years before them."""
    r = panel.agg(F.min(year).alias("lo"), F.max(year).alias("hi")).first()
    return [] if r.lo is None else list(range(r.lo + n_back, r.hi + 1))


def hash_folds(df: DataFrame, keys: Sequence[str], k: int, seed: int = 10, out: str = "FOLD") -> DataFrame:
    """Folds 0..k-1 by a hash of the keys: no sort, sizes only about equal. For equal ones see ``selection.stratified_folds``."""
    return df.withColumn(out, _bucket(keys, seed) % k)


def chronological_split(df: DataFrame, key: str, order: str, fraction: float) -> DataFrame:
    """Per entity, flag the first ``int(n * fraction)`` rows as training (TRAIN = true)."""
    w = Window.partitionBy(key).orderBy(order)
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    return df.withColumn("TRAIN", F.row_number().over(w) <= F.floor(n * F.lit(fraction)))


def _complete(features: Sequence[str], y: str) -> Column:
    known = F.col(y).isNotNull()
    for f in features:
        known = known & F.col(f).isNotNull()
    return known


def _moments(train: DataFrame, features: Sequence[str], y: str, group: str) -> DataFrame:
    x = [F.col(f).cast("double") for f in features]
    return train.groupBy(group).agg(*least_squares.moments(x, [F.col(y).cast("double")], _complete(features, y)))


def window_moments(panel: DataFrame, features: Sequence[str], y: str, target_years: Sequence[int], n_back: int, year: str = "YEAR") -> DataFrame:
    """M1: moments of every target year's training window, (TARGET_YEAR, ...).

    The panel is aggregated once, to one row per year; those rows, not the
    panel's, are copied to the windows they belong to and pooled there.
    """
    yearly = _moments(panel, features, y, year).where("_n > 0")
    return least_squares.pooled(training_windows(yearly, target_years, n_back, year), "TARGET_YEAR", len(features), 1)


def solve_two(moments: DataFrame, group: str = "TARGET_YEAR") -> DataFrame:
    """M2 closed form for two features: (group, N, B0, B1, B2) from their moments; null where they are collinear."""
    v1, c12, v2, c1y, c2y = (F.col(c) for c in ("_xx_0_0", "_xx_0_1", "_xx_1_1", "_xy_0_0", "_xy_1_0"))
    det = v1 * v2 - c12 * c12
    b = moments.withColumns({"B1": F.try_divide(v2 * c1y - c12 * c2y, det), "B2": F.try_divide(v1 * c2y - c12 * c1y, det)})
    return b.select(group, F.col("_n").alias("N"), F.expr("_my_0 - B1 * _mx_0 - B2 * _mx_1").alias("B0"), "B1", "B2")


def solve_linear(moments: DataFrame, k: int, group: str = "TARGET_YEAR") -> DataFrame:
    """M2 for ``k`` features: (group, N, B0, B1..Bk) by elimination; a feature that those before it determine weighs 0.

    Without a complete row every coefficient is null.
    """
    some = F.col("_n") > 0
    weights = [F.when(some, F.col(f"_c_{i}_0")).alias(f"B{i + 1}") for i in range(k)]
    return least_squares.solve(moments, k, 1).select(group, F.col("_n").alias("N"), least_squares.constant(k).alias("B0"), *weights)


def linear_fit_two(train: DataFrame, x1: str, x2: str, y: str, group: str = "TARGET_YEAR") -> DataFrame:
    """M2 closed form, two features: (group, N, B0, B1, B2) from one grouped aggregate over the complete rows."""
    return solve_two(_moments(train, [x1, x2], y, group), group)


def linear_fit(train: DataFrame, features: Sequence[str], y: str, group: str = "TARGET_YEAR") -> DataFrame:
    """M2 for any number of features: (group, N, B0, B1..Bk) from one grouped aggregate over the complete rows."""
    return solve_linear(_moments(train, features, y, group), len(features), group)


def apply_linear(df: DataFrame, coef: DataFrame, features: Sequence[str], out: str = "PREDICTION",
                 on: tuple[str, str] = ("YEAR", "TARGET_YEAR")) -> DataFrame:
    """Score rows with the coefficients of their target year.

    The coefficient table has one row per target year.
    """
    c = coef.withColumnRenamed(on[1], on[0])
    pred = F.col("B0")
    for i, f in enumerate(features, 1):
        pred = pred + F.col(f"B{i}") * F.col(f)
    j = df.join(c, on[0])
    return j.withColumn(out, pred).drop("N", *[f"B{i}" for i in range(len(features) + 1)])


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector column; a null is an error: impute first."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def fit_medians(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact median of each feature (a few numbers); a feature without values has 0."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in features]).unpivot([], list(features), "METRIC", "__val")
    found = {r.METRIC: r.Q for r in exact_quantiles(long, "__val", [0.5], ["METRIC"]).collect()}
    return {c: found.get(c, 0.0) for c in features}


def fold_medians(df: DataFrame, features: Sequence[str], folds: int, column: str = "FOLD") -> list[dict[str, float]]:
    """``fit_medians`` of the rows outside each fold; where the fold is null, a row is in none.

    Folds drawn at random have medians close together, which one bracket per feature
    holds (``fold_medians_in_bracket``); a median that lies outside is looked for in its rows alone.
    """
    rows = df.where(F.col(column).isNotNull())
    out = fold_medians_in_bracket(rows, column, folds, features)
    for fold, found in enumerate(out):
        missed = [c for c in features if found[c] is None]
        if missed:
            found.update(fit_medians(rows.where(F.col(column) != fold), missed))
    return out


def fold_scale(df: DataFrame, features: Sequence[str], medians: Sequence[Mapping[str, float]], column: str = "FOLD") -> list[dict[str, tuple[float, float]]]:
    """``fit_scale`` of the rows outside each fold, imputed by the fold's ``medians``, from one pass over all rows.

    Each fold's count, mean and variance of the present values are taken once; those of the
    other folds and of the imputed values are put together by Chan's formula.
    """
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in features}
    named = {"n": F.count, "m": F.avg, "v": F.var_pop, "lo": F.min, "hi": F.max}
    parts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("__fold")).agg(
        F.count(F.lit(1)).alias("__rows"), *[f(v).alias(f"{name}_{i}") for i, v in enumerate(value.values()) for name, f in named.items()]).collect()  # a row per fold

    def moments(i: int, fold: int, median: float) -> tuple[float, float]:
        pieces = [(r[f"n_{i}"], r[f"m_{i}"], r[f"v_{i}"], r[f"lo_{i}"], r[f"hi_{i}"]) for r in parts if r["__fold"] != fold]
        pieces.append((sum(r["__rows"] - r[f"n_{i}"] for r in parts if r["__fold"] != fold), median, 0.0, median, median))
        pieces = [p for p in pieces if p[0]]
        if not pieces:
            return 0.0, 1.0
        if min(p[3] for p in pieces) == max(p[4] for p in pieces):  # one value: its deviation is 0, not what rounding leaves
            return pieces[0][3], 1.0
        n, mean, square = 0, 0.0, 0.0
        for k, m, v, _, _ in pieces:
            apart, n = m - mean, n + k
            mean, square = mean + apart * k / n, square + v * k + apart * apart * k * (n - k) / n
        return mean, (square / n) ** 0.5 or 1.0

    return [{c: moments(i, fold, found[c]) for i, c in enumerate(features)} for fold, found in enumerate(medians)]


def impute(df: DataFrame, medians: Mapping[str, float], indicators: bool = False) -> DataFrame:
    """Nulls and NaN replaced by the given medians, with ``<col>_ISNULL`` columns on request."""
    def missing(c: str):
        return F.col(c).isNull() | F.isnan(F.col(c).cast("double"))

    flags = {f"{c}_ISNULL": missing(c).cast("double") for c in medians} if indicators else {}
    filled = {c: F.when(missing(c), F.lit(float(m))).otherwise(F.col(c).cast("double")) for c, m in medians.items()}
    return df.withColumns({**flags, **filled})


def fit_scale(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """M13 on a window: (mean, population standard deviation) of each feature."""
    r = df.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(features) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (r[f"m_{i}"] or 0.0, r[f"s_{i}"] or 1.0) for i, c in enumerate(features)}


def scale(df: DataFrame, moments: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(float(m))) / F.lit(float(s)) for c, (m, s) in moments.items()})


def class_weights(df: DataFrame, label: str, out: str = "WEIGHT") -> DataFrame:
    """M8: balanced weights ``n / (k * n_c)``.

    The input is written once. n and k come from the class-count table, which has
    one row per class and is joined back.
    """
    df = write_once(df, "class-weights")
    counts = write_once(df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc")).where(F.col(label).isNotNull()), "class-counts")
    n, k = counts.select(F.sum("__nc")).scalar(), counts.select(F.count(F.lit(1))).scalar()
    return df.join(counts, label).withColumn(out, n / (k * F.col("__nc"))).drop("__nc")


def spread(df: DataFrame, least: int = 8) -> DataFrame:
    """``df`` on ``least`` partitions at least: a forest works on every row once per tree and level, however few the bytes.

    The number is fixed, as the rows drawn for a tree depend on the partitions: clusters of any size grow the same trees.
    """
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least)


def regression_estimator(kind: str, seed: int = 10, **params):
    """Regressor (MLlib, boosting apart) for ``kind`` in {linear, tree, forest, gbt}, defaults as the reference grids.

    Forests keep the node of every row and tree between levels, instead of walking all rows down from the roots at each.
    """
    if kind == "linear":
        return LinearRegression(solver="normal", regParam=0.0, **params)
    if kind == "tree":
        return DecisionTreeRegressor(seed=seed, **params)
    if kind == "forest":
        return RandomForestRegressor(numTrees=params.pop("numTrees", 200), featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True, **params)
    if kind == "gbt":
        return BoostedTrees("squared", maxDepth=params.pop("maxDepth", 5), stepSize=params.pop("stepSize", 0.15),
                            featureSubsetStrategy=params.pop("featureSubsetStrategy", "0.7"), seed=seed, **params)
    raise ValueError(kind)


def classifier_estimator(kind: str, n_features: int, seed: int = 10, **params):
    """Classifier (MLlib, boosting apart) for ``kind`` in {forest, gbt, logistic, mlp, svm}."""
    if kind == "forest":
        return RandomForestClassifier(numTrees=params.pop("numTrees", 200), featureSubsetStrategy="sqrt",
                                      maxDepth=params.pop("maxDepth", 5), seed=seed, cacheNodeIds=True, **params)
    if kind == "gbt":
        return BoostedTrees("logistic", maxDepth=params.pop("maxDepth", 10), stepSize=params.pop("stepSize", 0.015),
                            minInstancesPerNode=6, subsamplingRate=0.7, maxIter=params.pop("maxIter", 50),
                            seed=seed, **params)
    if kind == "logistic":
        return LogisticRegression(elasticNetParam=0.0, standardization=False, **params)
    if kind == "mlp":
        return MultilayerPerceptronClassifier(layers=params.pop("layers", [n_features, 12, 8, 2]), seed=seed,
                                              maxIter=params.pop("maxIter", 200), **params)
    if kind == "svm":
        return LinearSVC(**params)
    raise ValueError(kind)


def walk_forward_fit_predict(panel: DataFrame, features: Sequence[str], label: str, target_years: Sequence[int],
                             n_back: int, estimator, score_rows: DataFrame, year: str = "YEAR", probability: bool = False,
                             parallelism: int = 4, fill: bool = False, standardise: str | None = None,
                             keep: Sequence[str] = ("YEAR", "CODE"), tune: Callable[[DataFrame], Estimator] | None = None,
                             carry: Sequence[str] = ()) -> DataFrame:
    """M1 with an MLlib estimator: for each target year fit on the window, score that year.

    The training rows are written once, partitioned by year, and each fit reads
    only the years ``x - n_back .. x - 1``. The per-year fits are independent
    distributed jobs, submitted from up to ``parallelism`` driver threads.
    ``fill`` imputes the window's medians; ``standardise`` is ``"window"`` (the
    window's moments for both) or ``"own"`` (the scored year by its own moments).
    Every row of a target year comes back: its prediction is null if it lacks a
    feature or if the window has no training rows. ``probability=True`` adds
    PROBABILITY (of class 1) for classifiers. ``tune`` gives the estimator to fit
    for the assembled training rows of a window, which then also hold the columns
    ``carry`` (folds, for instance). Columns: ``keep``, PREDICTION.
    """
    from concurrent.futures import ThreadPoolExecutor

    columns = [*keep, *features]
    train_cols = dict.fromkeys([year, *features, label, *carry])
    root = shared_scratch(panel.sparkSession, "walk-forward")
    panel.where(F.col(label).isNotNull()).select(*train_cols, F.col(year).alias("__part")).write.partitionBy("__part").parquet(root)
    spark = panel.sparkSession
    schema = panel.select(*train_cols, F.col(year).cast("int").alias("__part")).schema
    rows = write_once(score_rows.where(F.col(year).isin(list(target_years))).select(*dict.fromkeys([*columns, year])), "walk-forward-rows")
    release_shuffles(spark)  # those that built the panel
    empty = {"PREDICTION": F.lit(None).cast("double"), **({"PROBABILITY": F.lit(None).cast("double")} if probability else {})}

    def fit_year(x: int):
        train = spark.read.schema(schema).parquet(root).where(F.col("__part").between(x - n_back, x - 1)).drop("__part")
        own = rows.where(F.col(year) == x)
        if fill:
            medians = fit_medians(train, features)
            train, own = impute(train, medians), impute(own, medians)
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in features])
        train, blank, own = train.where(known), own.where(~known), own.where(known)
        if train.isEmpty():
            return [own.select(*keep).withColumns(empty), blank.select(*keep).withColumns(empty)]
        if standardise:
            moments = fit_scale(train, features)
            train, own = scale(train, moments), scale(own, moments if standardise == "window" else fit_scale(own, features))
        ready = assemble(train, features)
        if tune:
            ready = write_once(ready.hint("rebalance"), "walk-forward-window")  # partitions by size: a fit runs many jobs over them
        model = (tune(ready) if tune else estimator).copy().setFeaturesCol("features").setLabelCol(label).fit(ready)
        s = model.transform(assemble(own, features))
        if probability:
            s = s.withColumn("PROBABILITY", vector_to_array("probability").getItem(1))
        s = s.withColumn("PREDICTION", F.col("prediction").cast("double"))
        return [s.select(*keep, *empty), blank.select(*keep).withColumns(empty)]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = [p for found in pool.map(fit_year, list(target_years)) for p in found]
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else rows.select(*keep).withColumns(empty).where(F.lit(False))


def grid_search(df: DataFrame, features: Sequence[str], label: str, estimator, grid: dict, folds: int = 10,
                evaluator=None, seed: int = 10) -> DataFrame:
    """K-fold cross validation over a parameter grid, for regressors and classifiers.

    ``evaluator`` defaults to the root mean squared error; pass a
    ``MulticlassClassificationEvaluator`` or ``BinaryClassificationEvaluator``
    for classifiers. Returns one row per grid point with the mean and standard
    deviation over the folds; ``CrossValidator(parallelism)`` fits grid points
    concurrently.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(getattr(estimator, name), list(values))
    maps = builder.build()
    evaluator = evaluator if evaluator is not None else RegressionEvaluator(metricName="rmse")
    cv = CrossValidator(estimator=estimator.setFeaturesCol("features").setLabelCol(label), estimatorParamMaps=maps, numFolds=folds,
                        seed=seed, parallelism=4, evaluator=evaluator.setLabelCol(label))
    model = cv.fit(materialize(assemble(df, features).select("features", label)))
    rows = []
    for pm, avg, std in zip(maps, model.avgMetrics, model.stdMetrics):
        rows.append((", ".join(f"{p.name}={v}" for p, v in pm.items()), float(avg), float(std)))
    return df.sparkSession.createDataFrame(rows, "PARAMS string, MEAN_METRIC double, STD_METRIC double")

