"""Model selection: exact splits and folds, preprocessing fitted inside the folds, grids, early-stopped rounds, refits.

A fold is a column. For each fold the preprocessing pipeline is fitted to the
other folds alone and applied to both sides, which are written once; every grid
point is fitted on the written training rows. What the driver collects is one
number per fold and grid point.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

import numpy as np
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.base import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators import forests as FR
from panelforge.operators import models as M
from panelforge.operators import newton as N
from panelforge.operators import trees as T
from panelforge.operators.boosting import BoostedTrees
from panelforge.operators.ordered import row_numbers
from panelforge.session import write_once

#: Folds that are worked on at the same time; their Spark jobs are independent.
PARALLEL = 4


# ---------------------------------------------------------------- exact splits and folds


def hash_places(df: DataFrame, keys: Sequence[str], by: Sequence[str] = (), seed: int = 10, out: str = "PLACE", size: str | None = None) -> DataFrame:
    """1, 2, ... in each group of ``by``, in the order of the MD5 of the keys: a repeatable shuffle, the same in every engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    marked = df.withColumn("__hash", F.md5(text.cast("binary")))
    return row_numbers(marked, list(by), [F.col("__hash").asc(), *[F.col(k).asc() for k in keys]], out, size).drop("__hash")


def exact_split(df: DataFrame, keys: Sequence[str], fraction: float, by: Sequence[str] = (), seed: int = 10, out: str = "TRAIN",
                place: str | None = None) -> DataFrame:
    """``floor(n * fraction)`` rows of each group of ``by`` are marked as training rows (``out`` = true), exactly.

    ``place`` names a column for the row's place in its group; the training rows are the first ones.
    """
    placed = hash_places(df, keys, by, seed, "__place", "__n").withColumn(out, F.col("__place") <= F.floor(F.col("__n") * F.lit(fraction)))
    return (placed.withColumn(place, F.col("__place")) if place else placed).drop("__place", "__n")


def stratified_folds(df: DataFrame, keys: Sequence[str], k: int, by: Sequence[str] = (), seed: int = 10, out: str = "FOLD") -> DataFrame:
    """Folds 0..k-1 whose sizes differ by at most one in each group of ``by``."""
    return hash_places(df, keys, by, seed, "__place").withColumn(out, (F.col("__place") - 1) % k).drop("__place")


# ---------------------------------------------------------------- preprocessing as pipeline stages


class _Fitted(Model):
    """A model that is a function of a DataFrame."""

    def __init__(self, apply: Callable[[DataFrame], DataFrame], learned):
        super().__init__()
        self.apply, self.learned = apply, learned

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.apply(dataset)


class MedianImputer(Estimator):
    """Nulls and NaN become the medians of the rows it is fitted to, with indicator columns on request."""

    def __init__(self, features: Sequence[str], indicators: bool = False):
        super().__init__()
        self.features, self.indicators = list(features), indicators

    def _fit(self, dataset: DataFrame) -> _Fitted:
        medians = M.fit_medians(dataset, self.features)
        return _Fitted(lambda df: M.impute(df, medians, self.indicators), medians)


class Standardizer(Estimator):
    """Mean 0 and standard deviation 1 of the rows it is fitted to."""

    def __init__(self, features: Sequence[str]):
        super().__init__()
        self.features = list(features)

    def _fit(self, dataset: DataFrame) -> _Fitted:
        moments = M.fit_scale(dataset, self.features)
        return _Fitted(lambda df: M.scale(df, moments), moments)


class BalancedWeights(Estimator):
    """M8: weight n / (k * n_c) from the class counts of the rows it is fitted to; a class not seen there has weight 0."""

    def __init__(self, label: str, out: str = "WEIGHT"):
        super().__init__()
        self.label, self.out = label, out

    def _fit(self, dataset: DataFrame) -> _Fitted:
        return self.of({r[0]: r[1] for r in dataset.where(F.col(self.label).isNotNull()).groupBy(self.label).count().collect()})  # one row per class

    def of(self, counts: dict) -> _Fitted:
        weights = {c: sum(counts.values()) / (len(counts) * n) for c, n in counts.items()}
        weight = F.lit(0.0)
        for c, w in weights.items():
            weight = F.when(F.col(self.label) == F.lit(c), F.lit(float(w))).otherwise(weight)
        return _Fitted(lambda df: df.withColumn(self.out, weight), weights)


class Assembler(Transformer):
    """The feature vector column ``features``."""

    def __init__(self, features: Sequence[str]):
        super().__init__()
        self.features = list(features)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return M.assemble(dataset, self.features)


def classifier_steps(features: Sequence[str], label: str, weighted: bool = False, scaled: bool = True, indicators: bool = False) -> Pipeline:
    """Imputing, scaling, weighting and assembling, to be fitted to training rows alone."""
    flags = [f"{c}_ISNULL" for c in features] if indicators else []
    stages = [MedianImputer(features, indicators)]
    stages += [Standardizer(features)] if scaled else []
    stages += [BalancedWeights(label)] if weighted else []
    return Pipeline(stages=[*stages, Assembler([*features, *flags])])


# ---------------------------------------------------------------- cross validation


def _each(work: Callable, items: Sequence) -> list:
    with ThreadPoolExecutor(max_workers=PARALLEL) as pool:
        return list(pool.map(work, items))


def fold_steps(df: DataFrame, features: Sequence[str], label: str, folds: int, weighted: bool = False, column: str = "FOLD") -> list[PipelineModel]:
    """``classifier_steps`` fitted to the training rows of every fold, from three passes over all rows for all folds together.

    Medians are exact (``fold_medians``); means, deviations and class counts of a fold's
    training rows are put together from those of the other folds.
    """
    features = list(features)
    medians = M.fold_medians(df, features, folds, column)
    moments = M.fold_scale(df, features, medians, column)
    out = []
    counts = df.where(F.col(column).isNotNull() & F.col(label).isNotNull()).groupBy(column, label).count().collect() if weighted else []  # folds x classes
    for fold in range(folds):
        stages = [_Fitted(partial(M.impute, medians=medians[fold]), medians[fold]), _Fitted(partial(M.scale, moments=moments[fold]), moments[fold])]
        if weighted:
            of: dict = {}
            for k, c, n in counts:
                if k != fold:
                    of[c] = of.get(c, 0) + n
            stages.append(BalancedWeights(label).of(of))
        out.append(PipelineModel([*stages, Assembler(features)]))
    return out


def fitted_folds(df: DataFrame, steps: Pipeline, folds: int, column: str = "FOLD") -> list[PipelineModel]:
    """``steps`` fitted to the training rows of every fold; where only medians are learned, those of all folds are found together."""
    imputer, *others = steps.getStages() or [None]
    if isinstance(imputer, MedianImputer) and not imputer.indicators and not any(isinstance(s, Estimator) for s in others):
        medians = M.fold_medians(df, imputer.features, folds, column)
        return [PipelineModel([_Fitted(partial(M.impute, medians=found), found), *others]) for found in medians]
    return _each(lambda fold: steps.fit(df.where(F.col(column) != fold)), range(folds))


def fold_sides(df: DataFrame, fold: int, steps: Pipeline | PipelineModel | None, column: str = "FOLD") -> tuple[DataFrame, DataFrame]:
    """(training, validation) rows of a fold, prepared by steps fitted to the training rows (here, if they are not yet), written once."""
    train, valid = df.where(F.col(column) != fold), df.where(F.col(column) == fold)
    if steps is not None:
        fitted = steps.fit(train) if isinstance(steps, Pipeline) else steps
        train, valid = fitted.transform(train), fitted.transform(valid)
    # partitions by size: a fit runs many jobs over them
    return write_once(train.hint("rebalance"), "fold-train"), write_once(valid.hint("rebalance"), "fold-valid")


def _table(spark, name: str, points: Sequence[float], scores: np.ndarray, smaller: bool) -> DataFrame:
    """One row per grid point: mean and standard deviation over the folds, and whether it is the best (the first of equals)."""
    mean, std = scores.mean(0), scores.std(0)
    best = int(mean.argmin() if smaller else mean.argmax())
    rows = [(float(p), float(m), float(s), k == best) for k, (p, m, s) in enumerate(zip(points, mean, std))]
    return spark.createDataFrame(rows, f"{name} double, MEAN_METRIC double, STD_METRIC double, BEST boolean")


def best_of(grid: DataFrame, name: str) -> float:
    return grid.where("BEST").select(name).first()[0]


def newton_grid(df: DataFrame, features: Sequence[str], label: str, points: Sequence[N.Point], loss: str, folds: int, weighted: bool = False,
                column: str = "FOLD") -> DataFrame:
    """Mean accuracy of penalised linear classifiers over the folds: C, GAMMA (null without a kernel), MEAN_METRIC, STD_METRIC, BEST.

    The preparation of all folds is fitted together; all points of a fold are
    fitted together, and scored in one pass over its validation rows.
    """
    steps = fold_steps(df, features, label, folds, weighted, column)

    def one(fold: int) -> list[float]:
        train, valid = fold_sides(df, fold, steps[fold], column)
        betas = N.fit_points(train, features, label, points, loss, "WEIGHT" if weighted else None)
        wrong = T.staged_loss(valid, features, label, N.raw_scores(points, betas, len(features)), "wrong_sign")
        return [1 - r.LOSS / r.N for r in wrong.orderBy("STAGE").collect()]

    scores = np.array(_each(one, range(folds)))
    mean, std = scores.mean(0), scores.std(0)
    rows = [(p.c, p.gamma, float(m), float(s), k == int(mean.argmax())) for k, (p, m, s) in enumerate(zip(points, mean, std))]
    return df.sparkSession.createDataFrame(rows, "C double, GAMMA double, MEAN_METRIC double, STD_METRIC double, BEST boolean")


def best_point(grid: DataFrame) -> N.Point:
    best = grid.where("BEST").first()
    return N.Point(best.C, best.GAMMA)


def newton_refit(split: DataFrame, features: Sequence[str], label: str, point: N.Point, loss: str, weighted: bool = False, side: str = "TRAIN") -> DataFrame:
    """The rows of both sides with PREDICTED (and PROBABILITY for the logistic loss) of the point fitted to the training side."""
    fitted = classifier_steps(features, label, weighted).fit(split.where(side))
    train = write_once(fitted.transform(split.where(side)), "refit")
    beta = N.fit_points(train, features, label, [point], loss, "WEIGHT" if weighted else None)[0]
    return N.predict(fitted.transform(split), features, point, beta, probability=loss == "logistic")


def depth_grid(df: DataFrame, features: Sequence[str], label: str, estimator, depths: Sequence[int], folds: int, loss: str, column: str = "FOLD",
               steps: Pipeline | None = None, together: bool = False) -> DataFrame:
    """M3-M5: mean loss of each depth over the folds, from one fit of the greatest depth per fold.

    ``together`` grows the classifying forests of all folds side by side (``forests``), as far as
    a fold's rows can meet in a task; beyond that, each fold is fitted by MLlib.
    """
    steps = steps or Pipeline(stages=[Assembler(features)])
    if together:
        sizes = {r[0]: (r[1], r[2]) for r in df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)), F.max(label)).collect()}  # a row per fold
        rows = sum(n for n, _ in sizes.values())
        if any(not 0 < sizes.get(k, (0, 0))[0] < rows for k in range(folds)):
            raise ValueError("a fold has no rows to learn from or to be scored")
        if FR.fits_in_task(rows, len(features)):
            classes = max(2, int(max(top for _, top in sizes.values())) + 1)
            known = df.where(F.col(column).isNotNull()).withColumn("__draw", F.xxhash64(*[c for c, kind in df.dtypes if kind != "vector"]))
            of = [m.transform(known).select(F.lit(k).alias("__fit"), vector_to_array("features").alias("__x"), F.col(label).cast("double").alias("__y"),
                                            F.col(column).cast("int").alias("__fold"), "__draw") for k, m in enumerate(fitted_folds(df, steps, folds, column))]
            losses = FR.depth_losses(reduce(DataFrame.unionAll, of), FR.Forest.of(estimator), folds, len(features), classes, depths, loss)
            return _table(df.sparkSession, "DEPTH", depths, losses, smaller=True)

    def one(fold: int) -> list[float]:
        train, valid = fold_sides(df, fold, steps, column)
        model = estimator.copy().setFeaturesCol("features").setLabelCol(label).setMaxDepth(max(depths)).fit(M.spread(train))
        return [r.LOSS / r.N for r in T.depth_loss(model, valid, features, label, depths, loss).orderBy("STAGE").collect()]

    return _table(df.sparkSession, "DEPTH", depths, np.array(_each(one, range(folds))), smaller=True)


def early_stop(curve: Sequence[float], patience: int) -> int | None:
    """Rounds up to the best one, once ``patience`` rounds after it bring nothing better; None while that is open."""
    best = 0
    for k, value in enumerate(curve):
        if value < curve[best]:
            best = k
        elif k - best >= patience:
            return best + 1
    return None


def boosting_curve(df: DataFrame, features: Sequence[str], label: str, estimator: BoostedTrees, folds: int, loss: str, patience: int = 10, most: int = 300,
                   first: int = 16, column: str = "FOLD") -> tuple[int, np.ndarray]:
    """M6/M7: (number of rounds, mean validation loss after every round), by k-fold cross validation with early stopping.

    All folds are boosted together, round by round, until the rule stops or
    ``most`` is reached; a fold without training or validation rows is left out,
    and without any fold ``first`` rounds are returned. ``df`` has the assembled
    ``features`` column.
    """
    sizes = {r[0]: r[1] for r in df.where(F.col(column).isNotNull()).groupBy(column).count().collect()}  # one row per fold
    held = [k for k in range(folds) if 0 < sizes.get(k, 0) < sum(sizes.values())]
    if not held:
        return min(first, most), np.empty(0)
    fit = estimator.copy().setFeaturesCol("features").setLabelCol(label).setMaxIter(most)
    mean = fit.boost(df, held, column, loss, lambda curves: early_stop(curves.mean(1), patience) is not None, keep=False)[1].mean(1)
    stop = early_stop(mean, patience)
    return stop or int(mean.argmin()) + 1, mean


def refit_scores(df: DataFrame, label: str, predicted: str, side: str = "TRAIN") -> DataFrame:
    """MSE and R2 on the training and the held-out rows."""
    error, y = F.col(label) - F.col(predicted), F.col(label)
    sums = df.groupBy(F.when(F.col(side), "train").otherwise("test").alias("SIDE")).agg(
        F.count(F.lit(1)).alias("N"), F.avg(error * error).alias("MSE"), F.var_pop(y).alias("__var")
    )
    return sums.select("SIDE", "N", "MSE", (1 - F.col("MSE") / F.col("__var")).alias("R2"))
