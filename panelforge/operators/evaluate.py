"""Evaluation operators.

All metrics are plain aggregates over the rows in which both sides are known. The
ROC curve collapses scores to distinct values and sums them up in descending
order over range partitions (``operators.ordered``), whatever their distribution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.columns import round_to_class, threshold_flag
from panelforge.operators.ordered import running_totals
from panelforge.operators.ranks import dense_rank_by
from panelforge.session import write_once


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """MSE, RMSE and R^2 (1 - SSE/SST) over the complete pairs; N is their number."""
    both = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    y = F.when(both, F.col(label))
    err = F.pow(F.col(label) - F.col(prediction), 2)
    aggs = [
        F.count(y).alias("N"),
        F.avg(err).alias("MSE"),
        F.sqrt(F.avg(err)).alias("RMSE"),
        (1 - F.try_divide(F.sum(err), F.var_pop(y) * F.count(y))).alias("R2"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def confusion_metrics(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Tn, fp, fn, tp and accuracy, sensitivity, specificity, precision, F1.

    A rate whose denominator is zero (an empty class) is null.
    """
    y, p = F.col(label), F.col(predicted)
    aggs = [
        F.count(F.when((y == 0) & (p == 0), 1)).alias("TN"),
        F.count(F.when((y == 0) & (p == 1), 1)).alias("FP"),
        F.count(F.when((y == 1) & (p == 0), 1)).alias("FN"),
        F.count(F.when((y == 1) & (p == 1), 1)).alias("TP"),
    ]
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    tn, fp, fn, tp = (F.col(c) for c in ("TN", "FP", "FN", "TP"))
    sen = F.try_divide(tp, tp + fn)
    ppv = F.try_divide(tp, tp + fp)
    return g.select(
        *by, "TN", "FP", "FN", "TP",
        F.try_divide(tp + tn, tp + tn + fp + fn).alias("ACC"),
        sen.alias("SEN"),
        F.try_divide(tn, tn + fp).alias("ESP"),
        ppv.alias("PPV"),
        F.try_divide(2 * ppv * sen, ppv + sen).alias("FSC"),
    )


def accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Share of equal labels among the N rows in which both are known."""
    equal = (F.col(label) == F.col(predicted)).cast("double")
    return df.agg(F.avg(equal).alias("ACCURACY"), F.count(equal).alias("N"))


def _roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """(THRESHOLD, POS, NEG, TP, FP) per distinct score; rows with a null score or label are ignored."""
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    points = known.groupBy(F.col(score).alias("THRESHOLD")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("POS"), F.count(F.when(F.col(label) == 0, 1)).alias("NEG")
    )
    return write_once(running_totals(points, [], [F.col("THRESHOLD").desc()], {"TP": F.col("POS"), "FP": F.col("NEG")}), "roc")


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC points (THRESHOLD, TP, FP, FPR, TPR) by descending score, ties grouped."""
    points = _roc_points(df, label, score)
    p, n = points.select(F.sum("POS")).scalar(), points.select(F.sum("NEG")).scalar()
    return points.select("THRESHOLD", "TP", "FP", F.try_divide(F.col("FP"), n).alias("FPR"), F.try_divide(F.col("TP"), p).alias("TPR"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve (trapezoids between consecutive points, ties grouped).

    Equal to the Mann-Whitney statistic: for each distinct score, the negatives
    at that score times (positives with a higher score + half the positives at
    that score), over P*N.
    """
    num = F.sum(F.col("NEG") * (F.col("TP") - F.col("POS") + 0.5 * F.col("POS")))
    return _roc_points(df, label, score).agg(
        F.try_divide(num, F.sum("POS") * F.sum("NEG")).alias("AUC"), F.sum("POS").alias("POSITIVES"), F.sum("NEG").alias("NEGATIVES")
    )


def classify(df: DataFrame, probability: str, out: str = "PREDICTED") -> DataFrame:
    """Probability -> class with half-to-even rounding."""
    return df.withColumn(out, round_to_class(probability))


def high_probability_picks(df: DataFrame, probability: str, threshold: float = 0.8, keep: Sequence[str] = ()) -> DataFrame:
    """Predictions with probability above ``threshold``, with both class probabilities."""
    out = df.withColumn("PROB_1", F.col(probability)).withColumn("PROB_0", 1 - F.col(probability))
    out = out.withColumn("HIGH_PRECISION", threshold_flag(probability, threshold))
    return out.where(F.col("HIGH_PRECISION")).select(*keep, "PROB_0", "PROB_1", "HIGH_PRECISION")


# Output names of the scored metrics table.
SCORE_TABLE_NAMES = {
    "VQ_MARKET_CAP": "CAP",
    "IS_EPS_BASIC": "EPS",
    "IS__REVENUE": "REVENUE",
    "VR_PE_RATIO": "PER",
    "VQ__PIOTROSKI_F_SCORE": "PIOTROSKI",
}
SCORE_TABLE_COLUMNS = ["YEAR", "CODE", "CAP", "EPS", "REVENUE", "PER", "PIOTROSKI", "PRICE_START", "PRICE_END",
                       "RETURNS", "RISK"]


def score_table(panel: DataFrame, scores: DataFrame, score: str, ascending: bool = True, rank_name: str = "RANKING",
                keys: Sequence[str] = ("YEAR", "CODE")) -> DataFrame:
    """Join scores to the panel on (YEAR, CODE) -- rows without a score
    vanish --, dense-rank the score within the year, rename to the metrics layout."""
    j = panel.withColumnsRenamed(SCORE_TABLE_NAMES).join(scores.select(*keys, score), list(keys))
    r = dense_rank_by(j, score, ("YEAR",), ascending=ascending, out=rank_name)
    return r.select(*SCORE_TABLE_COLUMNS, score, rank_name)
