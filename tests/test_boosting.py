import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from panelforge.operators import boosting as B
from panelforge.operators import models as M
from panelforge.operators import selection as S


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((900, 3))
    y = 2 * x[:, 0] * (x[:, 1] > 0) + x[:, 2] ** 2
    found = [(k, *map(float, r), float(v), float(v > 1), k % 3) for k, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(found, "ID long, A double, B double, C double, Y double, Z double, FOLD int")
    return S.write_once(M.assemble(df, ["A", "B", "C"]), "boosted")


def test_scores_come_near_those_of_mllib(rows):
    train, test = rows.where("FOLD <> 0"), rows.where("FOLD = 0")
    own = B.BoostedTrees("squared", maxDepth=4, stepSize=0.2, maxIter=8).setLabelCol("Y").fit(train).transform(test)
    theirs = GBTRegressor(maxDepth=4, stepSize=0.2, maxIter=8, labelCol="Y").fit(train).transform(test)
    errors = [d.agg(F.avg((F.col("prediction") - F.col("Y")) ** 2)).first()[0] for d in (own, theirs)]
    assert errors[0] == pytest.approx(errors[1], rel=0.15)
    own = B.BoostedTrees("logistic", maxDepth=4, stepSize=0.2, maxIter=8).setLabelCol("Z").fit(train).transform(test)
    theirs = GBTClassifier(maxDepth=4, stepSize=0.2, maxIter=8, labelCol="Z").fit(train).transform(test)
    probability = M.vector_to_array("probability")[1].alias("p")
    p, q = (np.array([r.p for r in d.orderBy("ID").select(probability).collect()]) for d in (own, theirs))
    assert np.abs(p - q).mean() < 0.03 and ((p > 0.5) == (q > 0.5)).mean() > 0.95


def test_the_same_trees_whether_nodes_are_split_by_levels_or_finished_in_a_task(rows, monkeypatch):
    est = B.BoostedTrees("logistic", maxDepth=5, stepSize=0.3, maxIter=3, subsamplingRate=0.7, featureSubsetStrategy="0.7", minInstancesPerNode=4, keys=["ID"]).setLabelCol("Z")
    scores = []
    for most in (20_000, 150, 0):  # one task, levels and then tasks on six partitions, levels alone
        monkeypatch.setattr(B, "ROWS", most or 1)
        data = rows if most else rows.where("ID < 60")
        model = est.fit(data)
        scores.append([r.prediction for r in model.transform(rows).orderBy("ID").collect()] + [round(float(t.value.sum()), 9) for t in model.trees])
    monkeypatch.setattr(B, "ROWS", 20_000)
    alone = est.fit(rows.where("ID < 60"))
    assert scores[0] == scores[1]
    assert scores[2][-3:] == [round(float(t.value.sum()), 9) for t in alone.trees]


def test_folds_share_their_jobs(spark, rows):
    """Three folds of two rounds cost the jobs of one; MLlib ran a job per fold, round and level."""
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for held in ([0], [0, 1, 2]):
        spark.sparkContext.setJobGroup(f"boost-{len(held)}", "", False)
        B.BoostedTrees("squared", maxDepth=5, maxIter=2).setLabelCol("Y").boost(rows, held, "FOLD", "squared")
        jobs.append(len(tracker.getJobIdsForGroup(f"boost-{len(held)}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] <= 12
