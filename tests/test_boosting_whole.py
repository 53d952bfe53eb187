"""Boosting in which a task keeps the rows of a fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import boosting as B
from panelforge.operators import models as M
from panelforge.operators import selection as S

XS = ["A", "B", "C", "D"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(15)
    x = np.round(rng.standard_normal((800, 4)), 1)  # many equal values
    y = 2 * x[:, 0] * (x[:, 1] > 0) + x[:, 2] ** 2 + rng.standard_normal(800)
    found = [(k, *map(float, r), float(v), float(v > 1), k % 4) for k, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(found, "ID long, A double, B double, C double, D double, Y double, Z double, FOLD int")
    return S.write_once(M.assemble(df, XS), "whole")


def estimator(loss, **params):
    est = B.BoostedTrees(loss, **({"maxDepth": 6, "stepSize": 0.3, "maxIter": 4, "minInstancesPerNode": 3, "keys": ["ID"]} | params))
    return est.setLabelCol("Y" if loss == "squared" else "Z")


def count_jobs(spark, name, work):
    spark.sparkContext.setJobGroup(name, "", False)
    work()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_rounds_share_their_jobs(spark, rows):
    """Ten rounds are one job, whatever the folds; there were several jobs per round."""
    est = estimator("logistic", maxIter=20)
    jobs = [count_jobs(spark, f"whole-{len(held)}", lambda held=held: est.boost(rows, held, "FOLD", "wrong_sign")) for held in ([1], [0, 1, 2, 3])]
    assert jobs[0] == jobs[1] <= 10


def test_a_refit_is_one_job(spark, rows):
    assert count_jobs(spark, "refit", lambda: estimator("logistic", maxIter=25).fit(rows)) <= 8


@pytest.mark.parametrize(("loss", "params"), [("logistic", {"subsamplingRate": 0.7}), ("squared", {"featureSubsetStrategy": "0.6"}), ("logistic", {"minInstancesPerNode": 1, "maxDepth": 9})])
def test_the_same_fits_as_by_levels(rows, monkeypatch, loss, params):
    est, held = estimator(loss, **params), [0, 2, None]
    score = "log" if loss == "logistic" else "squared"
    trees, curves = est.boost(rows, held, "FOLD", score)
    monkeypatch.setattr(B, "ROWS", 100)
    monkeypatch.setattr(B.BoostedTrees, "_whole_rounds", lambda *a: pytest.fail("more rows than a task takes"))
    others, expected = est.boost(rows, held, "FOLD", score)
    assert np.allclose(curves, expected, atol=1e-9) and curves.shape == (4, 3)
    x = np.array([r.features.toArray() for r in rows.select("features").collect()])
    for own, other in zip(trees, others):
        assert [len(t.left) for t in own] == [len(t.left) for t in other]
        assert all(np.allclose(a.value[a.ends(x)], b.value[b.ends(x)], atol=1e-9) for a, b in zip(own, other))


def test_cells_of_larger_children_are_what_is_left():
    """Against sums of every node's own rows."""
    rng = np.random.default_rng(2)
    bins, target, used = rng.integers(0, 32, (5, 700)).astype(np.uint8), rng.standard_normal(700), rng.random(700) < 0.7
    est = B.BoostedTrees("squared", maxDepth=7, minInstancesPerNode=2)
    tree, node = est._grown(bins, used, target, 1)
    assert (tree.ends(bins.T) == node).all()
    todo, inner = [(0, used, 0)], 0
    while todo:
        k, own, level = todo.pop()
        assert tree.value[k] == pytest.approx(target[own].mean())
        cells = [np.stack([np.bincount(b[own], w, 32) for b in bins]) for w in (np.ones(own.sum()), target[own])]
        best = B.best_split(cells[0], cells[1], 2, np.ones(5, bool)) if own.sum() >= 4 and level < 7 else None
        if best is None:
            assert tree.left[k] < 0
            continue
        assert (tree.feature[k], tree.threshold[k]) == best[:2]
        goes, inner = bins[best[0]] <= best[1], inner + 1
        todo += [(tree.left[k], own & goes, level + 1), (tree.right[k], own & ~goes, level + 1)]
    assert inner > 30 and 2 * inner + 1 == len(tree.left)


def test_boosting_ends_with_the_round_that_stops_it(rows):
    trees, curves = estimator("squared", maxIter=30).boost(rows, [0, 1], "FOLD", "squared", stop=lambda c: len(c) == 13)
    assert curves.shape == (13, 2) and [len(t) for t in trees] == [13, 13]
    whole, more = estimator("squared", maxIter=30).boost(rows, [0, 1], "FOLD", "squared", keep=False)
    assert np.allclose(more[:13], curves) and more.shape == (30, 2) and whole == [[], []]


def test_the_same_fits_on_any_partitions(rows):
    est = estimator("logistic", subsamplingRate=0.8)
    scored = [est.fit(df).transform(rows).orderBy("ID").select(M.vector_to_array("probability")[1].alias("p")).collect() for df in (rows, rows.repartition(7))]
    assert np.allclose(*[[r.p for r in s] for s in scored], atol=1e-9)


def test_fits_without_rows(rows):
    empty = estimator("squared").fit(rows.where("ID < 0")).transform(rows)
    assert empty.agg(F.max("prediction"), F.min("prediction")).first() == (0.0, 0.0)
    one = estimator("squared", maxIter=2).fit(rows.where("ID = 5"))
    assert [len(t.left) for t in one.trees] == [1, 1]


def test_edges_are_quantiles_of_the_rows_a_fit_learns_from(spark, rows, monkeypatch):
    few = rows.select(F.col("features").alias("f"), "FOLD").select(M.vector_to_array("f").alias("__x"), F.col("FOLD").alias("__fold"))
    est, held = estimator("squared"), [0, 3, None]
    for own, other in zip(B._whole_edges(few, held, 32), est._edges(few, held)):
        assert len(own) == len(other) == 4 and all((a == b).all() for a, b in zip(own, other))
    many = spark.range(40_000).selectExpr("array(cast(pmod(xxhash64(id), 1000003) as double), if(id % 3 = 0, 1D, 0D)) AS __x", "cast(id % 5 as int) AS __fold").repartition(3)
    for h, (spread, two) in zip([2, None], B._whole_edges(many, [2, None], 32)):
        values = np.array([r[0][0] for r in (many if h is None else many.where(F.col("__fold") != h)).collect()])
        share = np.searchsorted(np.sort(values), spread, side="right") / len(values)
        assert len(spread) == 31 and np.abs(share - np.arange(1, 32) / 32).max() < 1e-3 and list(two) == [0.0]


def test_shuffles_of_the_panel_are_let_go_before_the_fits(spark, rows, monkeypatch):
    seen = []
    monkeypatch.setattr(M, "release_shuffles", lambda s: seen.append("released"))
    est = estimator("squared", maxIter=2)
    panel = rows.drop("features").withColumn("YEAR", (F.col("ID") % 3).cast("int"))
    M.walk_forward_fit_predict(panel, XS, "Y", [2], 2, est, panel, keep=("YEAR", "ID"), carry=["ID"], tune=lambda df: (seen.append("fitted"), est)[1]).collect()
    assert seen == ["released", "fitted"]
