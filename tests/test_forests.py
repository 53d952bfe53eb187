import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import forests as FR
from panelforge.operators import models as M
from panelforge.operators import selection as S
from panelforge.operators import trees as T

XS = ["A", "B", "C", "D"]


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((600, 4))
    z = (x[:, 0] * x[:, 1] + 0.3 * rng.standard_normal(600) > 0) + 0.0
    rows = [(k, *[None if (k + i) % 29 == 0 else float(v) for i, v in enumerate(r)], float(c), float(c + (r[2] > 1))) for k, (r, c) in enumerate(zip(x, z))]
    df = spark.createDataFrame(rows, "ID long, A double, B double, C double, D double, Z double, K double")
    return S.write_once(S.stratified_folds(df, ["ID"], 3, ["Z"]), "forests")


def grid(df, label="Z", depths=range(1, 9), trees=40, together=True, **params):
    est = M.classifier_estimator("forest", 4, numTrees=trees, **params)
    return S.depth_grid(df, XS, label, est, depths, 3, "wrong_class", steps=S.classifier_steps(XS, label, scaled=False), together=together).orderBy("DEPTH").collect()


@pytest.mark.parametrize("label", ["Z", "K"])
def test_errors_come_near_those_of_mllib(panel, label):
    own, theirs = grid(panel, label, trees=120), grid(panel, label, trees=120, together=False)
    assert [r.DEPTH for r in own] == [r.DEPTH for r in theirs] and sum(r.BEST for r in own) == 1
    assert max(abs(a.MEAN_METRIC - b.MEAN_METRIC) for a, b in zip(own, theirs)) < 0.06
    assert own[-1].MEAN_METRIC < own[0].MEAN_METRIC - 0.1


def test_folds_and_depths_share_their_jobs(spark, panel, monkeypatch):
    """No fit per fold, and as many jobs for deep trees as for shallow ones; MLlib runs a job per fold and level."""
    monkeypatch.setattr(M.RandomForestClassifier, "_fit", lambda *a: pytest.fail("a fit per fold"))
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for deepest in (2, 19):
        spark.sparkContext.setJobGroup(f"forest-{deepest}", "", False)
        grid(panel, depths=range(1, deepest + 1), trees=10)
        jobs.append(len(tracker.getJobIdsForGroup(f"forest-{deepest}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] <= 20


def test_the_same_forests_on_any_partitions(panel):
    assert [tuple(r) for r in grid(panel)] == [tuple(r) for r in grid(panel.repartition(7))]


def test_larger_folds_are_fitted_by_mllib(panel, monkeypatch):
    monkeypatch.setattr(FR, "CELLS", 1000)
    monkeypatch.setattr(FR, "depth_losses", lambda *a: pytest.fail("the rows of a fold do not fit"))
    assert len(grid(panel, depths=range(1, 3), trees=3)) == 2


@pytest.mark.parametrize("classes", [2, 3])
def test_trees_split_where_brute_force_does(classes):
    rng = np.random.default_rng(3)
    bins, y = rng.integers(0, 8, (300, 3)).astype(np.uint8), rng.integers(0, classes, 300)
    weight = FR.Forest(2, "all", 8, 5, 1).weights(rng.integers(-(2**62), 2**62, 300), 0, 2)
    assert abs(weight.mean() - 1) < 0.15 and (weight == 0).mean() == pytest.approx(np.exp(-1), abs=0.06)
    levels = FR.Forest(2, "all", 8, 5, 1).grow(bins, y, weight, classes, 4, rng)
    at = [[(tree, weight[tree] > 0)] for tree in range(2)]
    nodes = [part for parts in at for part in parts]
    for level, below in zip(levels, [*levels[1:], None]):
        assert len(nodes) == len(level.left)
        children = []
        for k, (tree, own) in enumerate(nodes):
            w = weight[tree] * own
            stats = np.array([w[y == c].sum() for c in range(classes)])
            assert (stats == level.stats[k]).all()
            gini = lambda s: s.sum() - (s**2).sum() / max(s.sum(), 1)
            best = 0.0
            for f in range(3):
                for cut in range(7):
                    left = np.array([w[(y == c) & (bins[:, f] <= cut)].sum() for c in range(classes)])
                    if min(left.sum(), (stats - left).sum()) >= 5:
                        best = max(best, gini(stats) - gini(left) - gini(stats - left))
            if level.left[k] < 0:
                assert below is None or best < 1e-9
                continue
            f, cut = level.feature[k], level.cut[k]
            left = np.array([w[(y == c) & (bins[:, f] <= cut)].sum() for c in range(classes)])
            assert gini(stats) - gini(left) - gini(stats - left) == pytest.approx(best)
            assert level.left[k] == len(children)
            children += [(tree, own & (bins[:, f] <= cut)), (tree, own & (bins[:, f] > cut))]
        nodes = children


def test_scores_of_cut_trees_equal_those_of_node_tables():
    rng = np.random.default_rng(4)
    bins, y, draw = rng.integers(0, 32, (900, 5)).astype(np.uint8), rng.integers(0, 2, 900), rng.integers(-(2**62), 2**62, 900)
    forest, depths = FR.Forest(6, "sqrt", 32, 1, 7), [1, 2, 4, 9, 25]
    levels = forest.grow(bins, y, forest.weights(draw, 0, 6), 2, 25, rng)
    got = FR.shares_by_depth(levels, bins[:200], depths)
    trees = []
    for tree in range(6):  # the nodes of one tree, level by level
        here, at = np.array([tree]), []
        for level in levels:
            at.append(here)
            left = level.left[here][level.left[here] >= 0]
            here = np.stack([left, left + 1], 1).ravel()
        offset = np.cumsum([0, *map(len, at)])
        left = np.concatenate([np.where(lv.left[h] >= 0, np.cumsum(lv.left[h] >= 0) * 2 - 2 + offset[k + 1], -1) for k, (lv, h) in enumerate(zip(levels, at))])
        column = lambda c: np.concatenate([getattr(lv, c)[h] for lv, h in zip(levels, at)])
        stats = column("stats")
        trees.append(T.Tree(left, np.where(left >= 0, left + 1, -1), column("feature"), column("cut").astype(float), stats / stats.sum(1, keepdims=True), stats.argmax(1)))
    want = sum(tree.value[tree.cut_ends(bins[:200].astype(float), depths)] for tree in trees)
    assert np.allclose(got.transpose(0, 2, 1), want)
    assert (got.argmax(1) == T.by_depth(trees, bins[:200].astype(float), depths)).mean() > 0.999


def test_folds_fitted_together_have_their_own_medians(panel):
    steps = S.classifier_steps(XS, "Z", scaled=False)
    for k, found in enumerate(S.fitted_folds(panel, steps, 3)):
        assert found.stages[0].learned == steps.fit(panel.where(F.col("FOLD") != k)).stages[0].learned
    scaled = S.fitted_folds(panel, S.classifier_steps(XS, "Z"), 3)
    assert scaled[1].stages[1].learned == S.classifier_steps(XS, "Z").fit(panel.where("FOLD <> 1")).stages[1].learned


def test_a_fold_without_rows_is_an_error(panel):
    with pytest.raises(ValueError, match="a fold has no rows"):
        grid(panel.where("FOLD <> 2"))
    with pytest.raises(ValueError, match="not supported"):
        grid(panel, minInfoGain=0.1)
