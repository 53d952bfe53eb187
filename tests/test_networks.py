import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import networks as NW
from panelforge.operators import selection as S


@pytest.fixture(scope="module")
def rings(spark):
    """Two rings around each other: no line parts them."""
    rng = np.random.default_rng(3)
    angle, far = rng.uniform(0, 2 * np.pi, 600), rng.integers(0, 2, 600)
    radius = 1 + far + rng.normal(0, 0.15, 600)
    rows = [(k, float(r * np.cos(a)), float(r * np.sin(a)), float(y)) for k, (r, a, y) in enumerate(zip(radius, angle, far))]
    df = spark.createDataFrame(rows, "ID long, A double, B double, Z double")
    return S.write_once(S.stratified_folds(df, ["ID"], 3, ["Z"]), "rings")


@pytest.mark.parametrize("loss", ["logistic", "squared"])
@pytest.mark.parametrize("layers", [(3, 1), (3, 4, 1), (3, 5, 2, 1)])
def test_gradient_is_that_of_the_loss(loss, layers):
    rng = np.random.default_rng(7)
    x, y, flat = rng.standard_normal((40, 3)), rng.integers(0, 2, 40).astype(float), NW.initial(layers, 1) + 0.1
    seen = NW.forward(layers, flat, x)
    slope = NW.gradient(layers, flat, seen, NW.LOSSES[loss](seen[-1], y)[1])
    for i in range(len(flat)):
        up, down = flat.copy(), flat.copy()
        up[i], down[i] = up[i] + 1e-6, down[i] - 1e-6
        numeric = sum(s * NW.LOSSES[loss](NW.forward(layers, w, x)[-1], y)[0].sum() for s, w in ((1, up), (-1, down))) / 2e-6
        assert slope[i] == pytest.approx(numeric, abs=1e-4)


def test_curves_equal_training_on_one_machine(spark, rings):
    train, valid = rings.where("FOLD <> 0"), rings.where("FOLD = 0")
    nets = NW.fit_networks(train, valid, ["A", "B"], "Z", [(4,), (6, 3)], epochs=25, patience=5)
    sides = [np.array(d.select("A", "B", "Z").collect(), float) for d in (train, valid)]
    for net, hidden in zip(nets, [(4,), (6, 3)]):
        layers = (2, *hidden, 1)
        alone = NW.Network(layers, NW.initial(layers, 10), NW.initial(layers, 10))
        while len(alone.curve) < 26 and len(alone.curve) - 1 - alone.epoch < 5:
            (seen, held) = (NW.forward(layers, alone.flat, d[:, :2]) for d in sides)
            value, slope = NW.LOSSES["logistic"](seen[-1], sides[0][:, 2])
            lost = NW.LOSSES["logistic"](held[-1], sides[1][:, 2])[0].mean()
            alone.learn(value.mean(), lost, NW.gradient(layers, alone.flat, seen, slope) / len(slope))
        assert np.allclose(net.curve, alone.curve, rtol=1e-6) and net.epoch == alone.epoch
        assert net.epoch == int(np.argmin([v for _, v in net.curve]))
    table = NW.loss_curves(spark, nets).collect()
    assert [r.SHAPE for r in table if r.BEST] == ["2-4-1", "2-6-3-1"] and len(table) == sum(len(n.curve) for n in nets)


def test_a_network_parts_rings_and_the_grid_finds_the_size(rings):
    grid = NW.network_grid(rings, ["A", "B"], "Z", [(1,), (12,)], 3, epochs=60).collect()
    assert [r.SHAPE for r in grid] == ["2-1-1", "2-12-1"] and [r.BEST for r in grid] == [False, True]
    assert grid[1].MEAN_METRIC > 0.95 > grid[0].MEAN_METRIC + 0.1
    nets = NW.fit_networks(rings, rings.limit(0), ["A", "B"], "Z", [(12,)], epochs=60)
    scored = NW.predict(rings, ["A", "B"], nets)
    assert scored.where((F.col("SCORES")[0] > 0.5) == (F.col("Z") == 1)).count() > 570


def test_empty_tables_and_null_labels(spark, rings):
    none = rings.limit(0)
    (net,) = NW.fit_networks(none, none, ["A", "B"], "Z", [(3,)], epochs=3)
    assert net.curve == [] and np.array_equal(net.flat, net.best)
    nulls = rings.withColumn("Z", F.when(F.col("ID") % 2 == 0, F.col("Z")))
    a = NW.fit_networks(nulls, none, ["A", "B"], "Z", [(3,)], epochs=4)[0].curve
    b = NW.fit_networks(rings.where("ID % 2 = 0"), none, ["A", "B"], "Z", [(3,)], epochs=4)[0].curve
    assert np.allclose(a, b)


def test_regression(rings):
    rows = rings.withColumn("Y", 2 * F.col("A") - F.col("B"))
    (net,) = NW.fit_networks(rows.where("FOLD <> 0"), rows.where("FOLD = 0"), ["A", "B"], "Y", [(4, 4)], "squared", epochs=80)
    assert net.curve[net.epoch][1] < 0.1 * net.curve[0][1]


@pytest.mark.parametrize("hidden", [[(3,)], [(1,), (5,), (2,)], [(2,), (4, 3), (6, 2, 3), (1,)], [(), (3,)], [()]])
def test_networks_side_by_side_equal_each_alone(hidden):
    rng, layers = np.random.default_rng(1), [(7, *h, 1) for h in hidden]
    flats = [NW.initial(one, 3) + 0.05 for one in layers]
    x, slope = rng.standard_normal((60, 7)), rng.standard_normal((60, len(layers)))
    stack = NW.Stack(list(zip(layers, flats)))
    seen = stack.forward(x)
    for k, found in enumerate(stack.gradients(x, seen, slope)):
        alone = NW.forward(layers[k], flats[k], x)
        assert np.allclose(seen[-1][:, k], alone[-1])
        assert np.allclose(found, NW.gradient(layers[k], flats[k], alone, slope[:, k]))
