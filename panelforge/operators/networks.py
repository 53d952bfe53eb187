"""Dense networks of a whole grid of shapes, trained together (M9).

Networks are computed side by side (``Stack``), so that a batch of rows takes a
few large products and not some for each network. Hidden layers are rectified; the output is one score, read through a sigmoid for
classes. Every epoch is one job over the training and the validation rows: it
sums, for all networks still open, both losses and the gradient. What leaves a
partition is one number per weight. The weights move by resilient propagation,
which needs the gradient's signs alone and so suits whole passes; a network is
closed ``patience`` epochs after its lowest validation loss and keeps the
weights it had there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators import selection as S

#: loss and slope per row, of raw scores f and targets y.
LOSSES: dict[str, Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]] = {
    "logistic": lambda f, y: (np.logaddexp(0, f) - y * f, 0.5 * (1 + np.tanh(0.5 * f)) - y),
    "squared": lambda f, y: ((f - y) ** 2, 2 * (f - y)),
}
#: Resilient propagation: first, smallest and largest step, and its factors after equal and changed signs.
STEP, LEAST_STEP, MOST_STEP, FASTER, SLOWER = 0.02, 1e-6, 1.0, 1.2, 0.5


def _weights(layers: Sequence[int], flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    found, at = [], 0
    for a, b in pairwise(layers):
        found.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
        at += a * b + b
    return found


def initial(layers: Sequence[int], seed: int) -> np.ndarray:
    """Normal weights scaled by the inputs of their layer, biases of 0."""
    rng = np.random.default_rng(seed)
    return np.concatenate([np.append(rng.standard_normal(a * b) * np.sqrt(2 / a), np.zeros(b)) for a, b in pairwise(layers)])


def forward(layers: Sequence[int], flat: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    """The rows as each layer sees them, and the scores last."""
    seen = [x]
    *hidden, (w, b) = _weights(layers, flat)
    for v, c in hidden:
        seen.append(np.maximum(0, seen[-1] @ v + c))
    return [*seen, (seen[-1] @ w + b)[:, 0]]


def gradient(layers: Sequence[int], flat: np.ndarray, seen: Sequence[np.ndarray], slope: np.ndarray) -> np.ndarray:
    delta, parts = slope[:, None], []
    for (w, _), rows in zip(reversed(_weights(layers, flat)), reversed(seen[:-1])):
        parts.append(np.append((rows.T @ delta).ravel(), delta.sum(0)))
        delta = (delta @ w.T) * (rows > 0)
    return np.concatenate(parts[::-1])


#: Rows that are taken through all networks at a time: their hidden layers stay in the processor's cache.
SLICE = 512


class Stack:
    """Networks on the same inputs, their first layers side by side: one product forward and one back serve all of them.

    Networks with one hidden layer share the second product too, with zeros where a score does not read a neuron.
    """

    def __init__(self, nets: Sequence[tuple[Sequence[int], np.ndarray]]):
        self.nets = [(tuple(layers), flat, _weights(layers, flat)) for layers, flat in nets]
        firsts = [weights[0] for _, _, weights in self.nets]
        self.w, self.b = np.concatenate([w for w, _ in firsts], axis=1), np.concatenate([b for _, b in firsts])
        ends = np.cumsum([len(b) for _, b in firsts])
        self.own = [slice(e - len(b), e) for e, (_, b) in zip(ends, firsts)]
        self.second = np.zeros((len(self.w.T), len(self.nets)))
        for k, (layers, _, weights) in enumerate(self.nets):
            if len(layers) == 3:
                self.second[self.own[k], k] = weights[1][0][:, 0]
        self.bias = np.array([weights[-1][1][0] for _, _, weights in self.nets])

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, dict[int, list[np.ndarray]], np.ndarray]:
        """The first layer of all networks as computed, the rows as each layer after it sees them in the others, and (row, network) scores."""
        first = x @ self.w + self.b
        relu, deep = np.maximum(0, first), {}
        scores = relu @ self.second + self.bias
        for k, (layers, _, weights) in enumerate(self.nets):
            if len(layers) != 3:
                seen = [relu[:, self.own[k]] if len(layers) > 2 else x]
                for v, c in weights[1:-1]:
                    seen.append(np.maximum(0, seen[-1] @ v + c))
                deep[k] = seen
                scores[:, k] = (seen[-1] @ weights[-1][0] + weights[-1][1])[:, 0] if len(layers) > 2 else first[:, self.own[k]][:, 0]
        return relu, deep, scores

    def gradients(self, x: np.ndarray, seen: tuple, slope: np.ndarray) -> list[np.ndarray]:
        """The gradient of each network for (row, network) slopes."""
        relu, deep, _ = seen
        delta, seconds, above = slope @ self.second.T, relu.T @ slope, [[] for _ in self.nets]
        for k, (layers, _, weights) in enumerate(self.nets):
            if len(layers) == 3:
                above[k] = [np.append(seconds[self.own[k], k], slope[:, k].sum())]
            else:
                back = slope[:, [k]]
                for (w, _), rows in zip(reversed(weights[1:]), reversed(deep[k])):
                    above[k].insert(0, np.append((rows.T @ back).ravel(), back.sum(0)))
                    back = (back @ w.T) * (rows > 0) if len(above[k]) < len(weights) - 1 else back @ w.T
                delta[:, self.own[k]] = back
            if len(layers) == 2:
                relu = relu.copy()
                relu[:, self.own[k]] = 1.0  # the only layer is not rectified
        delta *= relu > 0
        inputs, biases = x.T @ delta, delta.sum(0)
        return [np.concatenate([inputs[:, own].ravel(), biases[own], *above[k]]) for k, own in enumerate(self.own)]


@dataclass
class Network:
    """A network in training: its weights, those at its best epoch, and (training loss, validation loss) of epochs 0, 1, ..."""

    layers: tuple[int, ...]
    flat: np.ndarray
    best: np.ndarray
    epoch: int = 0
    curve: list[tuple[float, float]] = field(default_factory=list)
    step: np.ndarray | None = None
    before: np.ndarray | None = None

    def learn(self, train: float, valid: float, slope: np.ndarray) -> None:
        self.curve.append((train, valid))
        if valid < self.curve[self.epoch][1] or len(self.curve) == 1:
            self.epoch, self.best = len(self.curve) - 1, self.flat.copy()
        if self.step is None:
            self.step, self.before = np.full(len(self.flat), STEP), np.zeros(len(self.flat))
        same = self.before * slope
        self.step = np.clip(np.where(same > 0, self.step * FASTER, np.where(same < 0, self.step * SLOWER, self.step)), LEAST_STEP, MOST_STEP)
        self.before = np.where(same < 0, 0.0, slope)
        self.flat = self.flat - np.sign(self.before) * self.step


def fit_networks(train: DataFrame, valid: DataFrame, features: Sequence[str], label: str, hidden: Sequence[Sequence[int]], loss: str = "logistic",
                 epochs: int = 100, patience: int = 10, seed: int = 10) -> list[Network]:
    """A trained network for each tuple of hidden layer sizes.

    Rows need complete features; rows without a label are passed over. Without
    validation rows the training loss decides; without training rows the
    networks stay as they began, with an empty curve.
    """
    names, of = list(features), LOSSES[loss]
    shapes = [(len(names), *map(int, h), 1) for h in hidden]
    nets = [Network(s, initial(s, seed), initial(s, seed)) for s in shapes]

    def side(df: DataFrame, held: bool) -> DataFrame:
        return df.where(F.col(label).isNotNull()).select(*names, F.col(label).cast("double").alias("__y"), F.lit(held).alias("__held"))

    rows = side(train, False).unionByName(side(valid, True))
    for _ in range(epochs + 1):
        now = [(k, n.layers, n.flat) for k, n in enumerate(nets) if len(n.curve) - 1 - n.epoch < patience]
        if not now:
            break

        def partial(batches: Iterator[pd.DataFrame], now=now) -> Iterator[pd.DataFrame]:
            total = {k: np.zeros(4 + len(flat)) for k, _, flat in now}
            stack = Stack([(layers, flat) for _, layers, flat in now])
            for batch in batches:
                every = batch[names].to_numpy(float), batch["__y"].to_numpy(float), batch["__held"].to_numpy(bool)
                for at in range(0, len(batch), SLICE):
                    x, y, held = (part[at : at + SLICE] for part in every)
                    seen = stack.forward(x)
                    value, slope = of(seen[-1], y[:, None])
                    slope[held] = 0.0
                    losses = [np.full(len(now), (~held).sum()), value[~held].sum(0), np.full(len(now), held.sum()), value[held].sum(0)]
                    for (k, _, _), lost, found in zip(now, np.transpose(losses), stack.gradients(x, seen, slope)):
                        total[k] += np.append(lost, found)
            yield pd.DataFrame({"NET": list(total), "SUMS": [t.tolist() for t in total.values()]})

        cells = rows.mapInPandas(partial, "NET int, SUMS array<double>").select("NET", F.posexplode("SUMS").alias("AT", "X"))
        sums = cells.groupBy("NET", "AT").agg(F.sum("X").alias("X")).toPandas()  # one number per weight
        for k, found in sums.sort_values("AT").groupby("NET"):
            n, lost, n_held, lost_held, *slope = found["X"].to_numpy()
            if not n:
                return nets
            nets[k].learn(lost / n, lost_held / n_held if n_held else lost / n, np.array(slope) / n)
        if sums.empty:
            break
    return nets


def shape_name(layers: Sequence[int]) -> str:
    return "-".join(map(str, layers))


def loss_curves(spark, nets: Sequence[Network]) -> DataFrame:
    """SHAPE, EPOCH (0: before the first step), TRAIN_LOSS, VALID_LOSS and BEST, the epoch whose weights are kept."""
    rows = [(shape_name(n.layers), e, float(t), float(v), e == n.epoch) for n in nets for e, (t, v) in enumerate(n.curve)]
    return spark.createDataFrame(rows, "SHAPE string, EPOCH int, TRAIN_LOSS double, VALID_LOSS double, BEST boolean")


def predict(rows: DataFrame, features: Sequence[str], nets: Sequence[Network], loss: str = "logistic", out: str = "SCORES") -> DataFrame:
    """``rows`` with an array of one prediction per network: probabilities of class 1, or values for the squared loss."""
    names, kept = list(features), [(n.layers, n.best) for n in nets]

    @F.pandas_udf("array<double>")
    def scores(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(float) for c in columns])
        stack = Stack(kept)
        raw = np.concatenate([stack.forward(x[at : at + SLICE])[-1] for at in range(0, max(len(x), 1), SLICE)])
        return pd.Series(list(0.5 * (1 + np.tanh(0.5 * raw)) if loss == "logistic" else raw))

    return rows.withColumn(out, scores(*[F.col(c) for c in names]))


def network_grid(df: DataFrame, features: Sequence[str], label: str, hidden: Sequence[Sequence[int]], folds: int, epochs: int = 100, patience: int = 10,
                 column: str = "FOLD") -> DataFrame:
    """Mean accuracy of each shape over the folds: SHAPE, EPOCHS (mean of the best ones), MEAN_LOSS, MEAN_METRIC, STD_METRIC, BEST.

    Medians and moments come from a fold's training rows; all shapes of a fold
    are trained together and scored in one pass over its validation rows. The
    first of equal accuracies is the best.
    """
    steps = S.classifier_steps(features, label)

    def one(fold: int) -> list[tuple[float, float, float]]:
        train, valid = S.fold_sides(df, fold, steps, column)
        nets = fit_networks(train, valid, features, label, hidden, "logistic", epochs, patience)
        right = [F.avg(((F.col("SCORES")[k] > 0.5) == (F.col(label) == 1)).cast("double")).alias(f"a{k}") for k in range(len(nets))]
        hits = predict(valid.where(F.col(label).isNotNull()), features, nets).agg(*right).first()
        return [(float(n.epoch), n.curve[n.epoch][1] if n.curve else np.nan, np.nan if h is None else h) for n, h in zip(nets, hits)]

    found = np.array(S._each(one, range(folds)))  # fold, shape, (epoch, loss, accuracy)
    mean, std = np.nanmean(found, 0), np.nanstd(found[:, :, 2], 0)
    best = int(np.nanargmax(mean[:, 2]))
    rows = [(shape_name((len(features), *h, 1)), *map(float, m[:2]), float(m[2]), float(s), k == best) for k, (h, m, s) in enumerate(zip(hidden, mean, std))]
    return df.sparkSession.createDataFrame(rows, "SHAPE string, EPOCHS double, MEAN_LOSS double, MEAN_METRIC double, STD_METRIC double, BEST boolean")
