"""Random forests of classes of several folds, grown and scored side by side (M5).

The algorithm is MLlib's: binned features, Gini impurity, rows drawn with
replacement for each tree (Poisson weights), a fresh draw of features for each
node, siblings that end in the same class merged. MLlib runs jobs per fold and
level and sends the cells of all nodes of all trees through a shuffle, which for
deep trees are many times the rows. Here one job serves all folds: a fold's rows,
a byte per feature, meet in the tasks that grow its trees, each ``TREES`` of them,
level by level. A task walks the rows that the fold holds out down its trees and
leaves sums of shares per row and depth; they are added up, and the driver gets
one number per fold and depth. ``fits_in_task`` says whether a fold's rows can
meet in a task.

Weights and classes are whole numbers, so that their sums are exact, and rows are
drawn by hashes: the same trees grow on any number of partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators import trees as T
from panelforge.operators.boosting import _share

#: Trees that a task grows; rows times features that it holds, a byte each; rows, nodes of a search; accuracy of the bins' edges.
TREES, CELLS, ROWS, NODES, ACCURACY = 25, 1 << 28, 1 << 15, 1 << 10, 2_000
#: P(weight <= k) of a Poisson distribution of mean 1.
POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1, *range(1, 17)]))


@dataclass
class Level:
    """The nodes of one level of some trees: place of the left child in the next level (the right one follows; -1 at leaves), feature, last bin on the left, weight of each class."""

    left: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    stats: np.ndarray


@dataclass
class Forest:
    """Parameters as MLlib's ``RandomForestClassifier``."""

    trees: int
    columns: str
    bins: int
    least: int
    seed: int

    @classmethod
    def of(cls, est: RandomForestClassifier) -> Forest:
        fixed = (est.getImpurity(), est.getMinInfoGain(), est.getSubsamplingRate(), est.getBootstrap(), est.getMinWeightFractionPerNode(), est.isDefined("weightCol"))
        if fixed != ("gini", 0.0, 1.0, True, 0.0, False):
            raise ValueError(f"not supported: {fixed}")
        return cls(est.getNumTrees(), est.getFeatureSubsetStrategy(), est.getMaxBins(), est.getMinInstancesPerNode(), est.getSeed())

    def drawn(self, width: int) -> int:
        """Features drawn for a node."""
        return {"all": width, "sqrt": int(np.ceil(width**0.5)), "log2": max(1, int(np.ceil(np.log2(width)))), "onethird": int(np.ceil(width / 3))}[self.columns]

    def weights(self, draw: np.ndarray, first: int, count: int) -> np.ndarray:
        """(tree, row): how often a tree takes a row."""
        return np.stack([np.searchsorted(POISSON, _share(draw, first + t, self.seed), side="right") for t in range(count)])

    def grow(self, bins: np.ndarray, y: np.ndarray, weight: np.ndarray, classes: int, depth: int, rng: np.random.Generator) -> list[Level]:
        """The trees, one per row of ``weight``, of rows given as bins (row, feature) and classes."""
        flat, width = bins.ravel(), bins.shape[1]
        tree, rows = np.nonzero(weight)
        w = weight[tree, rows].astype(float)
        size = np.bincount(tree, minlength=len(weight))
        stats = np.bincount(tree * classes + y[rows], w, len(weight) * classes).reshape(-1, classes)
        levels = []
        while True:
            found = Level(np.full(len(stats), -1), np.zeros(len(stats), np.int64), np.zeros(len(stats), np.int64), stats)
            levels.append(found)
            open_ = (stats.sum(1) >= 2 * self.least) & ((stats > 0).sum(1) > 1)
            if len(levels) > depth or not open_.any():
                return levels
            stays = np.repeat(open_, size)
            rows, w, size, nodes = rows[stays], w[stays], size[open_], np.flatnonzero(open_)
            feature, cut, left = self._splits(flat, width, rows, w, y, size, stats[nodes], rng)
            split = feature >= 0
            place = np.repeat(np.arange(len(nodes)), size)
            stays = split[place]
            rows, w, place, size = rows[stays], w[stays], place[stays], size[split]
            goes = flat[rows * width + feature[place]] <= cut[place]
            rows, w, size = _parted(rows, w, size, goes)
            nodes, feature, cut, left = nodes[split], feature[split], cut[split], left[split]
            found.left[nodes], found.feature[nodes], found.cut[nodes] = 2 * np.arange(len(nodes)), feature, cut
            stats = np.stack([left, stats[nodes] - left], 1).reshape(-1, classes)

    def _splits(self, flat, width: int, rows, w, y, size, stats, rng) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each node the feature (-1 without a split), the last bin on the left and the weights there; rows are in the order of the nodes."""
        drawn, ends = self.drawn(width), np.cumsum(size)
        out, low = [], 0
        while low < len(size):  # some nodes at a time, so that their cells stay in the processor's cache
            start = ends[low] - size[low]
            high = min(low + NODES, max(low + 1, int(np.searchsorted(ends, start + ROWS, side="right"))))
            if drawn < width:
                of = np.sort(np.argpartition(rng.random((high - low, width), np.float32), drawn - 1, axis=1)[:, :drawn], axis=1)
            else:
                of = np.tile(np.arange(width), (high - low, 1))
            some = slice(start, ends[high - 1])
            out.append(self._search(flat, width, rows[some], w[some], y, size[low:high], stats[low:high], of))
            low = high
        return tuple(np.concatenate(x) for x in zip(*out))

    def _search(self, flat, width: int, rows, w, y, size, stats, of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, classes = stats.shape
        place, at, each = np.repeat(np.arange(n), size), rows * width, np.arange(n)
        base = (y[rows] * n + place) * self.bins
        total = stats.sum(1)
        used = range(1, 2) if classes == 2 else range(classes)  # of two classes, one tells the impurity
        top = sum(stats[:, c] ** 2 for c in used) / total
        top += 1e-12 * total
        feature, cut, left = np.full(n, -1), np.zeros(n, np.int64), np.zeros((n, classes))
        for features in of.T:
            cells = np.bincount(base + flat[at + features[place]], w, classes * n * self.bins).reshape(classes, n, self.bins)
            sums = cells.cumsum(2)[:, :, :-1]
            low = sums.sum(0)
            high = total[:, None] - low
            score, per_low, per_high = np.zeros(low.shape), 1 / np.maximum(low, 1), 1 / np.maximum(high, 1)
            for c in used:
                score += sums[c] ** 2 * per_low + (stats[:, c, None] - sums[c]) ** 2 * per_high
            score[(low < self.least) | (high < self.least)] = -1.0
            last = score.argmax(1)
            best = score[each, last]
            better = best > top
            top[better], feature[better], cut[better] = best[better], features[better], last[better]
            left[better] = sums[:, each[better], last[better]].T
        return feature, cut, left


def _parted(rows: np.ndarray, w: np.ndarray, size: np.ndarray, goes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of each node, those that go left first, in their order otherwise; the numbers of rows of the children."""
    ends, upto = np.cumsum(size), np.cumsum(goes)
    start = ends - size
    before = np.where(start > 0, upto[start - 1], 0) if len(start) else start
    lefts = (upto[ends - 1] - before) if len(ends) else ends
    rank = upto - np.repeat(before, size)  # rows that have gone left so far
    i = np.arange(len(rows))
    to = np.where(goes, np.repeat(start, size) + rank - 1, np.repeat(lefts, size) + i - rank)
    moved = np.empty_like(rows), np.empty_like(w)
    moved[0][to], moved[1][to] = rows, w
    return *moved, np.stack([lefts, size - lefts], 1).ravel()


def shares_by_depth(levels: Sequence[Level], bins: np.ndarray, depths: Sequence[int]) -> np.ndarray:
    """(depth, class, row): the shares of the classes, summed over the trees, with all trees cut at each depth (as ``trees.by_depth``)."""
    trees, (n, width) = len(levels[0].left), bins.shape
    offset = np.cumsum([0, *[len(level.left) for level in levels]])
    left = np.concatenate([np.where(level.left >= 0, level.left + end, -1) for level, end in zip(levels, offset[1:])])
    feature, cut, stats = (np.concatenate([getattr(level, c) for level in levels]) for c in ("feature", "cut", "stats"))
    share, label, deepest = stats / np.maximum(stats.sum(1, keepdims=True), 1e-300), stats.argmax(1), len(levels) - 1
    flat, at, now = bins.ravel(), np.tile(np.arange(n) * width, trees), np.repeat(np.arange(trees), n)
    path = [now]
    for _ in range(deepest):
        child = left[now]
        now = np.where(child >= 0, child + (flat[at + feature[now]] > cut[now]), now)
        path.append(now)
    path, each = np.stack(path), np.arange(trees * n)
    out, known = np.empty((len(depths), stats.shape[1], n)), {}
    for k, depth in enumerate(depths):
        depth = min(depth, deepest)
        if depth not in known:
            ends = label.copy()  # the class that all leaves below end in, -1 if there are several
            for level in range(depth - 1, -1, -1):
                some = slice(offset[level], offset[level + 1])
                child = left[some]
                ends[some] = np.where(child < 0, label[some], np.where(ends[child] == ends[child + 1], ends[child], -1))
            steps = np.zeros(trees * n, np.int64)
            for level in range(depth):
                steps += ends[path[level]] < 0
            known[depth] = share[path[steps, each]].reshape(trees, n, -1).sum(0).T
        out[k] = known[depth]
    return out


def fits_in_task(rows: int, features: int) -> bool:
    return rows * features <= CELLS


def depth_losses(rows: DataFrame, forest: Forest, fits: int, width: int, classes: int, depths: Sequence[int], loss: str) -> np.ndarray:
    """(fit, depth): mean loss over the rows that a fit holds out of its forest with all trees cut at each depth.

    ``rows`` has the rows of each fit (__fit) with their features as that fit sees them (__x), class (__y), fold (__fold; fit k holds
    out fold k) and hash (__draw).
    """
    depths, batches, deepest = list(depths), -(-forest.trees // TREES), max(depths)
    shares = [i / forest.bins for i in range(1, forest.bins)] + [1.0]
    learns = F.col("__fold") != F.col("__fit")
    found = rows.where(learns).groupBy("__fit").agg(*[F.percentile_approx(F.col("__x")[i], shares, ACCURACY).alias(str(i)) for i in range(width)]).collect()  # a row per fit
    edges = {r["__fit"]: [np.unique(r[str(i)])[:-1] for i in range(width)] for r in found}  # a bin that ends at the largest value parts nothing

    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pickle

        number, task = 0, TaskContext.get().partitionId()
        for part in parts:
            for fit, own in part.groupby("__fit"):
                x, y = np.stack(own["__x"].to_numpy()), own["__y"].to_numpy(float)
                if not ((y >= 0) & (y == np.floor(y))).all():
                    raise ValueError("a label is not a class")
                bins = np.column_stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges[fit])]).astype(np.uint8 if forest.bins <= 256 else np.uint16)
                piece = (bins, y.astype(np.int64), own["__fold"].to_numpy() == fit, own["__draw"].to_numpy(np.int64))
                yield pd.DataFrame({"FIT": [int(fit)], "TASK": [task], "NUMBER": [number], "PIECE": [pickle.dumps(piece)]})
                number += 1

    def grown(parts: Iterator) -> Iterator:
        import pickle

        met: dict[int, list] = {}
        for key, part in parts:
            met.setdefault(key, []).append(part)
        for key, own in met.items():
            (fit, batch), own = divmod(key, batches), sorted(own)
            bins, y, held, draw = (np.concatenate(x) for x in zip(*[pickle.loads(piece) for _, _, piece in own]))
            sizes = [int(pickle.loads(piece)[2].sum()) for _, _, piece in own]
            train, ys, draws, valid, truth = bins[~held], y[~held], draw[~held], bins[held], y[held]
            del bins
            total, first, end = 0, batch * TREES, min(forest.trees, (batch + 1) * TREES)
            while first < end:
                count = min(end - first, max(1, 200_000 // max(1, len(train))))  # small trees side by side
                rng = np.random.default_rng([forest.seed & 0xFFFFFFFF, fit, first])
                levels = forest.grow(train, ys, forest.weights(draws, first, count), classes, deepest, rng)
                total = total + shares_by_depth(levels, valid, depths)
                first += count
            for (task, number, _), votes, of in zip(own, np.split(total, np.cumsum(sizes)[:-1], axis=2), np.split(truth, np.cumsum(sizes)[:-1])):
                yield (fit, task, number), (votes, of)

    def lost(item) -> tuple:
        (fit, _, _), (votes, of) = item
        return fit, np.array([[T.LOSSES[loss](v.argmax(0).astype(float), of).sum(), len(of)] for v in votes])

    packed = rows.mapInPandas(pack, "FIT int, TASK int, NUMBER int, PIECE binary").rdd
    dealt = packed.flatMap(lambda r: [(r.FIT * batches + b, (r.TASK, r.NUMBER, bytes(r.PIECE))) for b in range(batches)])
    votes = dealt.partitionBy(fits * batches, lambda key: key).mapPartitions(grown)
    summed = votes.reduceByKey(lambda a, b: (a[0] + b[0], a[1]), fits * batches)
    sums = dict(summed.map(lost).reduceByKey(lambda a, b: a + b, fits).collect())  # depths x 2 numbers per fit
    return np.array([sums[k][:, 0] / sums[k][:, 1] for k in range(fits)])
