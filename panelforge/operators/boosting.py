"""Gradient-boosted trees of several folds, grown together (M5-M7).

The algorithm is MLlib's: binned features, variance as impurity, the first tree
on the labels with weight 1, the others on the loss's slope with weight
``stepSize``. MLlib runs one job per level, tree and fit, and a fit cannot go on
from a shorter one; here a job serves all folds, and the rule that ends the
boosting is asked after every round.

Up to ``ROWS`` rows, a byte per feature, meet in one task per fit, which keeps
them with the fit's margins and grows ``CUT`` trees in each job. Only the cells of
the smaller child of a split are summed; the larger one's are what is left.

Beyond that the rows are dealt once, as blocks of bins, and stay with the margins
of all fits beside them. Per level, a partition leaves the counts and sums of the
cells (node, feature, bin) of the nodes with more than ``ROWS`` rows; a node's
cells meet in one task, which picks its split. All smaller nodes are then finished
in one job: the rows of each meet and grow what is below it.

The driver gets nodes alone. Rows and features are drawn by hashes of the rows'
keys, the round and the node's path, so the same trees grow on any number of
partitions, either way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import closing
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel, TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators import trees as T
from panelforge.session import ensure_checkpoint_dir

#: Rows of a fit or node that one task finishes; rows of a partition beyond that; rounds of a job, or after which the blocks' lineage is cut.
ROWS, PART, CUT = 1 << 21, 100_000, 10
#: Jobs of whole fits after which their lineage is cut; rank error of the bins' edges, as 1 / ACCURACY; cells that are counted at once.
JOBS, ACCURACY, CELLS = 10, 2_000, 1 << 16
#: Rows that go down a level at once, and whose values are sorted at once.
STEP, SORT = 1 << 17, 25_000


def _target(kind: str, y: np.ndarray, margin: np.ndarray, first: bool) -> np.ndarray:
    """What a tree is fitted to: the labels (classes: -1 and 1), later the negative slope of the loss."""
    if kind == "squared":
        return y if first else 2 * (y - margin)
    sign = 2 * y - 1
    return sign if first else 2 * sign * (1 - np.tanh(sign * margin))


def _share(draw: np.ndarray, number: int, seed: int) -> np.ndarray:
    """A number in [0, 1) per row from its hash and the round (splitmix64)."""
    z = draw.astype(np.uint64) + np.uint64(((seed << 20) + number + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) / 2.0**64


@dataclass
class Block:
    """Some rows: the bins of each fit (fit, row, feature), labels, folds, hashes and the margin of each fit."""

    bins: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    draw: np.ndarray
    margin: np.ndarray


@dataclass
class Whole:
    """All rows of one fit: bins (feature, row), labels, folds, hashes and margins; the trees and the (sum of losses, rows) of the last rounds."""

    bins: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    draw: np.ndarray
    margin: np.ndarray
    trees: list[T.Tree] = field(default_factory=list)
    losses: list[tuple[float, int]] = field(default_factory=list)


@dataclass
class Growing:
    """A tree under way: its nodes, with bins as thresholds, and those that may be split. ``path`` is 1 at the root, 2p and 2p + 1 below p."""

    path: list[int] = field(default_factory=lambda: [1])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    value: list[float] = field(default_factory=lambda: [0.0])
    open: list[int] = field(default_factory=lambda: [0])

    def tree(self) -> T.Tree:
        return T.Tree(np.array(self.left), np.array(self.right), np.array(self.feature), np.array(self.threshold), np.array(self.value), np.empty(0, np.int64))

    def split(self, node: int, feature: int, cut: int, sides: Sequence[tuple[float, float]]) -> list[tuple[int, int]]:
        """Gives ``node`` two children; returns them with their numbers of rows."""
        found = []
        for right, (column, (n, total)) in enumerate(zip((self.left, self.right), sides)):
            column[node] = len(self.value)
            found.append((len(self.value), int(n)))
            for grown, start in ((self.path, 2 * self.path[node] + right), (self.left, -1), (self.right, -1), (self.feature, -1), (self.threshold, 0.0), (self.value, total / n)):
                grown.append(start)
        self.feature[node], self.threshold[node] = feature, float(cut)
        return found

    def graft(self, node: int, below: Growing) -> None:
        """Puts the tree ``below`` in the place of the leaf ``node``."""
        shift = len(self.value) - 1
        moved = [[c if c < 0 else c + shift for c in side] for side in (below.left, below.right)]
        for own, other in zip((self.path, self.left, self.right, self.feature, self.threshold, self.value), (below.path, *moved, below.feature, below.threshold, below.value)):
            own[node] = other[0]
            own.extend(other[1:])


def best_split(count: np.ndarray, total: np.ndarray, least: int, drawn: np.ndarray) -> tuple[int, int, tuple, tuple] | None:
    """(feature, last bin on the left, (rows, sum) of both sides) of the largest decrease in variance over (feature, bin) cells; None without one."""
    n, s = count[0].sum(), total[0].sum()
    left, sums = count.cumsum(1)[:, :-1], total.cumsum(1)[:, :-1]
    right = n - left
    valid = (left >= least) & (right >= least) & drawn[:, None]
    if not valid.any():
        return None
    gain = np.where(valid, sums**2 / np.maximum(left, 1) + (s - sums) ** 2 / np.maximum(right, 1) - s * s / n, 0.0)
    top = gain.max()
    if top <= 1e-12 * max(1.0, s * s / n):
        return None
    f, b = np.unravel_index(int((gain >= top * (1 - 1e-9)).argmax()), gain.shape)  # the first of equals, whatever the order of summing
    return int(f), int(b), (left[f, b], sums[f, b]), (right[f, b], s - sums[f, b])


class BoostedTrees(Estimator):
    """Boosted trees for classes 0 and 1 (``logistic``) or values (``squared``); parameters as MLlib's ``GBTClassifier`` and ``GBTRegressor``.

    ``keys`` name the columns that tell rows apart where a tree takes a share of them; all columns if empty.
    """

    def __init__(self, loss: str, maxDepth: int = 5, stepSize: float = 0.1, maxIter: int = 20, featureSubsetStrategy: str = "all",
                 subsamplingRate: float = 1.0, minInstancesPerNode: int = 1, maxBins: int = 32, seed: int = 10, keys: Sequence[str] = ()):
        super().__init__()
        self.loss, self.depth, self.step, self.rounds, self.bins, self.seed = loss, maxDepth, stepSize, maxIter, maxBins, seed
        self.columns, self.rows, self.least, self.keys = 1.0 if featureSubsetStrategy == "all" else float(featureSubsetStrategy), subsamplingRate, minInstancesPerNode, list(keys)
        self.features, self.label = "features", "label"

    def setFeaturesCol(self, name: str) -> BoostedTrees:
        self.features = name
        return self

    def setLabelCol(self, name: str) -> BoostedTrees:
        self.label = name
        return self

    def setMaxIter(self, rounds: int) -> BoostedTrees:
        self.rounds = rounds
        return self

    def _fit(self, dataset: DataFrame) -> BoostedModel:
        (trees,), _ = self.boost(dataset, [None])
        return BoostedModel(trees, [1.0] + [self.step] * (len(trees) - 1), self.features, self.loss)

    def boost(self, df: DataFrame, held: Sequence[int | None], column: str = "FOLD", loss: str | None = None,
              stop: Callable[[np.ndarray], bool] = lambda curves: False, keep: bool = True) -> tuple[list[list[T.Tree]], np.ndarray]:
        """The trees of each fit (none unless ``keep``), and (round, fit) mean ``loss`` on the rows it holds out.

        Fit k leaves out the rows of fold ``held[k]`` (None: takes all). It ends after ``maxIter`` rounds or once ``stop`` says so of the losses.
        """
        x = vector_to_array(self.features)
        fold = F.col(column).cast("int") if any(h is not None for h in held) else F.lit(-1)
        draw = F.xxhash64(*(self.keys or [c for c, kind in df.dtypes if kind != "vector"]))
        rows = df.select(x.alias("__x"), F.col(self.label).cast("double").alias("__y"), fold.alias("__fold"), draw.alias("__draw"))
        n = rows.count()
        if not n:
            return [[] for _ in held], np.empty((0, len(held)))
        edges = _whole_edges(rows, held, self.bins) if n <= ROWS else self._edges(rows, held)
        ensure_checkpoint_dir(df.sparkSession)
        rounds = self._whole_rounds(rows, edges, held, loss, keep) if n <= ROWS else self._level_rounds(rows, edges, held, loss, n)
        fits, curves = [[] for _ in held], []
        with closing(rounds):
            for grown, sums in rounds:
                for trees, tree, edge in zip(fits, grown, edges) if keep else ():
                    tree.threshold = np.array([edge[f][int(t)] if f >= 0 else 0.0 for f, t in zip(tree.feature, tree.threshold)])
                    trees.append(tree)
                curves.append(sums[0] / np.maximum(sums[1], 1))
                if stop(np.array(curves)):
                    break
        return fits, np.array(curves).reshape(-1, len(held))

    def _whole_rounds(self, rows: DataFrame, edges: list, held: Sequence[int | None], loss: str | None, keep: bool) -> Iterator:
        """Of each round one tree per fit and the (sum of losses, rows) of the fits; a task for each fit."""
        state = _wholes(rows, edges).persist(StorageLevel.MEMORY_AND_DISK)
        step = CUT if loss is not None else max(1, self.rounds)
        try:
            for job, first in enumerate(range(0, self.rounds, step)):
                last, end = state, min(self.rounds, first + step)
                state = last.map(lambda fit, first=first, end=end: (fit[0], self._boosted(fit[1], held[fit[0]], first, end, loss, keep))).persist(StorageLevel.MEMORY_AND_DISK)
                if job % JOBS == JOBS - 1:
                    state.checkpoint()
                found = dict(state.map(lambda fit: (fit[0], (fit[1].trees, fit[1].losses))).collect())  # nodes alone
                last.unpersist()
                for i in range(end - first):
                    yield [found[k][0][i] for k in range(len(held)) if keep], np.array([found[k][1][i] for k in range(len(held))]).T
        finally:
            state.unpersist()

    def _level_rounds(self, rows: DataFrame, edges: list, held: Sequence[int | None], loss: str | None, n: int) -> Iterator:
        """The same with the rows dealt to partitions."""
        parts = -(-n // min(ROWS, PART))
        state = _blocks(rows.repartition(parts), edges).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for number in range(self.rounds):
                grown = self._tree(state, held, number, n, len(edges[0]), parts)
                last, weight = state, 1.0 if number == 0 else self.step
                state = last.map(lambda block, grown=grown, weight=weight: _moved(block, grown, weight)).persist(StorageLevel.MEMORY_AND_DISK)
                if number % CUT == CUT - 1:
                    state.checkpoint()
                sums = state.map(lambda block: _held_loss(block, held, loss)).treeReduce(np.add)
                last.unpersist()
                yield grown, sums
        finally:
            state.unpersist()

    def _boosted(self, fit: Whole, held: int | None, first: int, end: int, loss: str | None, keep: bool = True) -> Whole:
        """The fit after the rounds from ``first`` up to ``end``."""
        learns = np.ones(len(fit.y), bool) if held is None else fit.fold != held
        own = np.flatnonzero(~learns)
        out = Whole(fit.bins, fit.y, fit.fold, fit.draw, fit.margin.copy())
        for number in range(first, end):
            used = learns & (_share(fit.draw, number, self.seed) < self.rows) if self.rows < 1 else learns
            tree, node = self._grown(fit.bins, used, _target(self.loss, fit.y, out.margin, number == 0), number)
            out.margin += (1.0 if number == 0 else self.step) * tree.value[node]
            if keep:
                out.trees.append(tree)
            out.losses.append((T.LOSSES[loss](out.margin[own], fit.y[own]).sum(), len(own)) if loss is not None and held is not None else (0.0, 0))
        return out

    def _grown(self, bins: np.ndarray, used: np.ndarray, target: np.ndarray, number: int) -> tuple[T.Tree, np.ndarray]:
        """The tree that the ``used`` ones of all rows grow, with bins as thresholds, and the leaf of every row."""
        width, n = bins.shape
        flat = bins.ravel()
        picked = np.flatnonzero(used)
        count, total = self._binned(bins, picked, target, np.zeros(len(picked), np.int64), 1)
        counts, sums = count[0].sum(1), total[0].sum(1)  # of the level's nodes that may be split
        tree = [np.array([-1]), np.array([-1]), np.zeros(1, np.int64), np.array([float(sums[0] / counts[0]) if counts[0] else 0.0]), np.ones(1, np.int64)]
        left, feature, cut, value, path = tree
        nodes, node = np.arange(1), np.zeros(n, np.int64)
        for level in range(self.depth):
            found, lows = self._best(count, total, counts, sums, path[nodes], number)
            split = found[0] >= 0
            if not split.any():
                break
            f, b = (x[split] for x in found)
            some, n_low, s_low = nodes[split], *(x[split] for x in lows)
            n_high, s_high = counts[split] - n_low, sums[split] - s_low
            new = len(left) + 2 * np.arange(len(some))
            left[some], feature[some], cut[some] = new, f, b
            grown = 2 * len(some)
            left, feature, cut = (np.concatenate([x, np.full(grown, start)]) for x, start in ((left, -1), (feature, -1), (cut, 0)))
            value = np.concatenate([value, np.stack([s_low / n_low, s_high / n_high], 1).ravel()])
            path = np.concatenate([path, (2 * path[some, None] + np.arange(2)).ravel()])
            # every row goes on to its child
            to, of, last = np.where(left >= 0, left, np.arange(len(left))), np.maximum(feature, 0) * n, np.where(left >= 0, cut, bins.itemsize << 16)
            for low in range(0, n, STEP):
                at = node[low : low + STEP]
                node[low : low + STEP] = to[at] + (flat[of[at] + np.arange(low, low + len(at))] > last[at])
            if level + 1 == self.depth:
                break
            n_both, s_both = np.stack([n_low, n_high], 1), np.stack([s_low, s_high], 1)
            goes_on = n_both >= max(2 * self.least, 2)
            asked = np.flatnonzero(goes_on.any(1))
            if not len(asked):
                break
            # the cells of the smaller children are summed, the others' are what is left of their parents'
            smaller = n_both[asked].argmin(1)
            place = np.full(len(left), -1)
            place[new[asked] + smaller] = np.arange(len(asked))
            picked = np.flatnonzero(used & (place >= 0)[node])
            c_small, t_small = self._binned(bins, picked, target, place[node[picked]], len(asked))
            parent = np.flatnonzero(split)[asked]
            both = [np.stack([small, whole[:, parent] - small], 2) for small, whole in ((c_small, count), (t_small, total))]
            first = np.stack([smaller == 0, smaller == 1], 1)  # the place of the left child, then of the right one, is 0 where it is the smaller
            pick, side = np.nonzero(goes_on[asked])
            at = np.where(first[pick, side], 0, 1)
            count, total = (x[:, pick, at] for x in both)
            nodes, counts, sums = new[asked][pick] + side, n_both[asked][pick, side], s_both[asked][pick, side]
        left, right, feature = (x.astype(np.int32) for x in (left, np.where(left >= 0, left + 1, -1), feature))
        return T.Tree(left, right, feature, cut.astype(np.float32), value, np.empty(0, np.int64)), node

    def _binned(self, bins: np.ndarray, rows: np.ndarray, target: np.ndarray, place: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
        """Counts and sums of the cells (feature, node, bin) of some rows."""
        width, size, at, of = len(bins), nodes * self.bins, place * self.bins, target[rows]
        step = max(1, CELLS // max(1, len(rows)))
        count, total = np.empty((width, size), np.int64), np.empty((width, size))
        for low in range(0, width, step):
            some = bins[low : low + step]
            cell = some.take(rows, 1) + at
            if len(some) > 1:
                cell += (np.arange(len(some)) * size)[:, None]
            cell = cell.ravel()
            count[low : low + step] = np.bincount(cell, minlength=len(some) * size).reshape(-1, size)
            total[low : low + step] = np.bincount(cell, np.tile(of, len(some)) if len(some) > 1 else of, len(some) * size).reshape(-1, size)
        return count.reshape(width, nodes, self.bins), total.reshape(width, nodes, self.bins)

    def _best(self, count: np.ndarray, total: np.ndarray, n: np.ndarray, s: np.ndarray, path: np.ndarray, number: int) -> tuple[tuple, tuple]:
        """Of each node the feature (-1: no split) and last bin on the left as ``best_split`` picks them, and the rows and sums there."""
        drawn = np.stack([self._drawn(len(count), int(p), number) for p in path], 1) if self.columns < 1 else None
        out = []
        for low in range(0, len(n), 256):  # bounded in memory
            some = slice(low, low + 256)
            left, sums = count[:, some].cumsum(2)[:, :, :-1], total[:, some].cumsum(2)[:, :, :-1]
            all_n, all_s = n[some][:, None], s[some][:, None]
            right = all_n - left
            gain = sums**2 / np.maximum(left, 1) + (all_s - sums) ** 2 / np.maximum(right, 1) - all_s * all_s / np.maximum(all_n, 1)
            valid = (left >= max(1, self.least)) & (right >= max(1, self.least))
            if drawn is not None:
                valid &= drawn[:, some, None]
            gain = np.where(valid, gain, 0.0).transpose(1, 0, 2).reshape(left.shape[1], -1)
            top = gain.max(1)
            best = (gain >= (top * (1 - 1e-9))[:, None]).argmax(1)
            f, b = np.divmod(best, left.shape[2])
            each = np.arange(len(f))
            none = top <= 1e-12 * np.maximum(1.0, (all_s * all_s / np.maximum(all_n, 1))[:, 0])
            out.append((np.where(none, -1, f), b, left[f, each, b], sums[f, each, b]))
        f, b, left, sums = (np.concatenate(x) for x in zip(*out))
        return (f, b), (left, sums)

    def _drawn(self, width: int, path: int, number: int) -> np.ndarray:
        """Whether each feature is drawn for a node."""
        drawn = np.ones(width, bool)
        if self.columns < 1:
            drawn[:] = False
            drawn[np.random.default_rng([self.seed, number, path]).permutation(width)[: int(np.ceil(self.columns * width))]] = True
        return drawn

    def _edges(self, rows: DataFrame, held: Sequence[int | None]) -> list[list[np.ndarray]]:
        """Per fit and feature the upper ends of all bins but the last, from the rows the fit learns from."""
        shares = [i / self.bins for i in range(1, self.bins)] + [1.0]
        learns = [F.when(F.lit(h is None) | (F.col("__fold") != F.lit(h)), F.col("__v")) for h in held]
        long = rows.select("__fold", F.posexplode("__x").alias("__i", "__v"))
        found = long.groupBy("__i").agg(*[F.percentile_approx(v, shares, ACCURACY).alias(f"e{k}") for k, v in enumerate(learns)])
        found = sorted(found.collect(), key=lambda r: r["__i"])  # one row per feature
        return [[_ends(r[f"e{k}"] or []) for r in found] for k in range(len(held))]

    def _tree(self, state, held: Sequence[int | None], number: int, n: int, width: int, parts: int) -> list[T.Tree]:
        """One tree per fit: a job per level while nodes have more than ``ROWS`` rows, and one for all that is below the others."""
        grown, small = [Growing(open=[0] if n > ROWS else []) for _ in held], {}
        if n <= ROWS:
            small = {(k, 0): 0 for k in range(len(held))}
        for level in range(self.depth):
            now = {k: (g.tree(), g.open) for k, g in enumerate(grown) if g.open}
            if not now:
                break
            cells = state.mapPartitions(lambda blocks, now=now: self._cells(blocks, now, held, number, width))
            paths = {(k, node): grown[k].path[node] for k, (_, nodes) in now.items() for node in nodes}
            found = cells.groupByKey(parts).map(lambda cell, paths=paths: self._met(cell, paths[cell[0]], number, width)).collect()
            for g in grown:
                g.open = []
            for (k, node), value, split in sorted(found, key=lambda f: f[0]):  # a tree's nodes are numbered as they are split
                grown[k].value[node] = value
                for child, rows in grown[k].split(node, *split[:2], split[2:]) if split else []:
                    if rows > ROWS:
                        grown[k].open.append(child)
                    elif rows >= 2 * self.least and level + 1 < self.depth:
                        small[k, child] = level + 1
        if small:
            now = {k: (g.tree(), [node for fit, node in small if fit == k]) for k, g in enumerate(grown)}
            paths = {(k, node): grown[k].path[node] for k, node in small}
            rows = state.mapPartitions(lambda blocks: self._rows(blocks, now, held, number)).groupByKey(min(len(small), max(parts, 8)))
            for (k, node), below in sorted(rows.map(lambda cell: (cell[0], self._below(cell, paths[cell[0]], small[cell[0]], number, width))).collect(), key=lambda f: f[0]):
                grown[k].graft(node, below)
        return [g.tree() for g in grown]

    def _used(self, block: Block, k: int, held: Sequence[int | None], number: int, tree: T.Tree, nodes: Sequence[int]) -> tuple[np.ndarray, ...]:
        """Bins and targets of the rows that fit k learns from and that are in ``nodes``, and the place of their node there."""
        used = np.ones(len(block.y), bool) if held[k] is None else block.fold != held[k]
        if self.rows < 1:
            used &= _share(block.draw, number, self.seed) < self.rows
        bins, target = block.bins[k][used], _target(self.loss, block.y[used], block.margin[k][used], number == 0)
        place = np.full(len(tree.left), -1)
        place[nodes] = np.arange(len(nodes))
        here = place[tree.ends(bins)]
        some = here >= 0
        return bins[some], target[some], here[some]

    def _sums(self, bins: np.ndarray, target: np.ndarray, here: np.ndarray, nodes: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Counts and sums of the cells (node, feature, bin)."""
        size = width * self.bins
        cell = (here[:, None] * size + np.arange(width) * self.bins + bins).ravel()
        shape = (nodes, width, self.bins)
        return np.bincount(cell, minlength=nodes * size).reshape(shape), np.bincount(cell, np.repeat(target, width), minlength=nodes * size).reshape(shape)

    def _cells(self, blocks: Iterable[Block], now: dict, held: Sequence[int | None], number: int, width: int) -> Iterator:
        """((fit, node), (counts, sums) of its cells) of a partition."""
        blocks = list(blocks)
        for k, (tree, nodes) in now.items():
            sums = [self._sums(*self._used(block, k, held, number, tree, nodes), len(nodes), width) for block in blocks]
            if sums:
                yield from zip([(k, node) for node in nodes], zip(sum(c for c, _ in sums), sum(t for _, t in sums)))

    def _rows(self, blocks: Iterable[Block], now: dict, held: Sequence[int | None], number: int) -> Iterator:
        """((fit, node), (bins, targets) of its rows) of a partition."""
        for block in blocks:
            for k, (tree, nodes) in now.items():
                if nodes:
                    bins, target, here = self._used(block, k, held, number, tree, nodes)
                    order = np.argsort(here, kind="stable")
                    for part in np.split(order, np.flatnonzero(np.diff(here[order])) + 1):
                        if len(part):
                            yield (k, nodes[here[part[0]]]), (bins[part], target[part])

    def _split(self, count: np.ndarray, total: np.ndarray, path: int, number: int) -> tuple | None:
        return best_split(count, total, self.least, self._drawn(len(count), path, number))

    def _met(self, cell, path: int, number: int, width: int) -> tuple:
        """((fit, node), mean target, best split) of a node whose cells have met."""
        key, found = cell
        count, total = (sum(x) for x in zip(*found))
        n = count[0].sum()
        return key, float(total[0].sum() / n) if n else 0.0, self._split(count, total, path, number) if n else None

    def _below(self, cell, path: int, depth: int, number: int, width: int) -> Growing:
        """The tree of a node whose rows, ``ROWS`` at most, have met."""
        bins, target = (np.concatenate(x) for x in zip(*cell[1]))
        grown, at = Growing(path=[path], value=[float(target.mean())]), np.zeros(len(target), np.int64)
        for level in range(depth, self.depth):
            nodes, grown.open = grown.open, []
            place = np.full(len(grown.value), -1)
            place[nodes] = np.arange(len(nodes))
            some = place[at] >= 0
            count, total = self._sums(bins[some], target[some], place[at[some]], len(nodes), width)
            for i, node in enumerate(nodes):
                split = self._split(count[i], total[i], grown.path[node], number)
                if split:
                    grown.open += [child for child, rows in grown.split(node, *split[:2], split[2:]) if rows >= 2 * self.least]
            if not grown.open:
                break
            at = grown.tree().step(at, bins)
        return grown


def _blocks(rows: DataFrame, edges: list[list[np.ndarray]]):
    """The rows as an RDD of blocks, margins at 0."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pickle

        for batch in batches:
            if len(batch):
                x = np.stack(batch["__x"].to_numpy())
                bins = np.stack([np.column_stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edge)]) for edge in edges]).astype(np.uint8)
                block = Block(bins, batch["__y"].to_numpy(float), batch["__fold"].to_numpy(), batch["__draw"].to_numpy(np.int64), np.zeros((len(edges), len(x))))
                yield pd.DataFrame({"BLOCK": [pickle.dumps(block)]})

    def load(row) -> Block:
        import pickle

        return pickle.loads(row.BLOCK)

    return rows.mapInPandas(pack, "BLOCK binary").rdd.map(load)


def _ends(values: Sequence[float]) -> np.ndarray:
    return np.unique(values if len(values) else [0.0])[:-1]  # a bin that ends at the largest value parts nothing


def _points(values: np.ndarray) -> tuple[np.ndarray, float]:
    """Sorted values at even ranks, the largest among them, and the number of values that each stands for; all of them, if they are few."""
    n = len(values)
    if n <= ACCURACY:
        return values, 1.0
    at = ((np.arange(ACCURACY) + 0.5) * (n / ACCURACY)).astype(np.int64)
    at[-1] = n - 1
    return values[at], n / ACCURACY


def _whole_edges(rows: DataFrame, held: Sequence[int | None], bins: int) -> list[list[np.ndarray]]:
    """``_edges`` from sorted values: some rows leave ``ACCURACY`` values at most per feature and fold, and a feature's meet in a task."""
    folds = [h for h in dict.fromkeys(held) if h is not None]

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pickle

        def left(parts: list[pd.DataFrame]) -> pd.DataFrame:
            x, fold = (np.concatenate(v) for v in zip(*[(np.stack(p["__x"].to_numpy()), p["__fold"].to_numpy()) for p in parts]))
            of = np.array([folds.index(f) if f in folds else -1 for f in fold])
            groups = [np.sort(x[of == g], axis=0) for g in range(-1, len(folds))]
            return pd.DataFrame({"FEATURE": range(x.shape[1]), "PIECE": [pickle.dumps([_points(g[:, i]) for g in groups]) for i in range(x.shape[1])]})

        held_back: list[pd.DataFrame] = []
        for batch in batches:
            if len(batch):
                held_back.append(batch)
            if sum(map(len, held_back)) >= SORT:
                yield left(held_back)
                held_back = []
        if held_back:
            yield left(held_back)

    def meet(pieces: Iterable) -> Iterator[tuple[int, list[np.ndarray]]]:
        import pickle

        met: dict[int, list] = {}
        for i, piece in pieces:
            met.setdefault(i, []).append(pickle.loads(piece))
        shares = np.append(np.arange(1, bins) / bins, 1.0)
        for i, own in met.items():
            out = []
            for h in held:
                some = [part[g] for part in own for g in range(len(folds) + 1) if h is None or g != folds.index(h) + 1]
                values, weights = np.concatenate([v for v, _ in some]), np.concatenate([np.full(len(v), w) for v, w in some])
                order = np.argsort(values, kind="stable")
                upto = weights[order].cumsum()
                at = np.searchsorted(upto, shares * upto[-1] * (1 - 1e-12)) if len(upto) else []
                out.append(_ends(values[order][np.minimum(at, len(upto) - 1)] if len(upto) else []))
            yield i, out

    packed = rows.select("__x", "__fold").mapInPandas(sort, "FEATURE int, PIECE binary").rdd.map(lambda r: (r.FEATURE, bytes(r.PIECE)))
    found = dict(packed.partitionBy(8, lambda i: i).mapPartitions(meet).collect())  # fits x bins numbers per feature
    return [[found[i][k] for i in sorted(found)] for k in range(len(held))]


def _wholes(rows: DataFrame, edges: list[list[np.ndarray]]):
    """(fit, its rows, margins at 0) as an RDD with a partition for each fit."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pickle

        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            if len(batch):
                x = np.stack(batch["__x"].to_numpy())
                others = batch["__y"].to_numpy(float), batch["__fold"].to_numpy(), batch["__draw"].to_numpy(np.int64)
                for k, edge in enumerate(edges):
                    bins = np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edge)]).astype(np.uint8)
                    yield pd.DataFrame({"FIT": [k], "TASK": [task], "NUMBER": [number], "ROWS": [len(x)], "PIECE": [pickle.dumps((bins, *others))]})
                number += 1

    def meet(pieces: Iterable) -> Iterator[tuple[int, Whole]]:
        import pickle

        met: dict[int, list] = {}
        for k, piece in pieces:
            met.setdefault(k, []).append(piece)
        for k, own in met.items():
            own.sort(key=lambda p: p[:2], reverse=True)
            n, at, whole = sum(rows for _, _, rows, _ in own), 0, None
            while own:  # a piece goes as it is taken up: the rows are held once
                _, _, rows, piece = own.pop()
                parts = pickle.loads(piece)
                whole = whole or Whole(*[np.empty((*x.shape[:-1], n), x.dtype) for x in parts], np.zeros(n))
                for out, part in zip((whole.bins, whole.y, whole.fold, whole.draw), parts):
                    out[..., at : at + rows] = part
                at += rows
            yield k, whole

    packed = rows.mapInPandas(pack, "FIT int, TASK int, NUMBER int, ROWS int, PIECE binary").rdd
    return packed.map(lambda r: (r.FIT, (r.TASK, r.NUMBER, r.ROWS, bytes(r.PIECE)))).partitionBy(len(edges), lambda k: k).mapPartitions(meet)


def _moved(block: Block, grown: Sequence[T.Tree], weight: float) -> Block:
    """The block with the margins after a round."""
    steps = np.stack([tree.value[tree.ends(bins)] for tree, bins in zip(grown, block.bins)])
    return Block(block.bins, block.y, block.fold, block.draw, block.margin + weight * steps)


def _held_loss(block: Block, held: Sequence[int | None], loss: str | None) -> np.ndarray:
    """(sum of the losses, rows) of each fit over the rows it holds out."""
    out = np.zeros((2, len(held)))
    for k, h in enumerate(held):
        if h is not None and loss is not None:
            own = block.fold == h
            out[:, k] = T.LOSSES[loss](block.margin[k][own], block.y[own]).sum(), own.sum()
    return out


class BoostedModel(Model):
    """Fitted trees and their weights: ``prediction`` and, for classes, ``probability``."""

    def __init__(self, trees: Sequence[T.Tree], weights: Sequence[float], features: str, loss: str):
        super().__init__()
        self.trees, self.treeWeights, self.features, self.loss = list(trees), list(weights), features, loss

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, weights = self.trees, self.treeWeights

        @F.pandas_udf("double")
        def raw(features: pd.Series) -> pd.Series:
            x = np.stack(features.to_numpy()) if len(features) else np.empty((0, 1))
            total = np.zeros(len(x))
            for tree, weight in zip(trees, weights):
                total += weight * tree.value[tree.ends(x)]
            return pd.Series(total)

        scored = dataset.withColumn("__raw", raw(vector_to_array(self.features)))
        if self.loss == "squared":
            return scored.withColumnRenamed("__raw", "prediction")
        p = 1 / (1 + F.exp(-2 * F.col("__raw")))
        return scored.withColumns({"probability": array_to_vector(F.array(1 - p, p)), "prediction": (F.col("__raw") > 0).cast("double")}).drop("__raw")
