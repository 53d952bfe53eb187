"""Fitted tree models as node tables: scores at every depth or round from one fit, importance by weight and gain.

A fitted MLlib tree model is saved and read back as a table with one row per
node. The table gives importances as plain aggregates. For scoring it becomes
arrays, bounded by the model itself (trees x nodes, which the driver holds
anyway), and each batch of rows is walked down all trees once:

* at every depth of a grid, a tree cut at depth d is the tree that a fit with
  ``maxDepth = d`` grows, as MLlib grows level by level and an inner node keeps
  the prediction a leaf would have. For classes, siblings that end in the same
  class are merged by the fit; the cut tree is merged the same way.
* after every round, a boosted model cut at m trees is the model that a fit with
  ``maxIter = m`` gives.

The first does not hold where the draws of a fit depend on its depth: a forest
that draws features per node draws them in another order in a deeper fit. The
cut forest is then another, equally random forest of that depth.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.session import shared_scratch


def node_table(model, spark: SparkSession) -> DataFrame:
    """TREE, NODE, LEFT, RIGHT (-1 at leaves), FEATURE, THRESHOLD, CATEGORIES, PREDICTION, STATS, N, GAIN of every node of a fitted tree model."""
    path = shared_scratch(spark, "tree-model")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    if "nodeData" in saved.columns:
        saved = saved.select(F.col("treeID").alias("TREE"), "nodeData.*")
    else:
        saved = saved.withColumn("TREE", F.lit(0))
    return saved.select(
        "TREE", F.col("id").alias("NODE"), F.col("leftChild").alias("LEFT"), F.col("rightChild").alias("RIGHT"),
        F.col("split.featureIndex").alias("FEATURE"), F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1)).alias("THRESHOLD"),
        F.col("split.numCategories").alias("CATEGORIES"), F.col("prediction").alias("PREDICTION"), F.col("impurityStats").alias("STATS"),
        F.col("rawCount").alias("N"), F.col("gain").alias("GAIN"),
    )


def importance_table(model, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """Per feature the normalised importance, WEIGHT (splits that use it), TOTAL_GAIN and GAIN (impurity decrease times rows: sum, and mean per split)."""
    names = spark.createDataFrame([(i, f, float(v)) for i, (f, v) in enumerate(zip(features, model.featureImportances.toArray()))], "FEATURE int, NAME string, IMPORTANCE double")
    used = node_table(model, spark).where("LEFT >= 0").groupBy("FEATURE").agg(F.count(F.lit(1)).alias("WEIGHT"), F.sum(F.col("GAIN") * F.col("N")).alias("TOTAL_GAIN"))
    found = names.join(used, "FEATURE", "left").fillna({"WEIGHT": 0, "TOTAL_GAIN": 0.0})
    return found.select(F.col("NAME").alias("FEATURE"), "IMPORTANCE", "WEIGHT", "TOTAL_GAIN", (F.col("TOTAL_GAIN") / F.greatest("WEIGHT", F.lit(1))).alias("GAIN"))


@dataclass
class Tree:
    """Nodes of one tree as arrays; children of a node come after it."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray  # prediction, or the shares of the classes: (nodes, classes)
    label: np.ndarray  # predicted class of each node; empty for regression

    def depths(self) -> np.ndarray:
        depth = np.zeros(len(self.left), np.int64)
        for k in np.flatnonzero(self.left >= 0):
            depth[self.left[k]] = depth[self.right[k]] = depth[k] + 1
        return depth

    def step(self, node: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The children that the rows of ``x`` go to; rows at a leaf stay."""
        inner = self.left[node] >= 0
        goes_left = x[np.arange(len(x)), np.maximum(self.feature[node], 0)] <= self.threshold[node]
        return np.where(inner, np.where(goes_left, self.left[node], self.right[node]), node)

    def ends(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        node = np.zeros(len(x), np.int64)
        while len(x) and (self.left[node] >= 0).any():
            node = self.step(node, x)
        return node

    def cut_ends(self, x: np.ndarray, depths: Sequence[int]) -> np.ndarray:
        """(depth, row): the node that a row ends in, in the tree cut at each depth."""
        at, stops = self.depths(), []
        for d in depths:
            stop = (self.left < 0) | (at >= d)
            if len(self.label):  # siblings that end in the same class are one leaf
                ends = np.where(stop, self.label, -1)
                for k in range(len(ends) - 1, -1, -1):
                    if not stop[k] and ends[self.left[k]] == ends[self.right[k]]:
                        ends[k] = ends[self.left[k]]
                stop = ends >= 0
            stops.append(stop)
        out, node = np.full((len(depths), len(x)), -1), np.zeros(len(x), np.int64)
        for _ in range(int(at.max()) + 1):
            for found, stop in zip(out, stops):
                now = (found < 0) & stop[node]
                found[now] = node[now]
            node = self.step(node, x)
        return out


def trees_of(model, spark: SparkSession) -> list[Tree]:
    """The trees of a fitted model as arrays (continuous features only)."""
    nodes = node_table(model, spark).orderBy("TREE", "NODE").toPandas()
    if (nodes["CATEGORIES"] > 0).any():
        raise ValueError("categorical splits are not supported")
    classes = getattr(model, "numClasses", 0) if not hasattr(model, "treeWeights") or not _boosted(model) else 0
    out = []
    for _, one in nodes.groupby("TREE", sort=True):
        value = one["PREDICTION"].to_numpy(float)
        label = np.empty(0, np.int64)
        if classes:
            stats = np.stack(one["STATS"].to_numpy()).astype(float)
            value, label = stats / np.maximum(stats.sum(1, keepdims=True), 1e-300), one["PREDICTION"].to_numpy(np.int64)
        out.append(Tree(one["LEFT"].to_numpy(np.int64), one["RIGHT"].to_numpy(np.int64), one["FEATURE"].to_numpy(np.int64), one["THRESHOLD"].fillna(0).to_numpy(float), value, label))
    return out


def _boosted(model) -> bool:
    return type(model).__name__.startswith("GBT")


def by_depth(trees: Sequence[Tree], x: np.ndarray, depths: Sequence[int]) -> np.ndarray:
    """(depth, row): the forest's prediction - mean, or class with the largest mean share - with all trees cut at each depth."""
    total = 0
    for tree in trees:
        total = total + tree.value[tree.cut_ends(x, depths)]
    return total.argmax(-1).astype(float) if len(trees[0].label) else total / len(trees)


def by_round(trees: Sequence[Tree], weights: Sequence[float], x: np.ndarray) -> np.ndarray:
    """(round, row): the boosted sum after each round."""
    return np.cumsum([w * tree.value[tree.ends(x)] for tree, w in zip(trees, weights)], axis=0)


#: Loss per (stage, row) of raw predictions; boosted classes are told by the sign and have labels 0 and 1.
LOSSES: dict[str, Callable[[np.ndarray, np.ndarray], np.ndarray]] = {
    "squared": lambda raw, y: (raw - y) ** 2,
    "wrong_class": lambda raw, y: (raw != y).astype(float),
    "wrong_sign": lambda raw, y: ((raw > 0) != (y > 0.5)).astype(float),
    "log": lambda raw, y: np.logaddexp(0, -2 * raw * (2 * y - 1)),
}


def staged_loss(rows: DataFrame, features: Sequence[str], label: str, staged: Callable[[np.ndarray], np.ndarray], loss: str) -> DataFrame:
    """STAGE (from 0), LOSS (sum over the rows) and N. ``staged`` gives (stage, row) predictions of a batch of rows.

    A batch leaves one row per stage, so what is summed does not grow with stages times rows.
    """
    names, of = list(features), LOSSES[loss]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                sums = of(staged(batch[names].to_numpy(float)), batch[label].to_numpy(float)).sum(1)
                yield pd.DataFrame({"STAGE": np.arange(len(sums)), "LOSS": sums, "N": len(batch)})

    parts = rows.select(*names, F.col(label).cast("double").alias(label)).mapInPandas(run, "STAGE long, LOSS double, N long")
    return parts.groupBy("STAGE").agg(F.sum("LOSS").alias("LOSS"), F.sum("N").alias("N"))


def depth_loss(model, rows: DataFrame, features: Sequence[str], label: str, depths: Sequence[int], loss: str) -> DataFrame:
    trees, wanted = trees_of(model, rows.sparkSession), list(depths)
    return staged_loss(rows, features, label, lambda x: by_depth(trees, x, wanted), loss)
