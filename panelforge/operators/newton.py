"""Penalised linear classifiers of a whole grid, fitted together by Newton's method.

Every pass over the training rows sums, for all grid points still open, the
loss, its gradient and its Hessian: one job per Newton step instead of one per
step and point. What leaves a partition is points x features^2 / 2 numbers; a
point's sums meet in one task, which solves its small system, and the driver
gets the coefficients. The objective of a point is
``C * sum(weight * loss) + |w|^2 / 2`` with a free intercept.

``fourier`` lifts the rows to random Fourier features of the RBF kernel
``exp(-gamma |x - y|^2)``, so that a linear classifier on them approximates the
kernel classifier at a cost that grows with the rows, not with their square.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: loss, slope and curvature per row, of raw scores f and labels y in {0, 1}.
LOSSES: dict[str, Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]] = {
    "logistic": lambda f, y: (np.logaddexp(0, f) - y * f, _sigmoid(f) - y, _sigmoid(f) * _sigmoid(-f)),
    "squared_hinge": lambda f, y: (_gap(f, y) ** 2, -2 * (2 * y - 1) * _gap(f, y), 2.0 * (_gap(f, y) > 0)),
}


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * f))


def _gap(f: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum(0, 1 - (2 * y - 1) * f)


@dataclass(frozen=True)
class Point:
    """A grid point: inverse penalty, and the width of the RBF kernel if the rows are lifted."""

    c: float
    gamma: float | None = None


def fourier(n_features: int, gamma: float | None, size: int = 100, seed: int = 10) -> Callable[[np.ndarray], np.ndarray]:
    """Lift of a batch of rows, with the intercept's column last; without ``gamma`` the rows as they are."""
    if gamma is None:
        return lambda x: np.column_stack([x, np.ones(len(x))])
    rng = np.random.default_rng(seed)
    w, b = rng.standard_normal((n_features, size)) * np.sqrt(2 * gamma), rng.uniform(0, 2 * np.pi, size)
    return lambda x: np.column_stack([np.sqrt(2 / size) * np.cos(x @ w + b), np.ones(len(x))])


def _hessians(z: np.ndarray, curves: np.ndarray) -> Iterator[np.ndarray]:
    """Upper triangle of ``z' diag(curve) z`` for each column of ``curves``; a column like the one before costs its changed rows alone."""
    upper, last, found = np.triu_indices(z.shape[1]), None, None
    for curve in curves.T:
        used = np.flatnonzero(curve)
        moved = used if last is None else np.flatnonzero(curve != last)
        if last is not None and len(moved) < len(used):
            found = found + (z[moved] * (curve - last)[moved, None]).T @ z[moved]
        else:
            found = (z[used] * curve[used, None]).T @ z[used]
        last = curve
        yield found[upper]


@dataclass
class _Fit:
    """A point under way: its coefficients, the step that led there, the objective before it, and whether it has settled."""

    point: Point
    beta: np.ndarray
    step: np.ndarray | None = None
    before: float = np.inf
    done: bool = False

    def move(self, sums: np.ndarray, tol: float) -> _Fit:
        """The next Newton step, from the sums of the loss, its gradient and the upper triangle of its Hessian."""
        n, c, beta = len(self.beta), self.point.c, self.beta
        free = np.append(np.ones(n - 1), 0.0)
        value = c * sums[0] + 0.5 * (free * beta**2).sum()
        if value > self.before * (1 + 1e-12) and np.abs(self.step).max() > tol:  # too far: go back half the way
            return _Fit(self.point, beta - self.step / 2, self.step / 2, self.before)
        hessian = np.zeros((n, n))
        hessian[np.triu_indices(n)] = c * sums[n + 1 :]
        hessian += np.triu(hessian, 1).T + np.diag(free + 1e-12)
        step = -np.linalg.solve(hessian, c * sums[1 : n + 1] + free * beta)
        return _Fit(self.point, beta + step, step, value, bool(np.abs(step).max() <= tol * (1 + np.abs(beta + step).max())))


def fit_points(train: DataFrame, features: Sequence[str], label: str, points: Sequence[Point], loss: str, weight: str | None = None, size: int = 100,
               tol: float = 1e-8, passes: int = 60) -> list[np.ndarray]:
    """Coefficients of each point, the intercept last. Rows need complete features and labels 0 and 1."""
    names, of = list(features), LOSSES[loss]
    fits = [_Fit(p, np.zeros((len(names) if p.gamma is None else size) + 1)) for p in points]
    rows = train.select(*names, F.col(label).cast("double").alias("__y"), (F.col(weight) if weight else F.lit(1.0)).alias("__w"))
    for _ in range(passes):
        now = {k: fit for k, fit in enumerate(fits) if not fit.done}
        if not now:
            break
        kernels: dict[float | None, list[int]] = {}
        for k in sorted(now, key=lambda k: points[k].c):  # neighbours in C share most of their rows inside the margin
            kernels.setdefault(points[k].gamma, []).append(k)

        def partial(batches: Iterator[pd.DataFrame], now=now, kernels=kernels) -> Iterator[pd.DataFrame]:
            total = {k: np.zeros(1 + len(f.beta) + len(f.beta) * (len(f.beta) + 1) // 2) for k, f in now.items()}
            lifts = {g: fourier(len(names), g, size) for g in kernels}
            some = False
            for batch in batches:
                some = some or len(batch) > 0
                x, y, w = batch[names].to_numpy(float), batch["__y"].to_numpy(float)[:, None], batch["__w"].to_numpy(float)[:, None]
                for g, members in kernels.items():
                    z = lifts[g](x)
                    value, slope, curve = of(z @ np.stack([now[k].beta for k in members], axis=1), y)
                    values, slopes = (w * value).sum(0), z.T @ (w * slope)
                    for i, (k, hessian) in enumerate(zip(members, _hessians(z, w * curve))):
                        total[k] += np.concatenate([values[i : i + 1], slopes[:, i], hessian])
            if some:
                for k, t in total.items():
                    yield pd.DataFrame({"POINT": [k], "SUMS": [t.tobytes()]})

        def solve(batches: Iterator[pd.DataFrame], now=now) -> Iterator[pd.DataFrame]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for k, sums in zip(batch["POINT"], batch["SUMS"]):
                    total[k] = total.get(k, 0.0) + np.frombuffer(sums)
            for k, sums in total.items():
                f = now[k].move(sums, tol)
                yield pd.DataFrame({"POINT": [k], "BETA": [f.beta.tolist()], "STEP": [f.step.tolist()], "BEFORE": [f.before], "DONE": [f.done]})

        # a point's sums meet in a task and become its next step there: what the driver gets are coefficients
        sums = rows.mapInPandas(partial, "POINT int, SUMS binary").repartition("POINT")
        for r in sums.mapInPandas(solve, "POINT int, BETA array<double>, STEP array<double>, BEFORE double, DONE boolean").collect():
            fits[r.POINT] = _Fit(points[r.POINT], np.array(r.BETA), np.array(r.STEP), r.BEFORE, r.DONE)
    return [f.beta for f in fits]


def raw_scores(points: Sequence[Point], betas: Sequence[np.ndarray], n_features: int, size: int = 100) -> Callable[[np.ndarray], np.ndarray]:
    """(point, row) scores of a batch of rows; above 0 is class 1."""

    def scores(x: np.ndarray) -> np.ndarray:
        lifted = {g: fourier(n_features, g, size)(x) for g in {p.gamma for p in points}}
        return np.stack([lifted[p.gamma] @ b for p, b in zip(points, betas)])

    return scores


def predict(rows: DataFrame, features: Sequence[str], point: Point, beta: np.ndarray, size: int = 100, probability: bool = False) -> DataFrame:
    """``rows`` with PREDICTED (0 or 1) and, for the logistic loss, PROBABILITY of class 1."""
    names = list(features)
    score = raw_scores([point], [beta], len(names), size)

    @F.pandas_udf("double")
    def raw(*columns: pd.Series) -> pd.Series:
        return pd.Series(score(np.column_stack([c.to_numpy(float) for c in columns]))[0])

    scored = rows.withColumn("__raw", raw(*[F.col(c) for c in names])).withColumn("PREDICTED", (F.col("__raw") > 0).cast("double"))
    if probability:
        scored = scored.withColumn("PROBABILITY", 1 / (1 + F.exp(-F.col("__raw"))))
    return scored.drop("__raw")
