"""Linear models from sums of products, taken by fold in one scan.

One aggregation gives, per fold, the row count and the sums of x, y, xx', xy and
yy. A training set is the total less a fold, so the full fit and every fold's fit
and R2 need no further scan:

* least squares: the normal equations of the centred sums;
* ridge: the same with alpha on the diagonal (Cholesky);
* lasso: coordinate descent on the centred sums.

Inputs are scaled by the mean and population standard deviation of all training
rows. The sums are a few numbers per pair of features, whatever the table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RIDGE_ALPHA = 1.0
LASSO_ALPHA = 0.1


@dataclass
class Sums:
    """Sums over some rows: n, x, y, xx', xy, yy."""

    n: float
    x: np.ndarray
    y: float
    xx: np.ndarray
    xy: np.ndarray
    yy: float

    def __sub__(self, o: "Sums") -> "Sums":
        return Sums(*(getattr(self, k) - getattr(o, k) for k in ("n", "x", "y", "xx", "xy", "yy")))

    def __add__(self, o: "Sums") -> "Sums":
        return Sums(*(getattr(self, k) + getattr(o, k) for k in ("n", "x", "y", "xx", "xy", "yy")))

    def spread(self) -> tuple[np.ndarray, np.ndarray]:
        """(mean, population standard deviation; 1 where it is 0) of each feature."""
        n = max(self.n, 1)
        mean = self.x / n
        var = np.diag(self.xx) / n - mean ** 2
        return mean, np.sqrt(np.where(var > 1e-14 * (1 + mean ** 2), var, 1.0))


def none(k: int) -> Sums:
    return Sums(0.0, np.zeros(k), 0.0, np.zeros((k, k)), np.zeros(k), 0.0)


def fold_sums(df: DataFrame, features: list[str], label: str, fold=None) -> dict[int | None, Sums]:
    """Sums by value of the column ``fold`` (default: all rows as None); rows
    with a null label or feature are left out."""
    x = [F.col(f"`{c}`").cast("double") for c in features]
    y = F.col(f"`{label}`").cast("double")
    whole = y.isNotNull()
    for c in x:
        whole = whole & c.isNotNull()
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("y"), F.sum(y * y).alias("yy")]
    aggs += [F.sum(c).alias(f"x{i}") for i, c in enumerate(x)] + [F.sum(c * y).alias(f"p{i}") for i, c in enumerate(x)]
    aggs += [F.sum(x[i] * x[j]).alias(f"q{i}_{j}") for i, j in pairs]
    rows = df.where(whole).groupBy((F.lit(None).cast("int") if fold is None else fold).alias("fold")).agg(*aggs).collect()
    out = {}
    for r in rows:
        xx = np.zeros((len(x), len(x)))
        for i, j in pairs:
            xx[i, j] = xx[j, i] = r[f"q{i}_{j}"]
        out[r["fold"]] = Sums(float(r["n"]), np.array([r[f"x{i}"] for i in range(len(x))]), r["y"], xx,
                              np.array([r[f"p{i}"] for i in range(len(x))]), r["yy"])
    return out


@dataclass
class LinearFit:
    """y = intercept + sum of weights * (x - mean) / std."""

    features: list[str]
    mean: np.ndarray
    std: np.ndarray
    weights: np.ndarray
    intercept: float
    parameters: dict = field(default_factory=dict)

    def r2(self, s: Sums) -> float:
        """R2 on the rows behind the sums (as ``regression_metrics`` has it)."""
        w = self.weights / self.std
        a = self.intercept - w @ self.mean
        sse = s.yy - 2 * a * s.y - 2 * w @ s.xy + s.n * a * a + 2 * a * (w @ s.x) + w @ s.xx @ w
        sst = s.yy - s.y ** 2 / s.n if s.n else 0.0
        if sst <= 1e-12 * max(s.yy, 1e-300):
            return float(sse <= 1e-12 * max(s.yy, 1e-300))
        return float(1.0 - sse / sst)

    def pipeline(self) -> PipelineModel:
        """As a saved-and-loaded ML model: two projections."""
        number = lambda v: f"CAST('{float(v)!r}' AS DOUBLE)"
        scaled = [f"(CAST(`{c}` AS DOUBLE) - {number(m)}) / {number(s)} AS `{c}_scaled`"
                  for c, m, s in zip(self.features, self.mean, self.std)]
        total = " + ".join([number(self.intercept), *(f"{number(w)} * `{c}_scaled`"
                                                      for c, w in zip(self.features, self.weights))])
        return PipelineModel(stages=[SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__"),
                                     SQLTransformer(statement=f"SELECT *, {total} AS prediction FROM __THIS__")])


def lasso_weights(c: np.ndarray, xy: np.ndarray, penalty: float, tol: float = 1e-12, rounds: int = 100_000) -> np.ndarray:
    """Coordinate descent on the centred sums, to a relative change below ``tol``."""
    w = np.zeros(len(xy))
    for _ in range(rounds):
        most = 0.0
        for j in range(len(w)):
            if c[j, j] <= 0:
                continue
            rest = xy[j] - c[j] @ w + c[j, j] * w[j]
            new = np.sign(rest) * max(abs(rest) - penalty, 0.0) / c[j, j]
            most, w[j] = max(most, abs(new - w[j])), new
        if most <= tol * max(1.0, np.abs(w).max(initial=0.0)):
            break
    return w


def fit(kind: str, features: list[str], train: Sums, scale: tuple[np.ndarray, np.ndarray] | None = None) -> LinearFit:
    """``linear``, ``ridge`` or ``lasso`` from the sums of the training rows."""
    mean, std = scale or train.spread()
    n = max(train.n, 1)
    xbar, ybar = train.x / n, train.y / n
    c = (train.xx - n * np.outer(xbar, xbar)) / np.outer(std, std)
    xy = (train.xy - n * xbar * ybar) / std
    if kind == "ridge":
        low = np.linalg.cholesky(c + RIDGE_ALPHA * np.eye(len(xy)))
        w = np.linalg.solve(low.T, np.linalg.solve(low, xy))
    elif kind == "lasso":
        w = lasso_weights(c, xy, LASSO_ALPHA * n)
    else:
        w = np.linalg.lstsq(c, xy, rcond=1e-12)[0]
    alpha = {"ridge": RIDGE_ALPHA, "lasso": LASSO_ALPHA}.get(kind)
    return LinearFit(list(features), mean, std, w, float(ybar - w @ ((xbar - mean) / std)),
                     {} if alpha is None else {"alpha": alpha})


def fit_folds(kind: str, features: list[str], sums: dict[int | None, Sums], folds: int):
    """(fit on all training rows, R2 of each fold by a fit on the others).
    ``sums`` has folds 0, 1, ... of the training rows; test rows are under None."""
    k = len(features)
    total = none(k)
    for f in range(folds):
        total = total + sums.get(f, none(k))
    scale = total.spread()
    scores = []
    for f in range(folds):
        held = sums.get(f, none(k))
        scores.append(fit(kind, features, total - held, scale).r2(held) if held.n else float("nan"))
    return fit(kind, features, total, scale), scores
