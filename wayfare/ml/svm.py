"""Support vector classifier with an RBF kernel, with a certified optimum.

* *Landmarks* (a bounded sample of ``landmarks`` rows, those with the least hash of
  their number) give the feature map K(x, L) K(L, L)^(-1/2) (Nystroem): products of
  mapped rows are the kernel, exactly between landmarks. A constant feature carries
  the intercept.
* The objective is minimised by cutting planes (a bundle method). One pass over the
  rows gives, for a few weights on the line from the best ones to the proposed ones,
  the hinge losses and their slopes; each is a plane below the losses. The next
  proposal minimises the norm plus the greatest plane, a small problem in the number
  of planes, and its value is a lower bound: the dual of what the planes know.
* Passes end when the best objective is within ``gap`` (relatively) of that bound. The
  *duality gap* reached is kept with the model.
* Probabilities are a logistic curve over the margin (Platt).

A pass only adds up sums, so it does not matter how many tasks the rows lie in. The
landmarks, weights and sums reach the driver, rows never do.
"""

from __future__ import annotations

import pickle
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .rows import row_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Places on the line between the best and the proposed weights.
STEPS = (0.0625, 0.125, 0.25, 0.5, 1.0)
META = "features array<string>, model binary, gap double"


class FeatureMap:
    def __init__(self, mean: np.ndarray, std: np.ndarray, landmarks: np.ndarray, gamma: float):
        self.mean, self.std, self.gamma = mean, std, gamma
        self.points = (landmarks - mean) / std
        values, vectors = np.linalg.eigh(self.kernel(self.points))
        keep = values > 1e-10 * max(values.max(initial=0.0), 1e-300)
        self.root = vectors[:, keep] / np.sqrt(values[keep])

    def kernel(self, z: np.ndarray) -> np.ndarray:
        d = (z * (2 * self.gamma)) @ self.points.T
        d -= self.gamma * (z ** 2).sum(1)[:, None]
        d -= self.gamma * (self.points ** 2).sum(1)
        np.minimum(d, 0.0, out=d)
        return np.exp(d, out=d)

    def kernels(self, x: np.ndarray) -> np.ndarray:
        """K(x, L): a row's features are these times ``root``, and the constant."""
        return self.kernel((np.where(np.isfinite(x), x, self.mean) - self.mean) / self.std)

    def on_kernels(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights of features as weights of K(x, L), and the constant's."""
        return weights[..., :-1] @ self.root.T, weights[..., -1]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.kernels(x) @ self.root, np.ones((len(x), 1))], 1)


def losses(rows: DataFrame, fmap: FeatureMap, weights: np.ndarray, c: float, lanes: int = 16):
    """Per weights: c times the sum of hinge losses over all rows, and its slope.

    Rows are multiplied with the weights of their kernels and add up slopes on them; the
    map from kernels to features is applied to the weights and the sums, not to each row."""
    inner, constant = fmap.on_kernels(weights)
    shape = (len(weights), inner.shape[1] + 2)

    def part(batches):
        total = np.zeros(shape)
        for b in row_batches(batches, 20_000):
            # Few rows at a time: their kernels stay in the cache.
            for at in range(0, len(b["y"]), 1_000):
                k, y = fmap.kernels(b["x"][:, at:at + 1_000].T), 2.0 * b["y"][at:at + 1_000] - 1.0
                short = 1.0 - y[:, None] * (k @ inner.T + constant)
                active = short > 0
                side = active * y[:, None]
                total[:, 0] += c * np.where(active, short, 0.0).sum(0)
                total[:, 1:-1] -= c * (side.T @ k)
                total[:, -1] -= c * side.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

    def add(batches):
        total = np.zeros(shape)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.frombuffer(x).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])
    got = rows.select("id", "fold", "y", "x").mapInArrow(part, "s binary").repartition(lanes).mapInArrow(add, "s binary").collect()
    total = np.sum([np.frombuffer(r["s"]).reshape(shape) for r in got], axis=0)
    return total[:, 0], np.concatenate([total[:, 1:-1] @ fmap.root, total[:, -1:]], 1)


def heaviest(planes: np.ndarray, offsets: np.ndarray, beta: np.ndarray, tol: float = 1e-10) -> np.ndarray:
    """Weights of the planes (and of 0, the last) that maximise offsets . beta - |planes' beta|^2 / 2
    over the simplex: steps between the two planes that gain most."""
    n = len(offsets)
    gram, b = np.zeros((n + 1, n + 1)), np.append(offsets, 0.0)
    gram[:n, :n] = planes @ planes.T
    slope = b - gram @ beta
    for _ in range(400 * (n + 1)):
        held = np.flatnonzero(beta > 0)
        i, j = int(np.argmax(slope)), int(held[np.argmin(slope[held])])
        d = slope[i] - slope[j]
        if d <= tol * max(1.0, abs(b @ beta)):
            break
        q = gram[i, i] + gram[j, j] - 2 * gram[i, j]
        step = min(beta[j], d / q if q > 0 else np.inf)
        beta[i] += step
        beta[j] -= step
        slope -= step * (gram[:, i] - gram[:, j])
    return beta


class SvmModel:
    """A fitted classifier over named feature columns; ``gap``: relative duality gap."""

    def __init__(self, features: list[str], fmap: FeatureMap, w: np.ndarray, curve: tuple[float, float], gap: float):
        self.features, self.fmap, self.w, self.curve, self.gap = list(features), fmap, w, curve, gap

    def margins(self, x: np.ndarray) -> np.ndarray:
        inner, constant = self.fmap.on_kernels(self.w)
        return self.fmap.kernels(x) @ inner + constant

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``margin``, ``probability`` of both classes and ``prediction`` (the margin's side)."""
        fmap, (inner, constant) = self.fmap, self.fmap.on_kernels(self.w)

        @F.pandas_udf("double")
        def margin(x: pd.DataFrame) -> pd.Series:
            return pd.Series(fmap.kernels(x.to_numpy(np.float64, na_value=np.nan)) @ inner + constant)
        x = margin(F.struct(*[F.col(f"`{c}`").cast("double").alias(f"f{k}") for k, c in enumerate(self.features)]))
        a, b = self.curve
        p = 1.0 / (1.0 + F.exp(-(a * F.col("margin") + b)))
        return df.withColumn("margin", x).withColumn("probability", F.array(1.0 - p, p)) \
                 .withColumn("prediction", (F.col("margin") > 0).cast("double"))

    def save(self, spark: SparkSession, path: str) -> None:
        model = pickle.dumps((self.fmap.mean, self.fmap.std, self.fmap.points * self.fmap.std + self.fmap.mean, self.fmap.gamma,
                              self.fmap.root, self.fmap.points, self.w, self.curve))
        spark.createDataFrame([(self.features, bytearray(model), self.gap)], META).coalesce(1).write.mode("overwrite").parquet(f"{path}/svm_model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "SvmModel":
        features, model, gap = spark.read.schema(META).parquet(f"{path}/svm_model").first()
        mean, std, landmarks, gamma, root, points, w, curve = pickle.loads(bytes(model))
        fmap = FeatureMap(mean, std, landmarks, gamma)
        fmap.root, fmap.points = root, points
        return SvmModel(features, fmap, w, curve, gap)


def platt(margins: DataFrame) -> tuple[float, float]:
    """(a, b) of the most likely 1 / (1 + exp(-(a m + b))) over rows (m, y 0/1): damped Newton, one small aggregation a step."""
    n = margins.agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q")).first()
    if not n["p"] or not n["q"]:
        return 0.0, 0.0
    # Platt's smoothed targets.
    hi, lo = (n["p"] + 1) / (n["p"] + 2), 1 / (n["q"] + 2)
    t = F.when(F.col("y") > 0, F.lit(hi)).otherwise(F.lit(lo))
    beta = np.array([0.0, np.log((n["p"] + 1) / (n["q"] + 1))])
    for _ in range(25):
        p = 1.0 / (1.0 + F.exp(-(F.lit(float(beta[0])) * F.col("m") + F.lit(float(beta[1])))))
        d, h = t - p, p * (1 - p)
        r = margins.agg(F.sum(d * F.col("m")), F.sum(d), F.sum(h * F.col("m") ** 2), F.sum(h * F.col("m")), F.sum(h)).first()
        step = np.linalg.solve(np.array([[r[2], r[3]], [r[3], r[4]]]) + 1e-9 * np.eye(2), np.array([r[0], r[1]]))
        beta = beta + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit_svm(rows: DataFrame, features: list[str], mean: np.ndarray, std: np.ndarray, c: float = 1.0, gamma: float | None = None,
            landmarks: int = 256, gap: float = 1e-3, passes: int = 200) -> SvmModel:
    """Over a written table of ``rows.model_rows`` with labels 0 and 1."""
    gamma = gamma or 1.0 / max(len(features), 1)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(landmarks).collect()  # the bounded sample
    points = np.array([r["x"] for r in sample], float).reshape(len(sample), len(features))
    fmap = FeatureMap(mean, std, np.where(np.isfinite(points), points, mean), gamma)
    size = fmap.root.shape[1] + 1
    planes, offsets, beta = np.zeros((0, size)), np.zeros(0), np.ones(1)
    best, best_w, proposed, apart = np.inf, np.zeros(size), np.zeros(size), np.inf
    for k in range(passes):
        tried = proposed[None] if k == 0 else np.stack([best_w + t * (proposed - best_w) for t in STEPS])
        loss, slope = losses(rows, fmap, tried, c)
        value = 0.5 * (tried ** 2).sum(1) + loss
        if value.min() < best:
            best, best_w = float(value.min()), tried[value.argmin()]
        planes, offsets = np.concatenate([planes, slope]), np.concatenate([offsets, loss - (slope * tried).sum(1)])
        beta = heaviest(planes, offsets, np.concatenate([beta[:-1], np.zeros(len(tried)), beta[-1:]]))
        proposed = -(planes.T @ beta[:-1])
        apart = (best - (offsets @ beta[:-1] - 0.5 * proposed @ proposed)) / max(best, 1e-300)
        if apart <= gap:
            break
    model = SvmModel(features, fmap, best_w, (1.0, 0.0), max(float(apart), 0.0))
    named = rows.select(F.col("y"), *[F.get("x", F.lit(j)).alias(f) for j, f in enumerate(features)])
    margins = model.transform(named).select(F.col("margin").alias("m"), "y").persist()
    try:
        model.curve = platt(margins)
    finally:
        margins.unpersist()
    return model
