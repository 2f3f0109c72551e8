"""The landmark SVM against a dense kernel solver, and its certificate."""

import numpy as np
import pytest

from wayfare.ml import svm as S
from wayfare.ml import train as T
from wayfare.sources import sinks


def dense_solution(x, y, gamma, c=1.0, passes=4000):
    """Dual coordinate ascent over the full kernel (plus 1 for the intercept)."""
    k = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(2)) + 1.0
    q = k * np.outer(y, y)
    alpha = np.zeros(len(y))
    g = -np.ones(len(y))
    for _ in range(passes):
        most = 0.0
        for i in range(len(y)):
            new = min(max(alpha[i] - g[i] / q[i, i], 0.0), c)
            if new != alpha[i]:
                g += (new - alpha[i]) * q[:, i]
                most, alpha[i] = max(most, abs(new - alpha[i])), new
        if most < 1e-9:
            break
    return alpha * y, k


def ring(n=500, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = ((np.hypot(x[:, 0], x[:, 1]) + rng.normal(scale=0.2, size=n)) < 1.1).astype(float)
    return x, y


@pytest.mark.parametrize("parts", [1, 7])
def test_decisions_agree_with_a_dense_kernel_solver(spark, tmp_path, parts):
    x, y = ring()
    df = spark.createDataFrame([(k, float(a), float(b), float(t)) for k, ((a, b), t) in enumerate(zip(x, y))],
                               "k long, a double, b double, label double").repartition(parts)
    m = T.train_classifier(df, ["a", "b"], "svm", gamma=0.5)
    assert 0 <= m.gap <= 1e-3
    z = (x - x.mean(0)) / x.std(0)
    coef, k = dense_solution(z, 2 * y - 1, 0.5)
    got = {r["k"]: r for r in m.transform(df).collect()}
    margin = np.array([got[i]["margin"] for i in range(len(y))])
    assert np.mean((margin > 0) == (k @ coef > 0)) >= 0.98
    # The certificate is honest: the objective is within the gap of the dense optimum.
    primal = lambda f, norm: 0.5 * norm + np.maximum(0, 1 - (2 * y - 1) * f).sum()
    best = primal(k @ coef, coef @ k @ coef)
    assert primal(margin, m.w @ m.w) <= best * (1 + m.gap) * 1.01
    p = np.array([got[i]["probability"][1] for i in range(len(y))])
    assert abs(p.mean() - y.mean()) < 0.02 and p[y > 0].mean() > p[y == 0].mean() + 0.4
    sinks.save_model(m, str(tmp_path / "m"))
    again = sinks.load_model(str(tmp_path / "m"))
    assert again.gap == m.gap and [r["margin"] for r in again.transform(df).orderBy("k").collect()] == pytest.approx(margin.tolist())


def test_missing_inputs_and_one_class(spark):
    df = spark.createDataFrame([(float(k), None if k % 5 == 0 else 1.0 * k, float(k > 20)) for k in range(40)] + [(1.0, 1.0, None)],
                               "a double, b double, label double")
    m = T.train_classifier(df, ["a", "b"], "svm")
    got = m.transform(df).where("label IS NOT NULL").collect()
    assert np.mean([r["prediction"] == r["label"] for r in got]) > 0.9
    one = T.train_classifier(df.where("label = 1"), ["a", "b"], "svm")
    assert one.curve == (0.0, 0.0) and one.transform(df).count() == 41
    with pytest.raises(ValueError):
        T.train_classifier(df.selectExpr("a", "b", "label * 2 AS label"), ["a", "b"], "svm")


def test_map_reproduces_the_kernel_between_landmarks():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(40, 3))
    points[5] = points[4]
    f = S.FeatureMap(np.zeros(3), np.ones(3), points, 0.7)
    phi = f(points)[:, :-1]
    assert np.allclose(phi @ phi.T, f.kernel(points), atol=1e-8)


def test_pass_maps_sums_not_rows(spark, monkeypatch):
    """Losses and slopes equal those on mapped rows, while no row is mapped."""
    from wayfare.ml import svm
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(400, 3)), rng.integers(0, 2, 400).astype(float)
    rows = spark.createDataFrame([(k, 0, float(t), [float(v) for v in r]) for k, (r, t) in enumerate(zip(x, y))],
                                 "id long, fold int, y double, x array<double>").repartition(3)
    fmap = svm.FeatureMap(x.mean(0), x.std(0), x[:40], 0.5)
    phi, w = fmap(x), rng.normal(size=(2, fmap.root.shape[1] + 1))
    short = 1 - (2 * y - 1)[:, None] * (phi @ w.T)
    monkeypatch.delattr(svm.FeatureMap, "__call__")
    loss, slope = svm.losses(rows, fmap, w, 2.0)
    assert np.allclose(loss, 2 * np.maximum(short, 0).sum(0))
    assert np.allclose(slope, -2 * ((short > 0) * (2 * y - 1)[:, None]).T @ phi, rtol=1e-7, atol=1e-6)
    m = svm.SvmModel(["a", "b", "c"], fmap, w[0], (1.0, 0.0), 0.0)
    assert np.allclose(m.margins(x), phi @ w[0])
