import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.ml import evaluate as EV
from wayfare.ml import split as SP
from wayfare.ml import train as T
from wayfare.ml.scale import apply_scaler, fit_scaler


@pytest.fixture(scope="module")
def reg(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(400, 3))
    y = X @ np.array([2.0, -1.0, 0.5]) + 3 + rng.normal(scale=0.1, size=400)
    rows = [(i, float(a), float(b), float(c), float(t)) for i, ((a, b, c), t) in enumerate(zip(X, y))]
    return spark.createDataFrame(rows, "k long, a double, b double, c double, y double"), X, y


def test_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    s = fit_scaler(df, ["x"]).first()
    assert abs(s.std_x - np.std([1, 2, 4])) < 1e-12
    const = fit_scaler(spark.createDataFrame([(5.0,), (5.0,)], "x double"), ["x"]).first()
    assert const.std_x == 1.0
    out = apply_scaler(df, fit_scaler(df, ["x"]), ["x"]).agg(F.avg("x_scaled")).first()[0]
    assert abs(out) < 1e-12


def test_ridge_matches_closed_form(reg):
    df, X, y = reg
    m = T.train_price_model(df, ["a", "b", "c"], "ridge", label="y")
    Xs = (X - X.mean(0)) / X.std(0)
    Xc, yc = Xs - Xs.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(3), Xc.T @ yc)
    got = [r.prediction for r in m.transform(df).orderBy("k").collect()]
    assert np.allclose(got, y.mean() + Xs @ w, atol=1e-9)


def test_ols_and_metrics(reg):
    df, X, y = reg
    m = T.train_price_model(df, ["a", "b", "c"], "linear", label="y")
    p = m.transform(df)
    r = EV.regression_metrics(p, "y", "prediction").first()
    pred = np.array([x.prediction for x in p.orderBy("k").collect()])
    e = y - pred
    assert abs(r.rmse - np.sqrt(np.mean(e ** 2))) < 1e-9
    assert abs(r.r2 - (1 - np.sum(e ** 2) / np.sum((y - y.mean()) ** 2))) < 1e-9


def test_classification_metrics_and_matrix(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a")],
                               "label string, prediction string")
    m = EV.classification_metrics(df).first()
    assert abs(m.accuracy - 0.6) < 1e-12
    pc = {r["class"]: r for r in EV.per_class(df).collect()}
    assert pc["c"].precision == 0.0 and pc["c"].recall == 0.0 and pc["c"].support == 1
    cm = {r.actual: r for r in EV.confusion_matrix(df, ["a", "b", "c"]).collect()}
    assert cm["c"]["a"] == 1 and cm["c"]["c"] == 0 and cm["a"]["b"] == 1
    rep = {r["class"] for r in EV.classification_report(df).collect()}
    assert {"accuracy", "macro avg", "weighted avg", "a", "b", "c"} == rep


def test_stratified_split_exact_and_stable(spark):
    rows = [(i, "m" if i % 3 else "f") for i in range(1, 501)]
    df = spark.createDataFrame(rows, "code long, g string")
    a = {r.code: r.is_train for r in SP.stratified_flag(df, "code", "g").collect()}
    b = {r.code: r.is_train for r in SP.stratified_flag(df.repartition(5), "code", "g").collect()}
    assert a == b
    for cls in ("m", "f"):
        n = sum(1 for c, g in rows if g == cls)
        test = sum(1 for c, g in rows if g == cls and not a[c])
        assert test == int(np.floor(0.2 * n + 0.5))


def test_classifier_save_load(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(i, float(x), float(z), float(int(x + z > 0))) for i, (x, z) in enumerate(rng.normal(size=(200, 2)))]
    df = spark.createDataFrame(rows, "k long, x double, z double, label double")
    m = T.train_classifier(df, ["x", "z"], "logistic")
    from wayfare.sources import sinks
    sinks.save_model(m, str(tmp_path / "m"))
    m2 = sinks.load_model(str(tmp_path / "m"))
    a = [r.prediction for r in m.transform(df).orderBy("k").collect()]
    b = [r.prediction for r in m2.transform(df).orderBy("k").collect()]
    assert a == b
    acc = EV.classification_metrics(m.transform(df), "label").first().accuracy
    assert acc > 0.9


def test_folds_are_contiguous_and_of_equal_length(spark):
    rows = [(int(k * 7919 % 1003), float(k % 3)) for k in range(503)]
    df = spark.createDataFrame(rows + [(5, 1.0)] * 20, "k long, x double").repartition(6)
    got = sorted((r["k"], r["x"], r["fold"]) for r in SP.contiguous_folds(df, ["k", "x"], 5).collect())
    assert [f for _, _, f in got] == sorted(f for _, _, f in got)
    assert np.bincount([f for _, _, f in got]).tolist() == [105, 105, 105, 104, 104]
    assert SP.contiguous_folds(df.limit(0), ["k"], 5).count() == 0


def test_lasso_meets_its_optimality_conditions(reg):
    df, X, y = reg
    from wayfare.ml import gram
    noise = df.withColumn("d", F.col("k") % 7)
    fit = gram.fit("lasso", ["a", "b", "c", "d"], gram.fold_sums(noise, ["a", "b", "c", "d"], "y")[None])
    X = np.column_stack([X, np.arange(len(y)) % 7])
    Xs, yc, w = (X - X.mean(0)) / X.std(0), y - y.mean(), fit.weights
    slope = Xs.T @ (yc - Xs @ w) / len(y)
    assert w[3] == 0
    for j in range(4):
        if w[j]:
            assert slope[j] == pytest.approx(T.LASSO_ALPHA * np.sign(w[j]), abs=1e-9)
        else:
            assert abs(slope[j]) <= T.LASSO_ALPHA + 1e-9
    got = [r.prediction for r in fit.pipeline().transform(noise).orderBy("k").collect()]
    assert np.allclose(got, y.mean() + Xs @ w, atol=1e-9)


@pytest.fixture(scope="module")
def ring(spark):
    """A label that no line separates: inside or outside a circle."""
    rng = np.random.default_rng(4)
    X = rng.normal(size=(500, 2))
    label = (np.hypot(X[:, 0], X[:, 1]) < 1.1).astype(float)
    rows = [(i, float(a), float(b), float(t), float(3 * t + a)) for i, ((a, b), t) in enumerate(zip(X, label))]
    return spark.createDataFrame(rows, "k long, a double, b double, label double, price double").persist(), X, label


def test_logistic_meets_its_optimality_conditions(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(300, 2))
    y = (X[:, 0] - X[:, 1] + rng.normal(size=300) > 0).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(X, y)], "a double, b double, label double")
    m = T.train_classifier(df, ["a", "b"], "logistic").stages[-1]
    Xs, w = (X - X.mean(0)) / X.std(0), m.coefficients.toArray()
    p = 1 / (1 + np.exp(-(Xs @ w + m.intercept)))
    assert np.allclose(Xs.T @ (p - y) + w / T.LOGISTIC_C, 0, atol=0.05) and abs((p - y).sum()) < 0.05


@pytest.mark.parametrize("model", ["random_forest", "gradient_boosting"])
def test_price_trees_beat_the_mean_and_survive_saving(ring, tmp_path, model):
    from wayfare.sources import sinks
    df, _, _ = ring
    m = T.train_price_model(df.where("k % 5 > 0"), ["a", "b"], model, num_trees=20)
    test = df.where("k % 5 = 0")
    assert EV.regression_metrics(m.transform(test), "price").first().r2 > 0.7
    sinks.save_model(m, str(tmp_path / "m"))
    again = sinks.load_model(str(tmp_path / "m")).transform(test)
    assert [r.prediction for r in again.orderBy("k").collect()] == [r.prediction for r in m.transform(test).orderBy("k").collect()]


@pytest.mark.parametrize("model", ["random_forest", "gradient_boosting", "svm"])
def test_classifiers_beat_the_majority_and_survive_saving(ring, tmp_path, model):
    from wayfare.sources import sinks
    df, _, label = ring
    args = {"num_trees": 20} if model != "svm" else {"gamma": 1.0}
    m = T.train_classifier(df.where("k % 5 > 0"), ["a", "b"], model, **args)
    test = df.where("k % 5 = 0")
    got = EV.classification_metrics(m.transform(test), "label").first().accuracy
    assert got > max(label.mean(), 1 - label.mean()) + 0.15
    sinks.save_model(m, str(tmp_path / "m"))
    again = sinks.load_model(str(tmp_path / "m")).transform(test)
    assert [r.prediction for r in again.orderBy("k").collect()] == [r.prediction for r in m.transform(test).orderBy("k").collect()]


def test_importances_favour_what_decides(ring):
    df, _, _ = ring
    noise = df.withColumn("c", F.col("k") % 7)
    m = T.train_classifier(noise, ["a", "b", "c"], "random_forest", num_trees=10)
    imp = [(r.feature, r.importance) for r in T.feature_importance(m, ["a", "b", "c"], top=2).collect()]
    assert {f for f, _ in imp} == {"a", "b"} and imp[0][1] >= imp[1][1]


def flights(spark, n=300):
    from small_tables import flights_df
    import datetime
    rng = np.random.default_rng(6)
    rows = [(k, k % 40, "ABC"[k % 3], "XYZ"[k % 2], "economic", float(rng.integers(50, 90) + 100 * (k % 3)), 2.0 + k % 5, 500 + k % 50,
             "CloudFy", datetime.date(2023, 1, 1) + datetime.timedelta(days=k % 300)) for k in range(n)]
    return flights_df(spark, rows)


def test_cross_validation_matches_numpy(spark):
    from wayfare.ml import features as MF
    from wayfare.ml import runs as RN
    f = MF.flight_features(flights(spark), keep=["travelCode"])
    order = ["travelCode", *MF.FLIGHT_FEATURES_8, "price"]
    got = {r["fold"]: r["r2"] for r in RN.cross_validate(f, MF.FLIGHT_FEATURES_8, ["ridge"], order).collect()}
    data = f.orderBy(*order).toPandas()
    X, y = data[MF.FLIGHT_FEATURES_8].to_numpy(float), data["price"].to_numpy()
    sd = X.std(0)
    X = (X - X.mean(0)) / np.where(sd == 0, 1, sd)
    scores = []
    for part in np.array_split(np.arange(len(y)), 5):
        rest = np.setdiff1d(np.arange(len(y)), part)
        A, b = X[rest], y[rest]
        w = np.linalg.solve((A - A.mean(0)).T @ (A - A.mean(0)) + np.eye(X.shape[1]), (A - A.mean(0)).T @ (b - b.mean()))
        e = y[part] - (b.mean() + (X[part] - A.mean(0)) @ w)
        scores.append(1 - (e ** 2).sum() / ((y[part] - y[part].mean()) ** 2).sum())
    assert [got[f"fold_{k}"] for k in range(5)] == pytest.approx(scores, abs=1e-9)
    assert got["mean"] == pytest.approx(np.mean(scores), abs=1e-9) and got["std"] == pytest.approx(np.std(scores), abs=1e-9)


def test_tracked_training_logs_all_models_and_the_best(spark, tmp_path):
    from wayfare.ml import runs as RN
    f = flights(spark)
    path = str(tmp_path / "runs")
    RN.tracked_training(f, runs_path=path, num_trees=3, max_depth=3)
    rows = RN.read_runs(spark, path).collect()
    wide = {}
    for r in rows:
        wide.setdefault(r["model_type"], {})[r["metric"]] = r["value"]
    assert set(wide) == set(RN.TRACKED_MODELS)
    assert wide["ridge"]["param_alpha"] == 1.0 and wide["random_forest"]["param_max_depth"] == 3.0
    best = max(RN.TRACKED_MODELS, key=lambda m: wide[m]["test_r2"])
    assert [m for m in RN.TRACKED_MODELS if wide[m]["is_best"] == 1.0] == [best]
    assert all({"train_r2", "test_rmse", "cv_r2_mean", "cv_r2_std"} <= set(v) for v in wide.values())


def test_missing_request_features_are_zero_and_legacy_names_count(spark):
    from wayfare.ml import features as MF
    from wayfare.operators import encoding as E
    companies = E.build_dictionary(spark.createDataFrame([("A",), ("B",), ("C",)], "company string"), "company")
    rows = [(1, "B", None, 7.0, 30), (2, "B", 0.0, 7.0, 30), (3, "New", 5.0, None, None), (4, None, 5.0, 1.0, 2)]
    req = spark.createDataFrame(rows, "request_id long, company string, avg_distance double, avg_price double, age int")
    got = {r["request_id"]: r.asDict() for r in MF.request_features(req, companies).collect()}
    same = lambda k: {c: v for c, v in got[k].items() if c != "request_id"}
    assert same(1) == same(2) and got[1]["avg_flight_price"] == 7.0 and got[1]["company_encoded"] == 1.0
    assert got[3]["avg_flight_price"] == 0.0 == got[3]["age"] and got[3]["company_encoded"] == 0.0 == got[4]["company_encoded"]
    named = req.withColumnRenamed("avg_price", "avg_flight_price")
    assert [r.asDict() for r in MF.request_features(named, companies).orderBy("request_id").collect()] == [got[k] for k in (1, 2, 3, 4)]
    assert all(v is not None for r in got.values() for v in r.values())


def test_dictionary_row_matches_the_join_form(spark):
    from wayfare.operators import encoding as E
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 1), ("c", None)], "x string, y int")
    row = E.dictionary_row(df, ["x", "y"])
    asked = spark.createDataFrame([("a", 1), ("zz", 2), (None, None)], "x string, y int")
    got = [(r.x_encoded, r.y_encoded) for r in E.encode_columns(asked, row).collect()]
    assert got == [(0, 0), (0, 1), (0, 0)]
    table = {(r["field"], r["value"]): r["code"] for r in E.dictionary_table(row).collect()}
    assert table == {("x", "a"): 0, ("x", "b"): 1, ("x", "c"): 2, ("y", "1"): 0, ("y", "2"): 1}
    back = E.decode_column(spark.createDataFrame([(2,), (9,)], "c int"), row, "x", "c", "label")
    assert [r["label"] for r in back.collect()] == ["c", None]


def test_classifier_metrics_compare_codes_as_numbers(spark):
    rng = np.random.default_rng(1)
    rows = [(float(x), float(z), int(x + z > 0)) for x, z in rng.normal(size=(200, 2))]
    df = spark.createDataFrame(rows, "x double, z double, label int")
    m = T.train_classifier(df, ["x", "z"], "logistic")
    got = {r["split"]: r["accuracy"] for r in T.evaluate_classifier(m, df, df.limit(50)).collect()}
    assert got["train"] > 0.9 and got["test"] > 0.8


def test_cross_validation_of_all_tracked_models_leaves_no_cache(spark):
    from wayfare.ml import features as MF
    from wayfare.ml import runs as RN
    f = MF.flight_features(flights(spark), keep=["travelCode"])
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    got = RN.cross_validate(f, MF.FLIGHT_FEATURES_8, RN.TRACKED_MODELS, ["travelCode", *MF.FLIGHT_FEATURES_8, "price"], 3,
                            num_trees=3, max_depth=3).collect()
    assert {(r["model_type"], r["fold"]) for r in got} == {(m, k) for m in RN.TRACKED_MODELS
                                                          for k in ("fold_0", "fold_1", "fold_2", "mean", "std")}
    assert all(r["r2"] is not None and r["r2"] == r["r2"] for r in got)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= before
