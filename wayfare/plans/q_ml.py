"""Registered model queries and the daily pipeline report.

Split, feature and metric queries have SQL oracles (metrics are computed on
SQL-expressible predictors: a least-squares line for price, a fixed rule for
the classifier). Model fits (forests, boosting, regularised regressions,
SVM) have no SQL form and are registered without an oracle; they use the
original model sizes.
"""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import stable
from ..ml import evaluate as EV
from ..ml import features as MF
from ..ml import runs as RN
from ..ml import split as SP
from ..ml import train as T
from ..operators import features as FT
from ..operators import recommend as RC
from ..operators import requests as R
from ..session import written
from ..sources import adapters as A
from ..sources import sinks
from .catalog import query, tables
from .q_analytics import _PRICE_REQ
from .q_features import FA_SQL, SPLIT_SQL

HASH_SQL = '(((code % 1000003) + 1000003) % 1000003 * 7919 + 42) % 1000003'


def s9(x: str) -> str:
    return f"(floor(({x}) * 1000000000 + 0.5) / 1000000000)"


def s6(x: str) -> str:
    """Money-sized metrics (RMSE, MAE ~1e4) carry ~1e-8 of order noise: 6 decimals."""
    return f"(floor(({x}) * 1000000 + 0.5) / 1000000)"


def _metric_cols(df, cols, digits=9):
    return df.select(*[stable(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- splits

@query("train_test_split", f"""
SELECT "travelCode", {SPLIT_SQL} AS is_train FROM flights
""")
def q_train_test_split(spark, sf):
    _, f, _ = tables(spark, sf)
    return f.select("travelCode", SP.split_flag("travelCode").alias("is_train"))


STRAT_SQL = f"""
strat AS (SELECT code, gender, rn > floor(n * 0.2 + 0.5) AS is_train FROM (
  SELECT code, gender, row_number() OVER (PARTITION BY gender ORDER BY {HASH_SQL}, code) AS rn,
         count(*) OVER (PARTITION BY gender) AS n FROM users))
"""


@query("stratified_split", f", {STRAT_SQL.strip()}\nSELECT * FROM strat")
def q_stratified_split(spark, sf):
    u, _, _ = tables(spark, sf)
    return SP.stratified_flag(u.select("code", "gender"), "code", "gender")


FEATURE_DICTS = """
d_from AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code
             FROM (SELECT DISTINCT "from" AS value FROM flights WHERE "from" IS NOT NULL)),
d_to AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code
         FROM (SELECT DISTINCT "to" AS value FROM flights WHERE "to" IS NOT NULL)),
d_type AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code
           FROM (SELECT DISTINCT "flightType" AS value FROM flights WHERE "flightType" IS NOT NULL)),
d_agency AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code
             FROM (SELECT DISTINCT agency AS value FROM flights WHERE agency IS NOT NULL))
"""
FLIGHT_FEATURE_SQL = """
SELECT f."travelCode", f."time", f.distance, coalesce(d_from.code, 0) AS from_encoded,
       coalesce(d_to.code, 0) AS to_encoded, coalesce(d_type.code, 0) AS "flightType_encoded",
       coalesce(d_agency.code, 0) AS agency_encoded, CAST(month(f."date") AS INTEGER) AS "month",
       CAST(isodow(f."date") - 1 AS INTEGER) AS day_of_week, CAST(isodow(f."date") >= 6 AS INTEGER) AS is_weekend,
       f.price
FROM flights f LEFT JOIN d_from ON f."from" = d_from.value LEFT JOIN d_to ON f."to" = d_to.value
LEFT JOIN d_type ON f."flightType" = d_type.value LEFT JOIN d_agency ON f.agency = d_agency.value
"""


@query("flight_features", f", {FEATURE_DICTS.strip()}\n{FLIGHT_FEATURE_SQL.strip()}")
def q_flight_features(spark, sf):
    _, f, _ = tables(spark, sf)
    return MF.flight_features(f, keep=["travelCode"])


# ------------------------------------------------ metrics on SQL predictors

OLS_SQL = f"""
fl AS (SELECT *, {SPLIT_SQL} AS is_train FROM flights WHERE price IS NOT NULL AND distance IS NOT NULL),
fit AS (SELECT regr_slope(price, distance) AS b, regr_intercept(price, distance) AS a FROM fl WHERE is_train),
pr AS (SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END AS split, price, a + b * distance AS prediction
       FROM fl, fit),
regm AS (SELECT split, count(price) AS n,
                {s6('sqrt(sum((price - prediction) * (price - prediction)) / count(price))')} AS rmse,
                {s6('avg(abs(price - prediction))')} AS mae,
                {s9('CASE WHEN var_pop(price) * count(price) = 0 THEN CASE WHEN sum((price - prediction) * (price - prediction)) = 0 THEN 1.0 ELSE 0.0 END ELSE 1 - sum((price - prediction) * (price - prediction)) / (var_pop(price) * count(price)) END')} AS r2
         FROM pr GROUP BY split)
"""


def ols_predictions(flights):
    """Least-squares line price ~ distance fitted on the training split."""
    f = (flights.where(F.col("price").isNotNull() & F.col("distance").isNotNull())
                .withColumn("is_train", SP.split_flag("travelCode")))
    fit = f.where("is_train").agg(F.regr_slope("price", "distance").alias("b"),
                                  F.regr_intercept("price", "distance").alias("a"))
    a, b = fit.select("a").scalar(), fit.select("b").scalar()
    return f.select(F.when(F.col("is_train"), "train").otherwise("test").alias("split"), "price",
                    (a + b * F.col("distance")).alias("prediction"))


def regression_report(flights):
    m = EV.regression_metrics(ols_predictions(flights), "price", "prediction", ["split"])
    return _metric_cols(_metric_cols(m, ["rmse", "mae"], 6), ["r2"])


@query("regression_metrics", f", {OLS_SQL.strip()}\nSELECT * FROM regm")
def q_regression_metrics(spark, sf):
    _, f, _ = tables(spark, sf)
    return regression_report(f)


RULE_SQL = f"""
, {FA_SQL.strip()},
{STRAT_SQL.strip()},
cls AS (SELECT u.code, u.gender AS label,
               CASE WHEN coalesce(fa.first_class_count, 0) * 3 >= coalesce(fa.flight_count, 0)
                    THEN 'male' ELSE 'female' END AS prediction,
               CASE WHEN s.is_train THEN 'train' ELSE 'test' END AS split
        FROM users u LEFT JOIN fa ON u.code = fa."userCode" JOIN strat s ON u.code = s.code),
pc AS (SELECT split, label AS actual, prediction AS predicted, count(*) AS cnt FROM cls GROUP BY 1, 2, 3),
ca AS (SELECT split, actual AS class, sum(cnt) AS support,
              coalesce(sum(CASE WHEN actual = predicted THEN cnt END), 0) AS tp FROM pc GROUP BY 1, 2),
cb AS (SELECT split, predicted AS class, sum(cnt) AS npred FROM pc GROUP BY 1, 2),
pcl AS (SELECT coalesce(ca.split, cb.split) AS split, coalesce(ca.class, cb.class) AS class,
               coalesce(ca.support, 0) AS support, coalesce(ca.tp, 0) AS tp, coalesce(cb.npred, 0) AS npred
        FROM ca FULL OUTER JOIN cb ON ca.split = cb.split AND ca.class = cb.class),
pcm AS (SELECT split, class, CAST(support AS BIGINT) AS support,
               CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS precision,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pcl),
pcf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                       ELSE 0.0 END AS f1 FROM pcm)
"""


def rule_predictions(spark, sf):
    """Fixed rule: 'male' when at least a third of the user's flights are
    first class (used to check the metric plans against SQL)."""
    u, f, h = tables(spark, sf)
    uf = FT.user_features(u, f, h)
    st = SP.stratified_flag(u.select("code", "gender"), "code", "gender").select("code", "is_train")
    pred = F.when(F.col("first_class_count") * 3 >= F.col("flight_count"), "male").otherwise("female")
    return uf.join(st, "code").select("code", F.col("gender").alias("label"), pred.alias("prediction"),
                                      F.when(F.col("is_train"), "train").otherwise("test").alias("split"))


@query("classification_metrics", RULE_SQL + f"""
, wavg AS (SELECT split, {s9('sum(precision * support) / sum(support)')} AS precision,
                 {s9('sum(recall * support) / sum(support)')} AS recall,
                 {s9('sum(f1 * support) / sum(support)')} AS f1 FROM pcf GROUP BY split),
acc AS (SELECT split, count(*) AS n, {s9('count(*) FILTER (WHERE label = prediction) / count(*)')} AS accuracy
        FROM cls GROUP BY split)
SELECT acc.split, n, accuracy, precision, recall, f1 FROM acc JOIN wavg ON acc.split = wavg.split
""")
def q_classification_metrics(spark, sf):
    m = EV.classification_metrics(rule_predictions(spark, sf), "label", "prediction", ["split"])
    return _metric_cols(m, ["accuracy", "precision", "recall", "f1"])


@query("classification_report", RULE_SQL + f"""
, t AS (SELECT * FROM pcf WHERE split = 'test')
SELECT class, {s9('precision')} AS precision, {s9('recall')} AS recall, {s9('f1')} AS f1, support FROM t
UNION ALL
SELECT 'accuracy', NULL, NULL, {s9('count(*) FILTER (WHERE label = prediction) / count(*)')}, count(*)
FROM cls WHERE split = 'test'
UNION ALL
SELECT 'macro avg', {s9('avg(precision)')}, {s9('avg(recall)')}, {s9('avg(f1)')}, CAST(sum(support) AS BIGINT) FROM t
UNION ALL
SELECT 'weighted avg', {s9('sum(precision * support) / sum(support)')}, {s9('sum(recall * support) / sum(support)')},
       {s9('sum(f1 * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM t
""")
def q_classification_report(spark, sf):
    p = rule_predictions(spark, sf).where(F.col("split") == "test")
    return _metric_cols(EV.classification_report(p), ["precision", "recall", "f1"])


@query("confusion_matrix", RULE_SQL + """
, labs AS (SELECT * FROM (VALUES ('female'), ('male')) v(actual))
SELECT l.actual,
       CAST(coalesce(sum(CASE WHEN c.prediction = 'female' THEN 1 END), 0) AS BIGINT) AS female,
       CAST(coalesce(sum(CASE WHEN c.prediction = 'male' THEN 1 END), 0) AS BIGINT) AS male
FROM labs l LEFT JOIN (SELECT * FROM cls WHERE split = 'test') c ON l.actual = c.label GROUP BY l.actual
""")
def q_confusion_matrix(spark, sf):
    p = rule_predictions(spark, sf).where(F.col("split") == "test")
    return EV.confusion_matrix(p, ["female", "male"])


# --------------------------------------------------------------- runs table

SEG_SQL = f"""
sfl AS (SELECT *, {SPLIT_SQL} AS is_train FROM flights WHERE price IS NOT NULL AND distance IS NOT NULL),
sfit AS (SELECT agency, "flightType", regr_slope(price, distance) AS b, regr_intercept(price, distance) AS a
         FROM sfl WHERE is_train GROUP BY 1, 2),
spr AS (SELECT f.agency, f."flightType", CASE WHEN is_train THEN 'train' ELSE 'test' END AS split, price,
               coalesce(a, 0) + coalesce(b, 0) * distance AS prediction
        FROM sfl f JOIN sfit s ON f.agency = s.agency AND f."flightType" = s."flightType"),
sm AS (SELECT agency, "flightType", split,
              sqrt(sum((price - prediction) * (price - prediction)) / count(price)) AS rmse,
              avg(abs(price - prediction)) AS mae,
              CASE WHEN var_pop(price) * count(price) = 0 THEN CASE WHEN sum((price - prediction) * (price - prediction)) = 0 THEN 1.0 ELSE 0.0 END
                   ELSE 1 - sum((price - prediction) * (price - prediction)) / (var_pop(price) * count(price)) END AS r2
       FROM spr GROUP BY 1, 2, 3),
runs AS (
  SELECT 'segment_baseline:' || agency || ':' || "flightType" AS run_id, 'segment_baseline' AS experiment,
         'ols_' || "flightType" AS model_type, split || '_' || m.metric AS metric, {s6('m.value')} AS value
  FROM sm, LATERAL (VALUES ('rmse', rmse), ('mae', mae), ('r2', r2)) m(metric, value))
"""


def segment_runs(spark, sf):
    _, f, _ = tables(spark, sf)
    return RN.segment_baseline_runs(f).withColumn("value", stable("value", 6))


@query("segment_runs", f", {SEG_SQL.strip()}\nSELECT * FROM runs")
def q_segment_runs(spark, sf):
    return segment_runs(spark, sf)


@query("compare_runs", f"""
, {SEG_SQL.strip()}
SELECT * FROM (
  SELECT run_id, model_type, max(CASE WHEN metric = 'test_r2' THEN value END) AS test_r2,
         max(CASE WHEN metric = 'test_rmse' THEN value END) AS test_rmse,
         max(CASE WHEN metric = 'test_mae' THEN value END) AS test_mae
  FROM runs GROUP BY 1, 2)
WHERE test_r2 IS NOT NULL AND test_rmse IS NOT NULL AND test_mae IS NOT NULL
""")
def q_compare_runs(spark, sf):
    return RN.compare_runs(segment_runs(spark, sf))


@query("best_run", f"""
, {SEG_SQL.strip()}
SELECT run_id, value AS test_r2, coalesce(model_type, 'unknown') AS model_type FROM runs
WHERE metric = 'test_r2' ORDER BY value DESC, run_id ASC LIMIT 1
""")
def q_best_run(spark, sf):
    return RN.best_run(segment_runs(spark, sf))


@query("list_experiments", f", {SEG_SQL.strip()}\nSELECT DISTINCT experiment FROM runs")
def q_list_experiments(spark, sf):
    return RN.list_experiments(segment_runs(spark, sf))


@query("pipeline_report", f"""
, {OLS_SQL.strip()}
{RULE_SQL.replace(', fa AS', ',fa AS', 1)},
acc AS (SELECT count(*) FILTER (WHERE label = prediction) / count(*) AS accuracy FROM cls WHERE split = 'test'),
wf1 AS (SELECT sum(f1 * support) / sum(support) AS f1 FROM pcf WHERE split = 'test')
SELECT 'data' AS section, 'users' AS metric, CAST((SELECT count(*) FROM users) AS DOUBLE) AS value
UNION ALL SELECT 'data', 'flights', CAST((SELECT count(*) FROM flights) AS DOUBLE)
UNION ALL SELECT 'data', 'hotels', CAST((SELECT count(*) FROM hotels) AS DOUBLE)
UNION ALL SELECT 'flight_price_model', 'rmse', rmse FROM regm WHERE split = 'test'
UNION ALL SELECT 'flight_price_model', 'r2', r2 FROM regm WHERE split = 'test'
UNION ALL SELECT 'gender_classifier', 'accuracy', {s9('accuracy')} FROM acc
UNION ALL SELECT 'gender_classifier', 'f1', {s9('f1')} FROM wf1
""")
def q_pipeline_report(spark, sf):
    from .jobs import pipeline_report
    u, f, h = tables(spark, sf)
    reg = regression_report(f)
    cls = EV.classification_metrics(rule_predictions(spark, sf), "label", "prediction", ["split"])
    return pipeline_report(u, f, h, reg.where(F.col("split") == "test"),
                           _metric_cols(cls.where(F.col("split") == "test"), ["accuracy", "f1"]))


# ------------------------------------------- linear models, independently in SQL

def solve_sql(name: str, start: str, k: int) -> str:
    """CTEs that solve k normal equations per group by Gauss-Jordan elimination:
    ``start`` gives (grp, m), m a list of k rows of k + 1 numbers; ``name`` has (grp, w)."""
    return f"""
{name}_gj AS (
  SELECT grp, 0 AS step, m FROM ({start})
  UNION ALL
  SELECT grp, step + 1, list_transform(range(1, {k + 1}), lambda i: CASE WHEN i = step + 1
           THEN list_transform(m[i], lambda v: v / m[step + 1][step + 1])
           ELSE list_transform(range(1, {k + 2}), lambda j: m[i][j] - m[i][step + 1] * m[step + 1][j] / m[step + 1][step + 1]) END)
  FROM {name}_gj WHERE step < {k}),
{name} AS (SELECT grp, list_transform(m, lambda r: r[{k + 1}]) AS w FROM {name}_gj WHERE step = {k})"""


def scaled_rows_sql(features: list[str]) -> str:
    """CTEs: ``ml`` (features as list x, y, is_train), ``sc`` (means, deviations), ``z`` (scaled)."""
    names = ", ".join(f'CAST("{c}" AS DOUBLE)' for c in features)
    k = len(features)
    return f"""
{FEATURE_DICTS.strip()},
ff AS ({FLIGHT_FEATURE_SQL.strip()}),
ml AS (SELECT "travelCode", [{names}] AS x, price AS y, {SPLIT_SQL} AS is_train,
              row_number() OVER (PARTITION BY {SPLIT_SQL} ORDER BY "travelCode", {', '.join(f'"{c}"' for c in features)}, price) - 1 AS place
       FROM ff WHERE price IS NOT NULL),
sc AS (SELECT list(m ORDER BY i) AS m, list(CASE WHEN s = 0 THEN 1 ELSE s END ORDER BY i) AS s
       FROM (SELECT i, avg(x[i]) AS m, stddev_pop(x[i]) AS s FROM ml, range(1, {k + 1}) r(i) WHERE is_train GROUP BY i)),
z AS (SELECT "travelCode", is_train, place, y, list_transform(range(1, {k + 1}), lambda i: (x[i] - m[i]) / s[i]) AS x FROM ml, sc)"""


def system_sql(kind: str, train: str, k: int, extra: str = "") -> str:
    """The normal equations (grp, m) of the rows ``train`` (grp, x, y); ``extra`` is taken off the right side."""
    ridge = " + CASE WHEN i = j THEN 1.0 ELSE 0.0 END" if kind == "ridge" else ""
    return f"""
  SELECT grp, list(row_ ORDER BY i) AS m FROM (
    SELECT grp, i, list_append(list(g{ridge} ORDER BY j), any_value(c){extra}) AS row_ FROM (
      SELECT t.grp, i, j, sum((x[i] - xm[i]) * (x[j] - xm[j])) AS g, sum((x[i] - xm[i]) * (y - ym)) AS c, count(*) AS n
      FROM {train} t JOIN {train}_mean USING (grp), range(1, {k + 1}) a(i), range(1, {k + 1}) b(j) GROUP BY t.grp, i, j) q
    GROUP BY grp, i) q2 GROUP BY grp"""


def mean_sql(train: str, k: int) -> str:
    return f"""
{train}_mean AS (SELECT grp, list(m ORDER BY i) AS xm, any_value(ym) AS ym, any_value(n) AS n FROM (
  SELECT grp, i, avg(x[i]) AS m, avg(y) AS ym, count(*) AS n FROM {train}, range(1, {k + 1}) a(i) GROUP BY grp, i) GROUP BY grp)"""


def weights_sql(kind: str, train: str, k: int, out: str = "wt") -> str:
    """Weights (grp, w) of one kind. The lasso's come from the signs of least squares:
    where all weights keep their signs they satisfy its optimality conditions."""
    if kind != "lasso":
        return f"{mean_sql(train, k)},{solve_sql(out, system_sql(kind, train, k), k)}"
    signed = f""" - 0.1 * any_value(q.n) * any_value(sign(ols.w[i])) """
    system = system_sql(kind, train, k, signed).replace(") q\n", ") q JOIN ols USING (grp)\n")
    return f"{mean_sql(train, k)},{solve_sql('ols', system_sql('linear', train, k), k)},{solve_sql(out, system, k)}"


def r2_sql(y: str, p: str) -> str:
    return f"1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count({y}))"


def linear_sql(kind: str) -> str:
    k = len(MF.FLIGHT_FEATURES)
    return f""", {scaled_rows_sql(MF.FLIGHT_FEATURES)},
tr AS (SELECT 0 AS grp, x, y FROM z WHERE is_train),
{weights_sql(kind, "tr", k).strip()},
pr AS (SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END AS split, y,
              ym + list_dot_product(list_transform(range(1, {k + 1}), lambda i: x[i] - xm[i]), w) AS p FROM z, wt, tr_mean)
SELECT '{kind}' AS model_type, split, count(y) AS n, {s6('sqrt(avg((y - p) * (y - p)))')} AS rmse, {s6('avg(abs(y - p))')} AS mae,
       {s9(r2_sql('y', 'p'))} AS r2 FROM pr GROUP BY split"""


def fold_sql(folds: int = 5) -> str:
    k = len(MF.FLIGHT_FEATURES_8)
    parts = []
    for kind in ("ridge", "lasso"):
        w = weights_sql(kind, "fr", k, f"wt_{kind}")
        parts.append(w.replace("ols", f"ols_{kind}") if kind == "lasso" else w)
    lasso = parts[1][len(mean_sql("fr", k)) + 1:]
    scores = " UNION ALL ".join(
        f"""SELECT '{kind}' AS model_type, z.fold, {r2_sql('y', f'(ym + list_dot_product(list_transform(range(1, {k + 1}), lambda i: x[i] - xm[i]), w))')} AS r2
FROM zf z JOIN wt_{kind} t ON z.fold = t.grp JOIN fr_mean f ON z.fold = f.grp GROUP BY z.fold""" for kind in ("ridge", "lasso"))
    return f""", {scaled_rows_sql(MF.FLIGHT_FEATURES_8)},
nt AS (SELECT count(*) AS n FROM z WHERE is_train),
zf AS (SELECT x, y, CASE WHEN place < (n % {folds}) * (n // {folds} + 1) THEN place // (n // {folds} + 1)
                         ELSE n % {folds} + (place - (n % {folds}) * (n // {folds} + 1)) // (n // {folds}) END AS fold
       FROM z, nt WHERE is_train),
fr AS (SELECT g.grp, x, y FROM zf, range({folds}) g(grp) WHERE fold <> g.grp),
{parts[0].strip()},
{lasso.strip()},
scores AS ({scores})
SELECT model_type, 'fold_' || fold AS fold, {s9('r2')} AS r2 FROM scores
UNION ALL SELECT model_type, 'mean', {s9('avg(r2)')} FROM scores GROUP BY model_type
UNION ALL SELECT model_type, 'std', {s9('stddev_pop(r2)')} FROM scores GROUP BY model_type"""


# ------------------------------------------------------------ model fits

def _flight_splits(spark, sf, features=None):
    """(train, test) of the model table, written once: the fits and the evaluation read it."""
    _, f, _ = tables(spark, sf)
    ff = MF.flight_features(f, keep=["travelCode"]).withColumn("is_train", SP.split_flag("travelCode"))
    ff = written(ff, "flight-model")
    return ff.where("is_train"), ff.where(~F.col("is_train"))


def _price_query(model_type):
    def run(spark, sf):
        tr, te = _flight_splits(spark, sf)
        m = T.train_price_model(tr, MF.FLIGHT_FEATURES, model_type)
        got = T.evaluate_regressor(m, tr, te, model_type=model_type)
        return _metric_cols(_metric_cols(got, ["rmse", "mae"], 6), ["r2"])
    return run


for _key, _mt in [("price_rf", "random_forest"), ("price_gbt", "gradient_boosting")]:
    query(_key)(_price_query(_mt))
for _mt in ("linear", "ridge", "lasso"):
    query(f"price_{_mt}", linear_sql(_mt), recursive=True)(_price_query(_mt))


def _user_splits(spark, sf):
    u, f, h = tables(spark, sf)
    uf = MF.user_model_table(FT.user_features(u, f, h))
    st = written(SP.stratified_flag(uf, "code", "gender"), "user-model")
    return st.where("is_train"), st.where(~F.col("is_train"))


def _gender_query(model_type):
    def run(spark, sf):
        tr, te = _user_splits(spark, sf)
        m = T.train_classifier(tr, MF.USER_FEATURES, model_type)
        return T.evaluate_classifier(m, tr, te, model_type=model_type)
    return run


for _key, _mt in [("gender_logistic", "logistic"), ("gender_rf", "random_forest"),
                  ("gender_gbt", "gradient_boosting"), ("gender_svm", "svm")]:
    query(_key)(_gender_query(_mt))


@query("predict_price")
def q_predict_price(spark, sf):
    """Batch scoring of price requests with the default (random forest) model."""
    _, f, _ = tables(spark, sf)
    dicts = MF.flight_dictionaries(f)
    ff = MF.flight_features(f, dicts, keep=["travelCode"]).withColumn("is_train", SP.split_flag("travelCode"))
    model = T.train_price_model(ff.where("is_train"), MF.FLIGHT_FEATURES)
    v = R.request_validate(A.price_requests(f))
    ok = R.request_defaults(R.accepted(v))
    feats = MF.flight_features(ok, dicts, keep=["request_id"])
    scored = model.transform(feats).select("request_id", F.round("prediction", 2).alias("predicted_price"),
                                           F.lit("USD").alias("currency"))
    rej = R.rejected(v).select("request_id", F.lit(None).cast("double").alias("predicted_price"),
                               F.lit(None).cast("string").alias("currency"), "error")
    return scored.withColumn("error", F.lit(None).cast("string")).unionByName(rej)


@query("predict_gender")
def q_predict_gender(spark, sf):
    """Batch scoring of the classification requests (one per user, some
    features missing or under legacy names, some companies unseen) with the
    default (random forest) classifier: label, confidence (max probability)
    and the class -> probability map."""
    from ..operators import encoding as E
    u, f, h = tables(spark, sf)
    ufe = FT.user_features(u, f, h)
    gdict, cdict = E.build_dictionary(u, "gender"), E.build_dictionary(u, "company")
    uf = MF.user_model_table(ufe, company_dict=cdict, gender_dict=gdict)
    st = SP.stratified_flag(uf, "code", "gender")
    model = T.train_classifier(st.where("is_train"), MF.USER_FEATURES)
    scored = model.transform(MF.request_features(A.gender_requests(ufe), cdict))
    scored = E.decode(scored, "prediction", gdict, "predicted_gender")
    classes = [r["value"] for r in gdict.orderBy("code").collect()]  # the label dictionary (2 rows)
    return T.probabilities(scored, classes).select("request_id", "predicted_gender", "confidence", "probabilities")


@query("feature_importance")
def q_feature_importance(spark, sf):
    """Importances of the price forest (all features) and of the classifier forest (the ten greatest)."""
    tr, _ = _flight_splits(spark, sf)
    m = T.train_price_model(tr, MF.FLIGHT_FEATURES, "random_forest")
    price = T.feature_importance(m, MF.FLIGHT_FEATURES).select(F.lit("flight_price").alias("model"), "*")
    ut, _ = _user_splits(spark, sf)
    g = T.train_classifier(ut, MF.USER_FEATURES, "random_forest")
    return price.unionByName(T.feature_importance(g, MF.USER_FEATURES, top=10).select(F.lit("gender").alias("model"), "*"))


CV_ORDER = ["travelCode", *MF.FLIGHT_FEATURES_8, "price"]


@query("cross_validate")
def q_cross_validate(spark, sf):
    """All four tracked models."""
    tr, _ = _flight_splits(spark, sf)
    return RN.cross_validate(tr, MF.FLIGHT_FEATURES_8, RN.TRACKED_MODELS, CV_ORDER, 5)


@query("cross_validate_linear", fold_sql(), recursive=True)
def q_cross_validate_linear(spark, sf):
    """The linear ones alone: one scan for all fits."""
    tr, _ = _flight_splits(spark, sf)
    got = RN.cross_validate(tr, MF.FLIGHT_FEATURES_8, ["ridge", "lasso"], CV_ORDER, 5)
    return got.select("model_type", "fold", stable("r2", 9).alias("r2"))


def _parallel(fns):
    with ThreadPoolExecutor(max_workers=len(fns)) as ex:
        return list(ex.map(lambda fn: fn(), fns))


@query("compare_regressors")
def q_compare_regressors(spark, sf):
    tr, te = _flight_splits(spark, sf)

    def fit(mt):
        return lambda: RN._materialise(T.evaluate_regressor(
            T.train_price_model(tr, MF.FLIGHT_FEATURES, mt), tr, te, model_type=mt).where("split = 'test'"))
    parts = _parallel([fit(mt) for mt in ["linear", "ridge", "random_forest", "gradient_boosting"]])
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("compare_classifiers")
def q_compare_classifiers(spark, sf):
    tr, te = _user_splits(spark, sf)

    def fit(mt):
        return lambda: RN._materialise(T.evaluate_classifier(
            T.train_classifier(tr, MF.USER_FEATURES, mt), tr, te, model_type=mt).where("split = 'test'"))
    parts = _parallel([fit(mt) for mt in ["logistic", "random_forest", "gradient_boosting"]])
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("tracked_training")
def q_tracked_training(spark, sf):
    _, f, _ = tables(spark, sf)
    path = os.path.join(sinks.scratch_dir(spark), f"runs-{uuid.uuid4().hex}")
    RN.tracked_training(f, runs_path=path)
    wanted = ["test_r2", "test_rmse", "test_mae", "train_r2", "cv_r2_mean", "cv_r2_std", "is_best"]
    runs = RN.read_runs(spark, path)
    params = (runs.where(F.startswith("metric", F.lit("param_"))).groupBy("run_id")
                  .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.substr("metric", F.lit(7)), "value")))).alias("params")))
    wide = runs.groupBy("run_id", "model_type").pivot("metric", wanted).agg(F.first("value"))
    return wide.join(params, "run_id", "left")


def stored_differences(table: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row: ``rows`` of the loaded table, and ``differences``, the rows (as often as they
    occur) that only one of the two has. Both are added up by row in one pass."""
    both = (table.withColumns({"_n": F.lit(1).cast("long"), "_loaded": F.lit(0).cast("long")})
            .unionByName(loaded.select("*", F.lit(-1).cast("long").alias("_n"), F.lit(1).cast("long").alias("_loaded"))))
    each = both.groupBy(*table.columns).agg(F.sum("_n").alias("_n"), F.sum("_loaded").alias("_loaded"))
    return each.agg(F.coalesce(F.sum("_loaded"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.abs("_n")), F.lit(0)).alias("differences"))


@query("model_store", f"""
, {STRAT_SQL.strip()}
SELECT 'flight_price' AS model, count(*) AS "rows", CAST(0 AS BIGINT) AS differences FROM flights WHERE NOT ({SPLIT_SQL})
UNION ALL SELECT 'gender', count(*), 0 FROM strat WHERE NOT is_train
UNION ALL SELECT 'recommender_hotel_features', count(DISTINCT "name" || '_' || place), 0 FROM hotels
UNION ALL SELECT 'recommender_places', count(DISTINCT place), 0 FROM hotels WHERE "name" || '_' || place IS NOT NULL
UNION ALL SELECT 'recommender_user_item', count(DISTINCT ("userCode", "name", place)), 0 FROM hotels
  WHERE "userCode" IS NOT NULL AND "name" || '_' || place IS NOT NULL AND total IS NOT NULL
""")
def q_model_store(spark, sf):
    """Save and load the three models, and compare what they give: the price
    model and the classifier on their test rows, the recommender's tables row by row."""
    folder = f"{sinks.scratch_dir(spark)}/models-{uuid.uuid4().hex}"
    parts = []
    tr, te = _flight_splits(spark, sf)
    ut, ue = _user_splits(spark, sf)
    for name, model, rows in (("flight_price", T.train_price_model(tr, MF.FLIGHT_FEATURES, "ridge"), te),
                              ("gender", T.train_classifier(ut, MF.USER_FEATURES, "logistic"), ue)):
        sinks.save_model(model, f"{folder}/{name}")
        before = model.transform(rows).select(*rows.columns, F.col("prediction").alias("_before"))
        after = sinks.load_model(f"{folder}/{name}").transform(before)
        parts.append(after.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("rows"),
                               F.count_if(~F.col("_before").eqNullSafe(F.col("prediction"))).alias("differences")))
    _, _, h = tables(spark, sf)
    feats, _, places = RC.hotel_features(h)
    for name, table in (("hotel_features", feats), ("places", places), ("user_item", RC.user_item(h))):
        sinks.save_table(table, f"{folder}/{name}")
        loaded = spark.read.schema(table.schema).parquet(f"{folder}/{name}")
        parts.append(stored_differences(table, loaded).select(F.lit(f"recommender_{name}").alias("model"), "rows", "differences"))
    return reduce(DataFrame.unionByName, parts)
