"""Training, scoring and comparison of the price and classification models.

* Linear price models come from sums of products (``gram``) and are a
  ``PipelineModel`` of two projections.
* Forests (``forest``) and boosting (``boosting``) are ``TreeModel``s: a table of
  nodes, in the original sizes (100 trees; depth 15 / 10 / 5).
* Logistic regression is ``pyspark.ml``'s, with regParam 1 / (C n) for the
  original penalty C.
* The RBF-kernel SVM (``svm``) is solved in its dual over landmark features, to a
  certified duality gap.

All are saved and loaded by ``sources.sinks`` and score a table by ``transform``.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder
from . import gram
from .boosting import fit_boosting
from .evaluate import classification_metrics, regression_metrics
from .forest import fit_forests
from .gram import LASSO_ALPHA, RIDGE_ALPHA
from .rows import model_rows
from .scale import fit_scaler
from .svm import SvmModel, fit_svm
from .trees import TreeModel

SEED = 42
REGRESSORS = ["linear", "ridge", "lasso", "random_forest", "gradient_boosting"]
LINEAR = ["linear", "ridge", "lasso"]
CLASSIFIERS = ["logistic", "random_forest", "gradient_boosting", "svm"]
LOGISTIC_C = 1.0
RATE = 0.1


def scaler_stage(train: DataFrame, cols: list[str], suffix: str = "_scaled") -> SQLTransformer:
    """Fit the population-std scaler and freeze it into a SQL stage (one
    aggregate row is collected: 2 numbers per feature)."""
    row = fit_scaler(train, cols).first()
    parts = []
    for c in cols:
        m, s = float(row[f"mean_{c}"] or 0.0), float(row[f"std_{c}"] or 1.0)
        parts.append(f"(CAST(`{c}` AS DOUBLE) - CAST('{m!r}' AS DOUBLE)) / CAST('{s!r}' AS DOUBLE)"
                     f" AS `{c}{suffix}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def model_parameters(model_type: str, num_trees: int = 100, max_depth: int | None = None, **_) -> dict[str, float]:
    """The parameters of a tracked model, as they are logged with its run."""
    return {"ridge": {"alpha": RIDGE_ALPHA}, "lasso": {"alpha": LASSO_ALPHA}, "linear": {},
            "gradient_boosting": {"n_estimators": num_trees, "max_depth": max_depth or 5, "learning_rate": RATE}}.get(
        model_type, {"n_estimators": num_trees, "max_depth": max_depth or 15})


def tree_fits(rows: DataFrame, features: list[str], model_type: str, fits: list[int], num_trees: int = 100,
              max_depth: int | None = None, classes: int = 0, **sizes) -> dict[int, TreeModel]:
    """Forests or boosted trees over ``model_rows``, one per fit (-1: all training
    rows; k: without fold k). Unknown names give a forest, as the default."""
    if model_type == "gradient_boosting":
        if classes > 2:
            raise ValueError("boosting takes a number or two classes")
        return fit_boosting(rows, features, fits, num_trees, max_depth or 5, RATE, logistic=classes == 2, **sizes)
    mtry = max(1, math.isqrt(len(features))) if classes else None
    return fit_forests(rows, features, fits, num_trees, max_depth or (10 if classes else 15), classes, mtry, SEED, **sizes)


def train_price_model(train: DataFrame, features: list[str], model_type: str = "random_forest",
                      label: str = "price", num_trees: int = 100, max_depth: int | None = None, **sizes) -> PipelineModel | TreeModel:
    if model_type in LINEAR:
        sums = gram.fold_sums(train, features, label)
        return gram.fit(model_type, features, sums.get(None, gram.none(len(features)))).pipeline()
    return tree_fits(model_rows(train, features, label), features, model_type, [-1], num_trees, max_depth, **sizes)[-1]


def train_classifier(train: DataFrame, features: list[str], model_type: str = "random_forest",
                     label: str = "label", num_trees: int = 100, max_depth: int | None = None,
                     gamma: float | None = None, **sizes) -> PipelineModel | TreeModel | SvmModel:
    """``label`` holds class codes 0, 1, ... ``gamma`` of the SVM's kernel: by default
    1 / features (the 'scale' rule on inputs of unit variance)."""
    if model_type == "logistic":
        n = train.where(F.col(label).isNotNull()).count()
        est = LogisticRegression(featuresCol="features", labelCol=label, predictionCol="prediction", maxIter=1000,
                                 regParam=1.0 / (LOGISTIC_C * max(n, 1)), elasticNetParam=0.0, standardization=False,
                                 probabilityCol="probability")
        asm = VectorAssembler(inputCols=[f"{c}_scaled" for c in features], outputCol="features", handleInvalid="keep")
        # The fitted stage holds its training summary and so the session, which cannot be
        # shipped to tasks once a query in it was observed; the saved one does not.
        path = f"{shared_folder(train.sparkSession)}/logistic-{uuid.uuid4().hex}"
        Pipeline(stages=[scaler_stage(train, features), asm, est]).fit(train).write().save(path)
        return PipelineModel.load(path)
    rows = model_rows(train, features, label)
    classes = max(2, int(rows.agg(F.max("y")).first()[0] or 0) + 1)
    if model_type == "svm":
        if classes > 2:
            raise ValueError("the SVM takes two classes")
        scaler = fit_scaler(train.where(F.col(f"`{label}`").isNotNull()), features).first()
        mean, std = (np.array([float(scaler[f"{k}_{c}"] or d) for c in features]) for k, d in (("mean", 0.0), ("std", 1.0)))
        return fit_svm(rows, features, mean, std, gamma=gamma, **sizes)
    return tree_fits(rows, features, model_type, [-1], num_trees, max_depth, classes, **sizes)[-1]


# --------------------------------------------------------------- scoring

def score(model: PipelineModel | TreeModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def evaluate_regressor(model: PipelineModel | TreeModel, train: DataFrame, test: DataFrame, label: str = "price",
                       model_type: str = "") -> DataFrame:
    both = (model.transform(train).withColumn("split", F.lit("train"))
            .unionByName(model.transform(test).withColumn("split", F.lit("test"))))
    return regression_metrics(both, label, "prediction", ["split"]).select(
        F.lit(model_type).alias("model_type"), "*")


def evaluate_classifier(model: PipelineModel | TreeModel, train: DataFrame, test: DataFrame, label: str = "label",
                        model_type: str = "") -> DataFrame:
    cols = [F.col(label).cast("double").alias(label), F.col("prediction").cast("double")]  # both as codes
    both = (model.transform(train).select(*cols).withColumn("split", F.lit("train"))
            .unionByName(model.transform(test).select(*cols).withColumn("split", F.lit("test"))))
    return classification_metrics(both, label, "prediction", ["split"]).select(
        F.lit(model_type).alias("model_type"), "*")


def feature_importance(model: PipelineModel | TreeModel, features: list[str], top: int | None = None) -> DataFrame:
    """(feature, importance) sorted desc; empty for models without importances."""
    from pyspark.sql import SparkSession
    s = SparkSession.builder.getOrCreate()
    if not isinstance(model, TreeModel):
        return s.createDataFrame([], "feature string, importance double")
    rows = sorted(zip(features, model.importances().tolist()), key=lambda t: (-t[1], t[0]))
    return s.createDataFrame(rows[:top] if top else rows, "feature string, importance double")


def probabilities(scored: DataFrame, classes: list[str]) -> DataFrame:
    """Adds confidence = max probability and a class -> probability map."""
    arr = F.col("probability") if scored.schema["probability"].dataType.typeName() == "array" else vector_to_array("probability")
    keys = F.array(*[F.lit(c) for c in classes])
    return scored.withColumn("confidence", F.array_max(arr)) \
                 .withColumn("probabilities", F.map_from_arrays(keys, F.slice(arr, 1, len(classes))))
