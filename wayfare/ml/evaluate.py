"""Model metrics as SQL aggregates (one pass, grouped by split or model).

Regression: RMSE, MAE, R2 (R2 = 1 - SSE / (n * var_pop(y)); a constant
label gives 1 when SSE is 0 and 0 otherwise). Classification: accuracy and
per-class precision / recall / F1 with weighted and macro averages; a zero
denominator gives 0. Counts are reduced to one row per (actual, predicted)
pair first, so everything after that works on a classes x classes table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str = "price", prediction: str = "prediction",
                       by: list[str] | None = None) -> DataFrame:
    by = by or []
    y, p = F.col(label), F.col(prediction)
    e = y - p
    sse = F.sum(e * e)
    n = F.count(y)
    sst = F.var_pop(y) * n
    r2 = (F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
           .otherwise(F.lit(1.0) - sse / sst))
    g = df.where(y.isNotNull() & p.isNotNull())
    g = g.groupBy(*by) if by else g.groupBy()
    return g.agg(n.alias("n"), F.sqrt(sse / n).alias("rmse"), F.avg(F.abs(e)).alias("mae"), r2.alias("r2"))


def _pair_counts(df: DataFrame, label: str, prediction: str, by: list[str]) -> DataFrame:
    return (df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
              .groupBy(*by, F.col(label).cast("string").alias("actual"),
                       F.col(prediction).cast("string").alias("predicted"))
              .agg(F.count(F.lit(1)).alias("cnt")))


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction",
              by: list[str] | None = None) -> DataFrame:
    """(by..., class, precision, recall, f1, support)."""
    by = by or []
    pc = _pair_counts(df, label, prediction, by)
    a = pc.groupBy(*by, F.col("actual").alias("class")).agg(
        F.sum("cnt").alias("support"),
        F.coalesce(F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("cnt"))), F.lit(0)).alias("tp"))
    b = pc.groupBy(*by, F.col("predicted").alias("class")).agg(F.sum("cnt").alias("npred"))
    j = a.join(b, [*by, "class"], "full_outer").na.fill(0, ["support", "tp", "npred"])
    prec = F.when(F.col("npred") > 0, F.col("tp") / F.col("npred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    j = j.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return j.withColumn("f1", f1).select(*by, "class", "precision", "recall", "f1",
                                         F.col("support").cast("bigint").alias("support"))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                           by: list[str] | None = None) -> DataFrame:
    """accuracy + support-weighted precision / recall / F1 per group."""
    by = by or []
    pcls = per_class(df, label, prediction, by)
    w = pcls.groupBy(*by).agg(
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"))
    acc = (df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
             .groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                               (F.count_if(F.col(label).cast("string") == F.col(prediction).cast("string"))
                                / F.count(F.lit(1))).alias("accuracy")))
    return acc.join(w, by, "inner") if by else acc.crossJoin(w)


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class rows, then 'accuracy', 'macro avg' and 'weighted avg' rows."""
    pcls = per_class(df, label, prediction)
    macro = pcls.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                     F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                     F.sum("support").cast("bigint").alias("support"))
    weighted = pcls.agg(F.lit("weighted avg").alias("class"),
                        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
                        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
                        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
                        F.sum("support").cast("bigint").alias("support"))
    acc = classification_metrics(df, label, prediction).select(
        F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"), F.col("accuracy").alias("f1"),
        F.col("n").cast("bigint").alias("support"))
    return pcls.unionByName(acc).unionByName(macro).unionByName(weighted)


def confusion_matrix(df: DataFrame, labels: list[str], label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """actual x predicted counts; every label is a row and a column (0 if none)."""
    pc = _pair_counts(df, label, prediction, [])
    piv = pc.groupBy("actual").pivot("predicted", labels).agg(F.sum("cnt"))
    spark = df.sparkSession
    dim = spark.createDataFrame([(x,) for x in labels], "actual string")
    out = dim.join(piv, "actual", "left")
    return out.select("actual", *[F.coalesce(F.col(f"`{x}`"), F.lit(0)).cast("bigint").alias(x)
                                  for x in labels])
