"""The daily batch pipeline: checked publication -> train -> report.

One driver program: every raw table is scanned once, checked and cleaned on its
way to the run's folder (``sources.staged``), and published if all required rules
hold. The three trainings read the published copy, so the lineage of each starts
at a file, not at the raw scans; the three models are
fitted concurrently from driver threads, and the metrics are collected into
one report table.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ml import features as MF
from ..ml import split as SP
from ..ml import train as T
from ..operators import features as FT
from ..operators import recommend as RC
from ..sources import sinks, staged


def pipeline_report(users: DataFrame, flights: DataFrame, hotels: DataFrame,
                    price_metrics: DataFrame, gender_metrics: DataFrame) -> DataFrame:
    """(section, metric, value): table sizes, price model RMSE / R2 and
    classifier accuracy / F1 (each metrics input: one row, test split)."""
    data = (users.agg(F.lit("data").alias("section"), F.lit("users").alias("metric"),
                      F.count(F.lit(1)).cast("double").alias("value"))
            .unionByName(flights.agg(F.lit("data").alias("section"), F.lit("flights").alias("metric"),
                                     F.count(F.lit(1)).cast("double").alias("value")))
            .unionByName(hotels.agg(F.lit("data").alias("section"), F.lit("hotels").alias("metric"),
                                    F.count(F.lit(1)).cast("double").alias("value"))))

    def rows(df, section, metrics):
        arr = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                        for m in metrics])
        return df.select(F.lit(section).alias("section"), F.explode(arr).alias("x")).select(
            "section", "x.metric", "x.value")

    return (data.unionByName(rows(price_metrics, "flight_price_model", ["rmse", "r2"]))
                .unionByName(rows(gender_metrics, "gender_classifier", ["accuracy", "f1"])))


def daily_pipeline(spark: SparkSession, users: DataFrame, flights: DataFrame, hotels: DataFrame,
                   out_dir: str | None = None, num_trees: int = 100) -> DataFrame:
    """Run the whole pipeline and return the report (also written as text)."""
    out_dir = out_dir or os.path.join(sinks.scratch_dir(spark), "daily")
    processed = os.path.join(out_dir, "processed")
    staged.raise_unless(*staged.publish(spark, staged.booking_sources(users, flights, hotels), processed))
    users, f, h = (staged.read_published(spark, processed, n, df.schema) for n, df in
                   (("users", users), ("flights", flights), ("hotels", hotels)))

    def price():
        ff = MF.flight_features(f, keep=["travelCode"]).withColumn("is_train", SP.split_flag("travelCode"))
        ff = ff.persist()
        try:
            tr, te = ff.where("is_train"), ff.where(~F.col("is_train"))
            m = T.train_price_model(tr, MF.FLIGHT_FEATURES_8, num_trees=num_trees)
            sinks.save_model(m, os.path.join(out_dir, "models", "flight_price"))
            return T.evaluate_regressor(m, tr, te).where("split = 'test'").collect()
        finally:
            ff.unpersist()

    def gender():
        uf = MF.user_model_table(FT.user_features_slim(users, f, h))
        st = SP.stratified_flag(uf, "code", "gender").persist()
        try:
            tr, te = st.where("is_train"), st.where(~F.col("is_train"))
            m = T.train_classifier(tr, MF.USER_FEATURES_SLIM, num_trees=num_trees)
            sinks.save_model(m, os.path.join(out_dir, "models", "gender"))
            return T.evaluate_classifier(m, tr, te).where("split = 'test'").collect()
        finally:
            st.unpersist()

    def recommender():
        feats, scaler, places = RC.hotel_features(h)
        for name, df in [("hotel_features", feats), ("scaler", scaler), ("places", places),
                         ("user_item", RC.user_item(h))]:
            sinks.save_table(df, os.path.join(out_dir, "models", "recommender", name))
        return None

    with ThreadPoolExecutor(max_workers=3) as ex:
        pm, gm, _ = [fut.result() for fut in [ex.submit(price), ex.submit(gender), ex.submit(recommender)]]
    # Without test rows a model has no metrics, and the report no rows for it.
    pm_df = spark.createDataFrame([(r["rmse"], r["r2"]) for r in pm], "rmse double, r2 double")
    gm_df = spark.createDataFrame([(r["accuracy"], r["f1"]) for r in gm], "accuracy double, f1 double")
    report = pipeline_report(users, f, h, pm_df, gm_df).collect()  # seven rows at most
    report = spark.createDataFrame(report, "section string, metric string, value double")
    sinks.write_report(report, os.path.join(out_dir, "report"))
    return report
