"""Streaming batch scoring of price requests.

    requests (files) -> validate -> defaults -> encode (stream-static joins)
                     -> PipelineModel.transform -> parquet sink

The checkpoint (offsets + commit log) lives under the session's
``spark.checkpoint.dir`` unless given, so a restarted or retried query
resumes exactly where it stopped and the file sink stays exactly-once.
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..ml import features as MF
from ..operators import requests as R
from ..session import shared_folder

PRICE_REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("from", T.StringType()),
    T.StructField("to", T.StringType()),
    T.StructField("flightType", T.StringType()),
    T.StructField("agency", T.StringType()),
    T.StructField("time", T.DoubleType()),
    T.StructField("distance", T.LongType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("is_weekend", T.IntegerType()),
])


def score_requests(requests: DataFrame, model: PipelineModel, dictionaries: dict[str, DataFrame]) -> DataFrame:
    """Works on batch and streaming request tables alike."""
    v = R.request_validate(requests)
    ok = R.request_defaults(R.accepted(v))
    feats = MF.flight_features(ok, dictionaries, keep=["request_id"])
    scored = model.transform(feats).select(
        "request_id", F.round("prediction", 2).alias("predicted_price"), F.lit("USD").alias("currency"),
        F.lit(None).cast("string").alias("error"))
    rej = R.rejected(v).select("request_id", F.lit(None).cast("double").alias("predicted_price"),
                               F.lit(None).cast("string").alias("currency"), "error")
    return scored.unionByName(rej)


def start_price_scoring(spark: SparkSession, source_dir: str, sink_dir: str, model: PipelineModel,
                        dictionaries: dict[str, DataFrame], checkpoint: str | None = None,
                        available_now: bool = True, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None):
    """Start the streaming query; returns the ``StreamingQuery``."""
    checkpoint = checkpoint or os.path.join(shared_folder(spark), "streams", "price_scoring")
    reader = spark.readStream.schema(PRICE_REQUEST_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = score_requests(reader.load(source_dir), model, dictionaries)
    w = (out.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(sink_dir)
