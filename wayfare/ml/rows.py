"""Model rows for the tree growers: numbered, with folds, in column blocks."""

from __future__ import annotations

import sys
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def partition_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def model_rows(train: DataFrame, features: list[str], label: str, order: list[str] | None = None, folds: int = 1,
               test: DataFrame | None = None) -> DataFrame:
    """Written rows (id, fold, y, x array) of the training rows with a label: their
    place and contiguous fold in the total order of ``order`` (default: features and
    label); test rows (if any) have fold -1. Missing features are NaN."""
    from .split import contiguous_folds
    spark = train.sparkSession
    x = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in features])

    def plain(df, *more):
        return df.where(F.col(f"`{label}`").isNotNull()).select(
            x.alias("x"), F.col(f"`{label}`").cast("double").alias("y"), *more)
    keys = [F.col(f"`{c}`").alias(f"_o{k}") for k, c in enumerate(order or [*features, label])]
    names = [f"_o{k}" for k in range(len(keys))]
    rows = contiguous_folds(plain(train, *keys), names, folds, place="id").select("id", "fold", "y", "x")
    if test is not None:
        rows = rows.unionByName(plain(test).select(F.lit(-1).cast("long").alias("id"), F.lit(-1).alias("fold"), "y", "x"))
    path = f"{shared_folder(spark)}/model-rows-{uuid.uuid4().hex}"
    rows.select(F.col("id").cast("long"), F.col("fold").cast("int"), "y", "x").write.parquet(path)
    return spark.read.schema("id long, fold int, y double, x array<double>").parquet(path)


def row_batches(batches, flush: int = 100_000):
    """Blocks of rows as arrays: id, fold, y and x (features x rows, missing last)."""
    held, n = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            n += len(batch)
        if n >= flush:
            yield as_block(held)
            held, n = [], 0
    if held:
        yield as_block(held)


def as_block(batches: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
    t = pa.Table.from_batches(batches).combine_chunks()
    x = np.asarray(t["x"].combine_chunks().flatten()).reshape(len(t), -1)
    return {"id": np.asarray(t["id"]).astype(np.int64), "fold": np.asarray(t["fold"]).astype(np.int32),
            "y": np.asarray(t["y"]).astype(np.float64), "x": np.ascontiguousarray(np.where(np.isnan(x), np.inf, x).T)}


class Bins:
    """Per feature the distinct values (exact), or quantiles as upper bounds of bins."""

    def __init__(self, values: list[np.ndarray], exact: list[bool]):
        self.values, self.exact = values, exact

    @staticmethod
    def of(rows: DataFrame, features: int, max_bins: int = 1024) -> "Bins":
        """One pass for the numbers of distinct values, one for values or quantiles:
        at most ``max_bins`` numbers per feature reach the driver."""
        if not features:
            return Bins([], [])
        x = [F.when(F.isnan(F.get("x", F.lit(k))), F.lit(float("inf"))).otherwise(F.get("x", F.lit(k))) for k in range(features)]
        count = rows.agg(*[F.approx_count_distinct(c, 0.02).alias(f"c{k}") for k, c in enumerate(x)]).first()
        few = [count[k] <= 0.9 * max_bins for k in range(features)]
        steps = [(i + 1) / 256 for i in range(255)]
        got = rows.agg(*[(F.collect_set(c) if few[k] else F.percentile_approx(c, steps, 20_000)).alias(f"v{k}")
                         for k, c in enumerate(x)],
                       *[F.max(c).alias(f"m{k}") for k, c in enumerate(x)]).first()
        values = [np.unique(np.array((got[f"v{k}"] or []) + ([] if got[f"m{k}"] is None else [got[f"m{k}"]]), float))
                  for k in range(features)]
        return Bins(values, few)

    def codes(self, f: int, x: np.ndarray) -> np.ndarray:
        v = self.values[f]
        return np.minimum(np.searchsorted(v, x), max(len(v) - 1, 0)).astype(np.int64)
