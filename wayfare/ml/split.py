"""Reproducible train/test splits expressed as column arithmetic.

``randomSplit`` depends on partitioning and row order, so re-running a job
after an executor loss (or on another cluster size) could move rows between
splits. Here membership is a pure function of a key and a seed: the same row
is in the same split on any engine, any partitioning, any retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder

MODULUS = 1000003  # prime; keeps intermediate products far from overflow


def key_hash(key, seed: int = 42) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.pmod(k, F.lit(MODULUS)) * 7919 + seed, F.lit(MODULUS))


def split_flag(key, train_pct: int = 80, seed: int = 42) -> Column:
    """True for the training split (about ``train_pct`` % of keys)."""
    return F.pmod(key_hash(key, seed), F.lit(100)) < train_pct


def train_test_split(df: DataFrame, key: str, train_pct: int = 80, seed: int = 42):
    f = split_flag(key, train_pct, seed)
    return df.where(f), df.where(~f)


def stratified_flag(df: DataFrame, key: str, label: str, test_fraction: float = 0.2,
                    seed: int = 42) -> DataFrame:
    """Adds ``is_train``: per class, the round(test_fraction * n) rows with the
    smallest (key hash, key) form the test split.

    Exact, and no task ever sorts a whole class: the key hash takes at most
    ``MODULUS`` values, so a class is first reduced to a histogram
    (class, hash) -> rows (partial aggregation, at most MODULUS rows per
    class), a running sum over that histogram gives the rows in smaller
    buckets, and the rank inside a bucket comes from a window partitioned by
    (class, hash), whose partitions hold about n / MODULUS rows each.
    """
    h = key_hash(key, seed)
    base = df.withColumn("_h", h)
    hist = base.groupBy(label, "_h").agg(F.count(F.lit(1)).alias("_c"))
    wc = Window.partitionBy(label).orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    hist = (hist.withColumn("_before", F.coalesce(F.sum("_c").over(wc), F.lit(0)))
                .withColumn("_n", F.sum("_c").over(Window.partitionBy(label))))
    hist = hist.drop("_c").withColumnRenamed(label, "_lab").withColumnRenamed("_h", "_hh")
    # null-safe on the class so rows with a NULL label form their own stratum
    j = base.join(hist, base[label].eqNullSafe(hist["_lab"]) & (base["_h"] == hist["_hh"])).drop("_lab", "_hh")
    rank = F.col("_before") + F.row_number().over(Window.partitionBy(label, "_h").orderBy(F.col(key)))
    n_test = F.floor(F.col("_n") * test_fraction + 0.5)
    return j.withColumn("is_train", rank > n_test).drop("_h", "_before", "_n")


def contiguous_folds(df: DataFrame, order: list[str], folds: int = 5, place: str | None = None) -> DataFrame:
    """Adds ``fold`` (and under the name ``place`` the row's number): the rows in the total order of ``order``, cut into ``folds``
    runs of equal length (the first ones a row longer if need be).

    No task sorts the table: rows are range-partitioned by the order (written
    to the shared folder, so that the ranges stay what they were), numbered
    within their range, and shifted by the counts of the ranges before.
    """
    spark = df.sparkSession
    shared_folder(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()).checkpoint()
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_c"))
    # one row per range partition
    counts = counts.select(F.col("_range").alias("_r"), (F.sum("_c").over(Window.orderBy("_range")) - F.col("_c")).alias("_before"))
    n = ranged.count()
    number = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    size, longer = max(n // folds, 1), n % folds
    fold = F.when(F.col("_place") < longer * (size + 1), F.floor(F.col("_place") / (size + 1))) \
            .otherwise(longer + F.floor((F.col("_place") - longer * (size + 1)) / size))
    return (ranged.join(counts, F.col("_range") == F.col("_r")).withColumn("_place", number)
                  .withColumn("fold", fold.cast("int")).withColumn(place or "_place", F.col("_place"))
                  .drop("_range", "_r", "_before", "_place"))
