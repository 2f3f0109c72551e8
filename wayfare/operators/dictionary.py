"""Order-preserving dictionaries of columns with any number of distinct values.

The distinct (column, value) pairs of all columns come from one pass, are
range-partitioned and written, and numbered by the counts of the ranges before:
code = place of the value among the column's sorted values. No task sees a whole
column's values.

Encoding joins the facts with the dictionary by value. Values with a large share of
the rows (their counts are in the dictionary; at most ``HOT`` per column, whatever
the table) are applied by a broadcast first; their rows keep no key for the other
join, which a salt spreads, so that no value or null makes a large partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Most hot values of a column: those with over one HOT-th of its rows.
HOT = 1000


def distributed_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, value, code, n): the sorted distinct non-null values of each column
    as strings (code point order), numbered from 0, with their rows."""
    each = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    pairs = df.select(F.explode(each).alias("p")).select("p.field", "p.value").where("value IS NOT NULL")
    counts = pairs.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(counts.repartitionByRange(parts, "field", "value").withColumn("_p", F.spark_partition_id()), "dictionary")
    # One row per column and range.
    sizes = ranged.groupBy("field", "_p").agg(F.count(F.lit(1)).alias("_c"))
    before = sizes.select("field", "_p", (F.sum("_c").over(Window.partitionBy("field").orderBy("_p")) - F.col("_c")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("field", "_p").orderBy("value")) - 1
    return ranged.join(before, ["field", "_p"]).select("field", "value", (F.col("_before") + place).cast("long").alias("code"), "n")


def hot_values(one: DataFrame) -> DataFrame:
    """Of a column's dictionary the values with over one HOT-th of its rows: fewer than HOT."""
    total = one.agg(F.sum("n").alias("t"))
    return one.join(F.broadcast(total), F.col("n") * HOT > F.col("t")).drop("t")


def _looked_up(df: DataFrame, key, one: DataFrame, by: str, get: str, out: str) -> DataFrame:
    """``df`` with ``out``: the ``get`` of the dictionary row whose ``by`` is ``key`` (or null)."""
    hot = F.broadcast(hot_values(one).select(F.col(by).alias("_hk"), F.col(get).alias("_hv"), F.lit(True).alias("_hit")))
    cold = one.select(F.lit(0).cast("long").alias("_ds"), F.col(by).alias("_dk"), F.col(get).alias("_dv"))
    j = df.withColumn("_key", key).join(hot, F.col("_key") == F.col("_hk"), "left")
    settled = F.col("_hit").isNotNull() | F.col("_key").isNull()
    j = j.withColumn("_salt", F.when(settled, F.monotonically_increasing_id() + 1).otherwise(F.lit(0).cast("long")))
    j = j.withColumn("_key", F.when(~settled, F.col("_key")))
    # A salted row meets no dictionary row; the salt only spreads it.
    j = j.join(cold, (F.col("_salt") == F.col("_ds")) & (F.col("_key") == F.col("_dk")), "left")
    return j.withColumn(out, F.when(F.col("_hit"), F.col("_hv")).otherwise(F.col("_dv"))).drop(
        "_key", "_hk", "_hv", "_hit", "_salt", "_ds", "_dk", "_dv")


def encode_by(df: DataFrame, dictionary: DataFrame, columns: list[str], unseen: int | None = 0) -> DataFrame:
    """Adds ``<column>_encoded``; values without a code get ``unseen`` (None: null)."""
    for c in columns:
        out = f"{c}_encoded"
        df = _looked_up(df, F.col(f"`{c}`").cast("string"), dictionary.where(F.col("field") == c), "value", "code", out)
        if unseen is not None:
            df = df.withColumn(out, F.coalesce(out, F.lit(unseen).cast("long")))
    return df


def decode_by(df: DataFrame, dictionary: DataFrame, column: str, code: str, out: str) -> DataFrame:
    """Adds ``out``: the value of ``column`` with this code (null where there is none)."""
    return _looked_up(df, F.col(f"`{code}`").cast("long"), dictionary.where(F.col("field") == column), "code", "value", out)
