"""Exact quantiles per group by sketch brackets.

1. One pass makes a mergeable quantile sketch per group and, for every wanted
   rank, a *bracket*: the sketch's values a little below and above it.
2. A second pass counts what lies below each bracket and moves only the distinct
   values inside (with counts): about 2 * margin of the rows. Whether a bracket
   really holds its rank follows from these counts; a group for which it does not
   (a sketch's error is a bound, not a promise, after many merges) is selected from
   all its values.
3. The moved values are range-partitioned by (group, rank, value); counts per
   partition tell which one holds a rank, and only that one is numbered, by itself.
   No task ever sorts a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder, written


def in_value_order(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows (keys, value, ``_c``) in range partitions by keys and value, numbered
    ``_p`` and written to the shared folder (the numbers stay valid)."""
    shared_folder(counts.sparkSession)
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return counts.repartitionByRange(parts, *keys, value).withColumn("_p", F.spark_partition_id()).checkpoint()


def values_at_ranks(counts: DataFrame, keys: list[str], value: str, ranks: DataFrame) -> DataFrame:
    """(keys, ``_r``, value) of the 0-based ranks (keys, ``_r``) in the order of the
    values, each ``_c`` times."""
    vc = in_value_order(counts, keys, value)
    runs = vc.groupBy(*keys, "_p").agg(F.sum("_c").alias("_pc"))
    runs = runs.withColumn("_below", F.sum("_pc").over(Window.partitionBy(*keys).orderBy("_p")) - F.col("_pc"))
    here = (F.col("_r") >= F.col("_below")) & (F.col("_r") < F.col("_below") + F.col("_pc"))
    wanted = runs.join(ranks.distinct(), keys).where(here).groupBy(*keys, "_p").agg(
        F.first("_below").alias("_below"), F.collect_set("_r").alias("_rs"))
    before = Window.partitionBy(*keys, "_p").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    hit = vc.join(wanted, [*keys, "_p"]).withColumn("_start", F.col("_below") + F.coalesce(F.sum("_c").over(before), F.lit(0)))
    return (hit.select(*keys, value, "_start", "_c", F.explode("_rs").alias("_r"))
               .where((F.col("_r") >= F.col("_start")) & (F.col("_r") < F.col("_start") + F.col("_c"))).select(*keys, "_r", value))


def brackets(rows: DataFrame, group: str, value: str, probs: list[float], accuracy: int) -> DataFrame:
    """Per group: n, min, max and ``_t``, a struct (i, pos, lo, hi) per probability."""
    margin = 2.0 / accuracy
    around = [p for q in probs for p in (max(q - margin, 0.0), min(q + margin, 1.0))]
    sketch = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"),
                                     F.percentile_approx(value, around, accuracy).alias("_b"))
    targets = F.array(*[F.struct(F.lit(i).alias("i"), ((F.col("n") - 1) * float(p)).alias("pos"), F.col("_b")[2 * i].alias("lo"),
                                 F.col("_b")[2 * i + 1].alias("hi")) for i, p in enumerate(probs)])
    return sketch.select(group, "n", "min", "max", targets.alias("_t"))


def inside(rows: DataFrame, group: str, value: str, targets: DataFrame) -> DataFrame:
    """(group, i, value, ``_c``): the distinct values in each bracket, and under a
    null value the rows below it."""
    g = targets.select(F.col(group).alias("_g"), "_t")
    met = F.filter("_t", lambda t: F.col(value) <= t["hi"])
    each = rows.join(g, F.col(group) == F.col("_g")).select(group, value, F.explode(met).alias("t"))
    kept = F.when(F.col(value) >= F.col("t.lo"), F.col(value))
    return each.groupBy(group, F.col("t.i").alias("_i"), kept.alias(value)).agg(F.count(F.lit(1)).alias("_c"))


def exact_quantiles(df: DataFrame, group: str, value: str, probs: list[float], accuracy: int = 10_000) -> DataFrame:
    """Quantiles with linear interpolation: ``group, n, min, max, q0, q1, ...`` (rows
    with a null group or value left out)."""
    # Read two or three times: what makes these rows (joins of large tables) runs once.
    rows = written(df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(group, value), "quantile-rows")
    bound = written(brackets(rows, group, value, probs, accuracy), "quantile-brackets")
    moved = written(inside(rows, group, value, bound), "quantile-values")

    def targets(counted: DataFrame) -> DataFrame:
        sums = counted.groupBy(group, "_i").agg(
            F.coalesce(F.sum(F.when(F.col(value).isNull(), F.col("_c"))), F.lit(0)).alias("_low"),
            F.coalesce(F.sum(F.when(F.col(value).isNotNull(), F.col("_c"))), F.lit(0)).alias("_in"))
        each = bound.select(group, F.explode("_t").alias("t")).select(group, F.col("t.i").alias("_i"), F.col("t.pos").alias("_pos"))
        each = each.join(sums, [group, "_i"], "left").na.fill(0, ["_low", "_in"])
        holds = (F.floor("_pos") >= F.col("_low")) & (F.ceil("_pos") < F.col("_low") + F.col("_in"))
        return each.withColumn("_holds", holds)
    found = targets(moved)
    missed = found.where(~F.col("_holds")).select(group, "_i")
    if missed.count():
        # All values of those groups, for those ranks.
        g = missed.select(F.col(group).alias("_g"), "_i")
        whole = rows.join(g, F.col(group) == F.col("_g")).groupBy(group, "_i", value).agg(F.count(F.lit(1)).alias("_c"))
        moved = written(moved.join(missed, [group, "_i"], "left_anti").unionByName(whole), "quantile-values")
        found = targets(moved)
    ends = F.explode(F.array_distinct(F.array(F.floor("_pos"), F.ceil("_pos"))))
    ranks = found.select(group, "_i", "_low", ends.alias("_r")).select(group, "_i", (F.col("_r") - F.col("_low")).alias("_r"))
    got = values_at_ranks(moved.where(F.col(value).isNotNull()), [group, "_i"], value, ranks)
    per = got.join(found.select(group, "_i", "_pos"), [group, "_i"]).groupBy(group, "_i", "_pos").agg(
        F.min_by(value, "_r").alias("_lo"), F.max_by(value, "_r").alias("_hi"))
    q = F.col("_lo") + (F.col("_pos") - F.floor("_pos")) * (F.col("_hi") - F.col("_lo"))
    wide = per.select(group, "_i", q.alias("_q")).groupBy(group).agg(
        *[F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(f"q{i}") for i in range(len(probs))])
    return bound.select(group, "n", "min", "max").join(wide, group)
