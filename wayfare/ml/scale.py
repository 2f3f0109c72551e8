"""Standard scaling with population statistics, fitted on one DataFrame and
applied to any other.

The fitted scaler is a one-row DataFrame (mean and population std per
column; a zero std is replaced by 1). Applying it references that row as a
single scalar subquery returning a struct, computed once and inlined into
the projection, so scaling stays inside whole-stage codegen with no join.
``pyspark.ml.feature.StandardScaler`` is not used because it divides by the
sample std, which gives different numbers from the original model inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_scaler(df: DataFrame, cols: list[str]) -> DataFrame:
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        aggs.append(F.avg(x).alias(f"mean_{c}"))
        sd = F.stddev_pop(x)
        aggs.append(F.when((sd == 0) | sd.isNull(), F.lit(1.0)).otherwise(sd).alias(f"std_{c}"))
    return df.agg(*aggs)


def apply_scaler(df: DataFrame, scaler: DataFrame, cols: list[str],
                 suffix: str = "_scaled") -> DataFrame:
    s = scaler.select(F.struct(*scaler.columns).alias("s")).scalar()
    return df.select("*", *[((F.col(f"`{c}`") - s[f"mean_{c}"]) / s[f"std_{c}"]).alias(f"{c}{suffix}")
                            for c in cols])


def standard_scale(train: DataFrame, cols: list[str], *others: DataFrame,
                   suffix: str = "_scaled"):
    """Fit on ``train`` and scale ``train`` and every DataFrame in ``others``."""
    sc = fit_scaler(train, cols)
    out = [apply_scaler(train, sc, cols, suffix)] + [apply_scaler(o, sc, cols, suffix) for o in others]
    return (sc, *out)
