"""Dictionary encoding of categorical columns.

A dictionary is a small DataFrame ``(value, code)``: the sorted distinct
values (as strings) numbered 0..k-1 (byte order of UTF-8, which is code
point order). Encoding is a join with the dictionary; a value missing from
it gets code 0, the first label, which is what the original encoder's
fallback produced. Dictionaries hold distinct values of low-cardinality
columns (cities, agencies, companies, classes, places); numbering them is a
window over that small distinct set, and the join against the facts is left
to AQE, which broadcasts it when its measured size is small.

Several columns of one table are better served by ``dictionary_row``: one
aggregate row with the sorted distinct values of every column, read in a
single pass, and applied as a scalar subquery (no join). Its arrays hold one
entry per distinct value, so it is for columns of bounded cardinality.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def build_dictionary(df: DataFrame, column: str) -> DataFrame:
    v = F.col(f"`{column}`").cast("string")
    d = df.select(v.alias("value")).where(F.col("value").isNotNull()).distinct()
    return d.select("value", (F.row_number().over(Window.orderBy("value")) - 1).cast("int").alias("code"))


def encode(df: DataFrame, column: str, dictionary: DataFrame, out: str | None = None,
           unseen: int | None = 0) -> DataFrame:
    """Add ``out`` (default ``<column>_encoded``) = code of the value; values not
    in the dictionary get ``unseen`` (0 = first label; None keeps NULL)."""
    out = out or f"{column}_encoded"
    d = dictionary.select(F.col("value").alias("_v"), F.col("code").alias("_c"))
    j = df.join(d, F.col(f"`{column}`").cast("string") == F.col("_v"), "left")
    code = F.col("_c") if unseen is None else F.coalesce(F.col("_c"), F.lit(unseen))
    return j.withColumn(out, code.cast("int")).drop("_v", "_c")


def decode(df: DataFrame, code_col: str, dictionary: DataFrame, out: str) -> DataFrame:
    """Code -> label (NULL when the code is not in the dictionary)."""
    d = dictionary.select(F.col("value").alias(out), F.col("code").alias("_c"))
    return df.join(d, F.col(f"`{code_col}`") == F.col("_c"), "left").drop("_c")


def label_encode(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Fit a dictionary on ``df`` itself and encode it (fit_transform)."""
    return encode(df, column, build_dictionary(df, column), out)


def dictionary_row(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: per column the sorted distinct non-null values as strings."""
    return df.agg(*[F.array_sort(F.collect_set(F.col(f"`{c}`").cast("string"))).alias(c) for c in columns])


def dictionary_table(row: DataFrame) -> DataFrame:
    """(field, value, code) of every dictionary of a ``dictionary_row``."""
    each = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("sorted")) for c in row.columns])
    one = row.select(F.explode(each).alias("d")).select("d.field", F.posexplode("d.sorted").alias("code", "value"))
    return one.select("field", "value", "code")


def encode_columns(df: DataFrame, row: DataFrame, columns: list[str] | None = None, unseen: int = 0) -> DataFrame:
    """Add ``<column>_encoded`` for every column with a dictionary in ``row``."""
    s = row.select(F.struct(*[F.col(f"`{c}`") for c in row.columns]).alias("s")).scalar()
    at = {c: F.array_position(s[c], F.col(f"`{c}`").cast("string")).cast("int") for c in columns or row.columns}
    return df.select("*", *[F.when(p > 0, p - 1).otherwise(F.lit(unseen)).alias(f"{c}_encoded") for c, p in at.items()])


def decode_column(df: DataFrame, row: DataFrame, column: str, code_col: str, out: str) -> DataFrame:
    """Code -> label by a ``dictionary_row`` (NULL when there is no such code)."""
    s = row.select(F.col(f"`{column}`").alias("s")).scalar()
    return df.withColumn(out, F.get(s, F.col(code_col)))
