"""Fixed schemas of the three booking tables and their readers.

CSV is read with a declared schema (never ``inferSchema``), so a scan is a
single pass and types do not depend on the sample. NaN in a numeric column
is turned into NULL at read time because the original tables treat the two
alike (a Spark NaN is not NULL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

USERS_SCHEMA = T.StructType([
    T.StructField("code", T.LongType()),
    T.StructField("company", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
])

FLIGHTS_SCHEMA = T.StructType([
    T.StructField("travelCode", T.LongType()),
    T.StructField("userCode", T.LongType()),
    T.StructField("from", T.StringType()),
    T.StructField("to", T.StringType()),
    T.StructField("flightType", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("time", T.DoubleType()),
    T.StructField("distance", T.LongType()),
    T.StructField("agency", T.StringType()),
    T.StructField("date", T.DateType()),
])

HOTELS_SCHEMA = T.StructType([
    T.StructField("travelCode", T.LongType()),
    T.StructField("userCode", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("place", T.StringType()),
    T.StructField("days", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("total", T.DoubleType()),
    T.StructField("date", T.DateType()),
])

SCHEMAS = {"users": USERS_SCHEMA, "flights": FLIGHTS_SCHEMA, "hotels": HOTELS_SCHEMA}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column (pandas treats them alike)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def read_table(spark: SparkSession, path: str, table: str, fmt: str = "csv") -> DataFrame:
    """Read one of users/flights/hotels with its fixed schema.

    Dates are parsed by the CSV reader with ``yyyy-MM-dd``; with ANSI mode
    on (the Spark 4 default) a malformed date fails the read, which is the
    behaviour of the original eager parser.
    """
    schema = SCHEMAS[table]
    if fmt == "csv":
        df = (spark.read.schema(schema).option("header", True)
              .option("dateFormat", "yyyy-MM-dd").option("mode", "FAILFAST").csv(path))
    else:
        df = spark.read.schema(schema).format(fmt).load(path)
    return nan_to_null(df)


def scan_tables(spark: SparkSession, data_dir: str, fmt: str = "csv"):
    """Load ``users``, ``flights`` and ``hotels`` from ``data_dir/<name>.<fmt>``."""
    ext = "csv" if fmt == "csv" else fmt
    return tuple(read_table(spark, f"{data_dir}/{t}.{ext}", t, fmt)
                 for t in ("users", "flights", "hotels"))


def table_counts(**tables: DataFrame) -> DataFrame:
    """One row per table with its row count, as a single job (union of counts)."""
    parts = [df.select(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
