"""Adapters from the provided star-schema test tables to the booking model.

The booking model has three tables (users, flights, hotels). The test data
ships TPC-H-like tables instead, so each booking table is a *view* over the
full base tables (all rows are read; nothing is sampled):

* users   = customer (segment -> company, nation parity -> gender)
* flights = one line item of an order, from the supplier's nation to the
  customer's nation (the same nation at times: ``audit_flights`` reports it);
  customers with key % 17 = 5 have no user key on their flights
* hotels  = one line item, a stay with the part's brand as hotel name in the
  supplier's nation; customers with key % 23 = 7 have no user key on their stays

Numeric columns are mapped so they keep at most two decimals (money and
hours), which lets every engine sum them exactly as DECIMAL(18,2).

The same definitions exist as SQL text in ``wayfare.plans.oracle`` for the
independent DuckDB check; the two must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(custkey, modulus: int, residue: int):
    """A customer key as user key; NULL for one residue class of customers, so
    that rules about missing keys (and users with stays but no flights) meet real rows."""
    return F.when(custkey % modulus != residue, custkey)


def round2(c):
    """Half-up rounding to cents with plain IEEE arithmetic (engine independent)."""
    return F.floor(c * 100 + 0.5) / 100


# Rows that a task of the join of line items and orders sorts at most, about. (Beyond 200 tasks
# Spark sorts on the writing side too, in memory up to a file split: so not many more than needed.)
TASK_ROWS = 1_500_000


def join_tasks(spark: SparkSession, *sides: DataFrame) -> int:
    """Tasks of a sort-merge join of these tables, so that what one sorts does not grow with them;
    0 where they are small enough to be left to Spark.

    Spark merges partitions up to a size of compressed shuffle data, several times that when
    sorted. The rows are counted from the files' footers."""
    rows = sum(df.count() for df in sides)
    if rows <= TASK_ROWS * spark.sparkContext.defaultParallelism:
        return 0
    # A join of fewer partitions than this setting is dealt anew by Spark.
    return max(-(-rows // TASK_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))


def merged(items: DataFrame, orders: DataFrame, tasks: int) -> DataFrame:
    """Line items with their orders. Orders grow as the line items do. Their files may be so compact
    that Spark would broadcast them, and every task would hold all of them: they are merged instead."""
    on = items.l_orderkey == orders.o_orderkey
    if tasks:
        items, orders = items.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    return items.join(orders.hint("merge"), on)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = base(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("code"),
        F.col("c_mktsegment").alias("company"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") % 2 == 0, "male").otherwise("female").alias("gender"),
        (F.lit(22) + F.col("c_custkey") % 44).cast("int").alias("age"),
    )


def flights(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """``tasks``: of the join of line items and orders (``join_tasks``), if known already."""
    li = base(spark, sf_dir, "lineitem")
    o = base(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = base(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = base(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = base(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    nf = n.select(F.col("n_nationkey").alias("nf_key"), F.col("n_name").alias("from"))
    nt = n.select(F.col("n_nationkey").alias("nt_key"), F.col("n_name").alias("to"))
    # Orders meet their customers before the line items, which are moved once.
    oc = o.join(c, o.o_custkey == c.c_custkey).join(nt, c.c_nationkey == nt.nt_key)
    j = (merged(li, oc, join_tasks(spark, li, o) if tasks is None else tasks)
           .join(s, li.l_suppkey == s.s_suppkey)
           .join(nf, s.s_nationkey == nf.nf_key))
    return j.select(
        F.col("l_orderkey").alias("travelCode"),
        keyed(F.col("o_custkey"), 17, 5).alias("userCode"),
        F.col("from"), F.col("to"),
        F.when(F.col("l_returnflag") == "A", "economic")
         .when(F.col("l_returnflag") == "N", "business")
         .otherwise("firstClass").alias("flightType"),
        F.col("l_extendedprice").alias("price"),
        round2(F.col("l_quantity") * 100 / 500 + 0.5 + F.col("l_tax") * 10).alias("time"),
        (F.col("l_quantity") * 100).cast("bigint").alias("distance"),
        F.col("o_orderpriority").alias("agency"),
        F.col("l_shipdate").cast("date").alias("date"),
    )


def hotels(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """``tasks``: of the join of line items and orders (``join_tasks``), if known already."""
    li = base(spark, sf_dir, "lineitem")
    o = base(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = base(spark, sf_dir, "part").select("p_partkey", "p_brand")
    s = base(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = base(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (merged(li, o, join_tasks(spark, li, o) if tasks is None else tasks)
           .join(p, li.l_partkey == p.p_partkey)
           .join(s, li.l_suppkey == s.s_suppkey)
           .join(n, s.s_nationkey == n.n_nationkey))
    days = (F.lit(1) + F.col("l_quantity").cast("bigint") % 14)
    return j.select(
        F.col("l_orderkey").alias("travelCode"),
        keyed(F.col("o_custkey"), 23, 7).alias("userCode"),
        F.col("p_brand").alias("name"),
        F.col("n_name").alias("place"),
        days.cast("int").alias("days"),
        round2(F.col("l_extendedprice") / days).alias("price"),
        F.col("l_extendedprice").alias("total"),
        F.col("l_shipdate").cast("date").alias("date"),
    )


def booking_tables(spark: SparkSession, sf_dir: str):
    """(users, flights, hotels) views over the whole base tables."""
    tasks = join_tasks(spark, base(spark, sf_dir, "lineitem"), base(spark, sf_dir, "orders"))
    return users(spark, sf_dir), flights(spark, sf_dir, tasks), hotels(spark, sf_dir, tasks)


# --------------------------------------------------------------------------
# Request tables. The original system answers one HTTP request at a time;
# here a request is a row and a batch of requests is a table. The batches
# below are derived from the whole data (one request per order / per user),
# with some fields blanked or replaced by unseen words through CASE rules on
# the key, so that the default and fallback paths run on every batch.
# --------------------------------------------------------------------------

def price_requests(flights_df: DataFrame) -> DataFrame:
    """One price request per order (travelCode) built from its first flight line."""
    k = F.col("request_id")
    agg = flights_df.groupBy(F.col("travelCode").alias("request_id")).agg(
        F.min("from").alias("from"), F.min("to").alias("to"),
        F.min("flightType").alias("flightType"), F.min("agency").alias("agency"),
        F.min("time").alias("time"), F.min("distance").alias("distance"),
        F.min("date").alias("date"))
    return agg.select(
        k,
        F.when(k % 223 == 13, F.lit(None).cast("string"))
         .when(k % 97 == 3, F.lit("Atlantis")).otherwise(F.col("from")).alias("from"),
        F.when(k % 83 == 6, F.lit("Lemuria")).when(k % 227 == 17, F.lit(None).cast("string"))
         .otherwise(F.col("to")).alias("to"),
        F.when(k % 101 == 7, F.lit("economy")).otherwise(F.col("flightType")).alias("flightType"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
         .when(k % 89 == 5, F.lit("NewCo")).otherwise(F.col("agency")).alias("agency"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("time")).alias("time"),
        F.when(k % 211 == 11, F.lit(None).cast("bigint")).otherwise(F.col("distance")).alias("distance"),
        F.when(k % 3 == 0, F.lit(None).cast("int")).otherwise(F.month("date")).alias("month"),
        F.when(k % 3 == 0, F.lit(None).cast("int")).otherwise(F.weekday("date")).alias("day_of_week"),
        F.when(k % 3 == 0, F.lit(None).cast("int"))
         .otherwise(F.weekday("date").isin(5, 6).cast("int")).alias("is_weekend"),
    )


def gender_requests(user_feats: DataFrame) -> DataFrame:
    """One classification request per user from the user's feature row
    (``user_features``): some features missing, some under their legacy names,
    some companies unseen."""
    k = F.col("code")
    legacy = {"avg_price": "avg_flight_price", "total_spent": "total_flight_spent", "avg_hotel": "avg_hotel_total",
              "hotel_count": "hotel_booking_count", "avg_days": "avg_stay_days"}
    blank = {"age": 13, "avg_distance": 11, "total_distance": 29, "first_class_count": 31, "total_stay_days": 37}
    cols = [k.alias("request_id"),
            F.when(k % 41 == 3, F.lit("NewCo")).when(k % 43 != 5, F.col("company")).alias("company")]
    for new in ("age", "avg_flight_price", "total_flight_spent", "flight_count", "avg_distance", "total_distance",
                "avg_flight_time", "first_class_count", "avg_hotel_total", "total_hotel_spent", "hotel_booking_count",
                "avg_stay_days", "total_stay_days", "avg_hotel_price_per_day"):
        renamed = new in legacy.values()
        cols.append(F.when((k % 3 != 1) if renamed else (k % blank.get(new, 47) != 2), F.col(new)).alias(new))
    cols += [F.when(k % 3 == 1, F.col(new)).alias(old) for old, new in legacy.items()]
    return user_feats.select(*cols)


def rec_requests(users_df: DataFrame, nation_df: DataFrame | None = None) -> DataFrame:
    """One recommendation request per user; method and preferences vary by code."""
    code = F.col("code")
    place = F.lit(None).cast("string")
    df = users_df
    if nation_df is not None:
        # Preferred place: a nation name picked by the code (a known place or not).
        n = nation_df.select(F.col("n_nationkey").alias("_nk"), F.col("n_name").alias("_place"))
        df = df.join(n, (code % 25) == n._nk, "left")
        place = F.col("_place")
    price = (F.lit(80) + code % 420).cast("double")
    days = (F.lit(1) + code % 14).cast("double")
    prefs = F.struct(
        F.when(code % 8 == 4, F.lit(None).cast("double")).otherwise(price).alias("price"),
        days.alias("days"),
        (price * days).alias("total"),
        F.when(code % 12 == 8, F.lit("Atlantis")).otherwise(place).alias("place"))
    return df.select(
        code.alias("request_id"),
        code.alias("user_code"),
        F.when(code % 3 == 0, "collaborative").when(code % 3 == 1, "content")
         .otherwise("hybrid").alias("method"),
        F.lit(5).alias("n_recommendations"),
        F.when(code % 4 == 0, prefs).alias("preferences"),
    )


def budget_requests(users_df: DataFrame, nation_df: DataFrame) -> DataFrame:
    """One budget search per user: budget, stay length and destination (or Any)."""
    code = F.col("code")
    n = nation_df.select(F.col("n_nationkey").alias("_nk"), F.col("n_name").alias("_place"))
    df = users_df.join(n, (code % 25) == n._nk, "left")
    return df.select(
        code.alias("request_id"),
        (F.lit(50) + code % 450).cast("double").alias("budget"),
        (F.lit(1) + code % 14).cast("int").alias("stay_days"),
        F.when(code % 2 == 0, F.lit("Any")).otherwise(F.col("_place")).alias("destination"),
    )
