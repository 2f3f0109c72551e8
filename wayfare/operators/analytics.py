"""Dashboard analytics: global metrics, shares, top-k, trends and distributions.

Every function is a lazy DataFrame plan. Aggregates use Spark's partial
(map-side) aggregation, so a hot key costs one partial row per input
partition, not a skewed shuffle. Top-k lists are ``orderBy(...).limit(k)``,
planned as TakeOrderedAndProject (a per-partition heap), never a global sort.
Ties are broken by the key so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import (AGE_LABELS, age_group, exact_avg, exact_sum,
                                month_bucket, route)
from .quantiles import exact_quantiles


def _one_row(df: DataFrame, *aggs) -> DataFrame:
    return df.agg(*aggs)


def summary_metrics(users: DataFrame, flights: DataFrame, hotels: DataFrame) -> DataFrame:
    """Row counts of the three tables and the mean flight price (one row).

    Each table is aggregated to one row and the rows are combined through
    scalar subqueries, so there is no join at all.
    """
    n_users = users.select(F.count(F.lit(1))).scalar()
    n_hotels = hotels.select(F.count(F.lit(1))).scalar()
    return flights.agg(
        n_users.alias("total_users"),
        F.count(F.lit(1)).alias("total_flights"),
        n_hotels.alias("total_hotel_bookings"),
        exact_avg("price").alias("avg_flight_price"))


def kpi_metrics(users: DataFrame, flights: DataFrame, hotels: DataFrame,
                approx_distinct: bool = False) -> DataFrame:
    """Revenue = sum(flight price) + sum(hotel total); mean ticket; mean stay spend;
    distinct users. ``approx_distinct`` switches to HyperLogLog++ for huge tables."""
    h = hotels.agg(exact_sum("total").alias("s"), exact_avg("total").alias("a"))
    hs = h.select("s").scalar()
    ha = h.select("a").scalar()
    distinct = (F.approx_count_distinct("code") if approx_distinct
                else F.count_distinct("code"))
    nu = users.select(distinct).scalar()
    return flights.agg(
        (F.coalesce(exact_sum("price"), F.lit(0.0)) + F.coalesce(hs, F.lit(0.0))).alias("total_revenue"),
        exact_avg("price").alias("avg_ticket_price"),
        ha.alias("avg_hotel_spend"),
        nu.alias("active_users"))


def category_share(df: DataFrame, column: str, value: str | None = None) -> DataFrame:
    """Count (or sum of ``value``) per category and its share of the total.

    The grouped result has one row per category (small), so the total is a
    window over that result, not over the facts. NULL categories are dropped.
    """
    g = df.where(F.col(column).isNotNull()).groupBy(column)
    if value is None:
        g = g.agg(F.count(F.lit(1)).alias("count"))
        m = "count"
    else:
        g = g.agg(exact_sum(value).alias(f"total_{value}"))
        m = f"total_{value}"
    w = Window.partitionBy()
    return g.withColumn("share", F.col(m) / F.sum(m).over(w))


def revenue_by_type(flights: DataFrame) -> DataFrame:
    return category_share(flights, "flightType", "price").withColumnRenamed("total_price", "revenue")


def top_counts(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """``value_counts().head(k)`` with a total order: count desc, value asc."""
    return (df.where(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.col("count").desc(), F.col(column).asc()).limit(k))


def top_companies(users: DataFrame, k: int = 10) -> DataFrame:
    return top_counts(users, "company", k)


def top_hotel_names(hotels: DataFrame, k: int = 10) -> DataFrame:
    return top_counts(hotels, "name", k)


def top_places(hotels: DataFrame, k: int = 10) -> DataFrame:
    return top_counts(hotels, "place", k)


def gender_distribution(users: DataFrame) -> DataFrame:
    return (users.where(F.col("gender").isNotNull())
                 .groupBy("gender").agg(F.count(F.lit(1)).alias("count")))


def monthly_avg_price(flights: DataFrame) -> DataFrame:
    """Mean flight price per calendar month (1-12), over all years."""
    return (flights.where(F.col("date").isNotNull())
                   .groupBy(F.month("date").alias("month"))
                   .agg(exact_avg("price").alias("avg_price")))


def monthly_trend(flights: DataFrame) -> DataFrame:
    """Bookings and revenue per ``yyyy-MM``."""
    return (flights.where(F.col("date").isNotNull())
                   .groupBy(month_bucket("date").alias("month"))
                   .agg(F.count("travelCode").alias("bookings"),
                        F.coalesce(exact_sum("price"), F.lit(0.0)).alias("revenue")))


def top_routes(flights: DataFrame, k: int = 10) -> DataFrame:
    """Bookings and revenue per route ``from → to``; the k busiest routes."""
    r = route("from", "to")
    return (flights.where(r.isNotNull())
                   .groupBy(r.alias("route"))
                   .agg(F.count("price").alias("bookings"),
                        F.coalesce(exact_sum("price"), F.lit(0.0)).alias("revenue"))
                   .orderBy(F.col("bookings").desc(), F.col("route").asc()).limit(k))


def user_spending(users: DataFrame, flights: DataFrame) -> DataFrame:
    """Each user with total flight spend (0 when the user has no flights).

    The per-user aggregate is computed before the join, so the join input is
    one row per user on both sides (no fan-out, no hot key).
    """
    spend = (flights.where(F.col("userCode").isNotNull())
                    .groupBy("userCode").agg(exact_sum("price").alias("total_spent")))
    return (users.join(spend, users.code == spend.userCode, "left")
                 .select(users["*"], F.coalesce("total_spent", F.lit(0.0)).alias("total_spent")))


def spend_by_age(users: DataFrame, flights: DataFrame) -> DataFrame:
    """Mean spend per age group; every label is present (empty group -> NULL)."""
    us = user_spending(users, flights).select(age_group("age").alias("age_group"), "total_spent")
    agg = (us.where(F.col("age_group").isNotNull()).groupBy("age_group")
             .agg(F.avg("total_spent").alias("avg_spent")))
    labels = users.sparkSession.createDataFrame([(i, lab) for i, lab in enumerate(AGE_LABELS)],
                                                "ord int, age_group string")
    return labels.join(agg, "age_group", "left").select("age_group", "avg_spent")


def spend_by_gender(users: DataFrame, flights: DataFrame) -> DataFrame:
    us = user_spending(users, flights)
    return (us.where(F.col("gender").isNotNull()).groupBy("gender")
              .agg(F.avg("total_spent").alias("avg_spent")))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """``bins`` equal-width bins over [min, max] with counts, empty bins included.

    min/max come from one aggregate (a scalar subquery); each row is then
    assigned a bin by arithmetic, counted with partial aggregation and joined
    to the small bin dimension (``bins`` rows).
    """
    x = F.col(column)
    stats = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    lo = stats.select("lo").scalar()
    hi = stats.select("hi").scalar()
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((x - lo) / width), F.lit(bins - 1))).cast("int")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    dim = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    dim = dim.select("bin", (lo + F.col("bin") * width).cast("double").alias("bin_start"),
                     (lo + (F.col("bin") + 1) * width).cast("double").alias("bin_end"))
    return (dim.join(counts, "bin", "left")
               .select("bin", "bin_start", "bin_end", F.coalesce("count", F.lit(0)).alias("count")))


def age_histogram(users: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(users, "age", bins)


def hotel_price_histogram(hotels: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(hotels, "price", bins)


def price_box(flights: DataFrame, group: str = "flightType", value: str = "price",
              approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Box-plot statistics per group: quartiles, IQR fences, whiskers, outliers.

    Quartiles are exact with linear interpolation (``exact_quantiles``: a sketch
    brackets them, only values inside the brackets are moved); ``approx=True`` uses
    the mergeable quantile sketch alone.
    """
    v = F.col(value)
    rows = flights.where(F.col(group).isNotNull() & v.isNotNull()).select(group, value)
    if approx:
        quart = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"),
                                        F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy).alias("_q")).select(
            group, "n", "min", "max", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    else:
        quart = exact_quantiles(rows, group, value, [0.25, 0.5, 0.75]).select(
            group, "n", "min", "max", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    quart = quart.withColumn("iqr", F.col("q3") - F.col("q1")) \
                 .withColumn("lower_fence", F.col("q1") - 1.5 * F.col("iqr")) \
                 .withColumn("upper_fence", F.col("q3") + 1.5 * F.col("iqr"))
    # Whiskers and outliers by one aggregation with the per-group fences.
    j = rows.join(quart.select(group, "lower_fence", "upper_fence"), group)
    inside = (v >= F.col("lower_fence")) & (v <= F.col("upper_fence"))
    wh = j.groupBy(group).agg(
        F.min(F.when(inside, v)).alias("lower_whisker"),
        F.max(F.when(inside, v)).alias("upper_whisker"),
        F.count_if(~inside).alias("outliers"))
    return quart.join(wh, group)


def similar_flights(requests: DataFrame, flights: DataFrame,
                    prediction: str | None = None) -> DataFrame:
    """Mean price of flights with the request's origin and class; when the
    origin has none, the mean over the class (basis 'type'); else no basis.

    Both means are aggregates (one row per (from, class) and per class)
    joined to the request table; with ``prediction`` the difference
    prediction - mean is added.
    """
    f = flights.where(F.col("price").isNotNull())
    by_route = f.groupBy("from", "flightType").agg(exact_avg("price").alias("_m1"),
                                                   F.count("price").alias("_n1"))
    by_type = f.groupBy("flightType").agg(exact_avg("price").alias("_m2"))
    r = (requests.join(by_route, ["from", "flightType"], "left")
                 .join(by_type, ["flightType"], "left"))
    has_route = F.coalesce(F.col("_n1"), F.lit(0)) > 0
    basis = F.when(has_route, "route").when(F.col("_m2").isNotNull(), "type")
    mean = F.when(has_route, F.col("_m1")).otherwise(F.col("_m2"))
    out = r.select(requests["*"], basis.alias("basis"), mean.alias("similar_avg_price"))
    if prediction:
        out = out.withColumn("difference",
                             F.when(F.col("basis") == "route",
                                    F.col(prediction) - F.col("similar_avg_price")))
    return out


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def distinct_values_by_column(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value): the distinct non-null values of several columns, in one pass over the table."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
                                for c in columns])).alias("p")
    return df.select(pairs).select("p.*").where(F.col("value").isNotNull()).distinct()


def known_cities(flights: DataFrame) -> DataFrame:
    """Every city seen as origin or destination."""
    a = flights.select(F.col("from").alias("city"))
    b = flights.select(F.col("to").alias("city"))
    return a.union(b).where(F.col("city").isNotNull()).distinct()


def unknown_cities(requests: DataFrame, flights: DataFrame, columns: tuple[str, ...] = ("from", "to")) -> DataFrame:
    """Requests with a city that is not among the known cities: one row per
    such ``field``, with the ``city``. A missing or empty city is not unknown."""
    kc = known_cities(flights).withColumnRenamed("city", "_known")
    sides = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("city")) for c in columns]))
    asked = requests.select("*", sides.alias("_side")).select(*requests.columns, "_side.*")
    asked = asked.where(F.col("city").isNotNull() & (F.col("city") != ""))
    return asked.join(kc, F.col("city") == F.col("_known"), "left_anti")


def head_preview(df: DataFrame, key: str | list[str], n: int = 20) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    return df.orderBy(*keys).limit(n)


def sample_key(key, seed: int = 42, modulus: int = 1000003):
    """Seeded pseudo-random rank of an integer key, bounded so it never overflows.

    Plain integer arithmetic (not an engine-specific hash) so any SQL engine
    reproduces the same sample.
    """
    return F.pmod(F.pmod(F.col(key), F.lit(modulus)) * 7919 + seed, F.lit(modulus))


def sample_points(flights: DataFrame, n: int = 500, seed: int = 42) -> DataFrame:
    """Up to ``n`` flights chosen by a seeded key hash (reproducible and
    independent of partitioning): distance, price, flightType. Ties on the
    hash are broken by every output column."""
    cols = ["distance", "price", "flightType"]
    return (flights.select(*cols, sample_key("travelCode", seed).alias("_h"))
                   .orderBy("_h", *cols).limit(n).select(*cols))
