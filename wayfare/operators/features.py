"""Per-user and per-hotel feature tables (aggregations + joins).

Plan shape: each fact table is aggregated to one row per key *before* any
join (partial aggregation map-side, so a user with a third of all bookings
costs one partial row per input partition), and the aggregates are then
joined 1:1 on the user key. The aggregate outputs are already hash
partitioned by the user key, so the joins reuse that partitioning. When an
aggregate is small, AQE turns the join into a broadcast join from measured
(not guessed) sizes.

NULL keys are dropped before grouping (the original group-by drops them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import exact_avg, exact_sum, hotel_id

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def fill_numeric(df: DataFrame, value=0, strings: str | None = None) -> DataFrame:
    """``fillna(0)`` on every numeric column; optionally a string filler too."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, NUMERIC):
            cols.append(F.coalesce(c, F.lit(value).cast(f.dataType)).alias(f.name))
        elif strings is not None and isinstance(f.dataType, T.StringType):
            cols.append(F.coalesce(c, F.lit(strings)).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def flight_agg(flights: DataFrame) -> DataFrame:
    """Per user: mean/sum/count/std of price, mean/sum distance and time,
    number of first-class flights."""
    return (flights.where(F.col("userCode").isNotNull())
            .groupBy("userCode").agg(
                exact_avg("price").alias("avg_flight_price"),
                F.coalesce(exact_sum("price"), F.lit(0.0)).alias("total_flight_spent"),
                F.count("price").alias("flight_count"),
                F.stddev_samp("price").alias("flight_price_std"),
                F.avg("distance").alias("avg_distance"),
                F.coalesce(F.sum("distance"), F.lit(0)).alias("total_distance"),
                exact_avg("time").alias("avg_flight_time"),
                F.coalesce(exact_sum("time"), F.lit(0.0)).alias("total_flight_time"),
                F.count_if(F.col("flightType") == "firstClass").alias("first_class_count")))


def hotel_agg(hotels: DataFrame) -> DataFrame:
    """Per user: mean/sum/count of stay totals, mean/sum days, mean nightly price."""
    return (hotels.where(F.col("userCode").isNotNull())
            .groupBy("userCode").agg(
                exact_avg("total").alias("avg_hotel_total"),
                F.coalesce(exact_sum("total"), F.lit(0.0)).alias("total_hotel_spent"),
                F.count("total").alias("hotel_booking_count"),
                F.avg("days").alias("avg_stay_days"),
                F.coalesce(F.sum("days"), F.lit(0)).alias("total_stay_days"),
                exact_avg("price").alias("avg_hotel_price_per_day")))


def user_features(users: DataFrame, flights: DataFrame, hotels: DataFrame,
                  hotel_key: str = "flight") -> DataFrame:
    """users ⟕ flight_agg ⟕ hotel_agg, numeric NULLs filled with 0.

    ``hotel_key="flight"`` reproduces the original join chain, where the
    hotel aggregate is matched on the *flight-side* user key: a user with
    stays but no flights gets hotel features 0. ``hotel_key="code"`` matches
    the hotel aggregate on the user's own code instead.
    """
    fa = flight_agg(flights)
    ha = hotel_agg(hotels).withColumnRenamed("userCode", "_h_user")
    j = users.join(fa, users.code == fa.userCode, "left")
    # fa.userCode equals users.code whenever it is not NULL, so the original
    # chain is "same user AND the user has flights"; keying both joins on
    # users.code lets the second join reuse the first join's partitioning
    # (no second shuffle of the user table).
    cond = users.code == ha._h_user
    if hotel_key == "flight":
        cond = cond & fa.userCode.isNotNull()
    j = j.join(ha, cond, "left").drop("_h_user")
    return fill_numeric(j)


def user_features_slim(users: DataFrame, flights: DataFrame, hotels: DataFrame) -> DataFrame:
    """The eight-feature variant of the daily pipeline (other column names)."""
    fa = (flights.where(F.col("userCode").isNotNull()).groupBy("userCode").agg(
        exact_avg("price").alias("avg_price"),
        F.coalesce(exact_sum("price"), F.lit(0.0)).alias("total_spent"),
        F.count("price").alias("flight_count"),
        F.avg("distance").alias("avg_distance")))
    ha = (hotels.where(F.col("userCode").isNotNull()).groupBy(F.col("userCode").alias("_h_user")).agg(
        exact_avg("total").alias("avg_hotel"),
        F.count("total").alias("hotel_count"),
        F.avg("days").alias("avg_days")))
    j = (users.join(fa, users.code == fa.userCode, "left")
              .join(ha, (users.code == ha._h_user) & fa.userCode.isNotNull(), "left").drop("_h_user"))
    return fill_numeric(j)


def user_profiles(users: DataFrame, hotels: DataFrame) -> DataFrame:
    """Users with their stay statistics (mean/std nightly price, mean/sum days,
    mean/sum total), 0 for users without stays."""
    ua = (hotels.where(F.col("userCode").isNotNull()).groupBy("userCode").agg(
        exact_avg("price").alias("avg_price"),
        F.stddev_samp("price").alias("price_std"),
        F.avg("days").alias("avg_days"),
        F.coalesce(F.sum("days"), F.lit(0)).alias("total_days"),
        exact_avg("total").alias("avg_total"),
        F.coalesce(exact_sum("total"), F.lit(0.0)).alias("total_spent")))
    return fill_numeric(users.join(ua, users.code == ua.userCode, "left"))


def hotel_table(hotels: DataFrame) -> DataFrame:
    """Stays with their hotel id ``name_place``."""
    return hotels.withColumn("hotel_id", hotel_id("name", "place"))


def hotel_info(hotels: DataFrame) -> DataFrame:
    """Per hotel id: mean nightly price, mean days, mean total, its place and
    the number of stays.

    Stays are summed per hotel id and place by hash: the least of some strings in the
    same aggregate would make Spark sort all stays. Few ids have more than one place."""
    h = hotel_table(hotels).where(F.col("hotel_id").isNotNull())
    money = {c: F.col(c).cast("decimal(38,2)") for c in ("price", "total")}
    per_place = h.groupBy("hotel_id", "place").agg(
        *[F.sum(v).alias(f"_{c}") for c, v in money.items()], F.sum("days").alias("_days"),
        *[F.count(c).alias(f"_n_{c}") for c in ("price", "days", "total")],
        F.count(F.lit(1)).alias("_n"))

    def mean(c):
        return F.sum(f"_{c}").cast("double") / F.sum(f"_n_{c}")
    return per_place.groupBy("hotel_id").agg(
        mean("price").alias("price"),
        mean("days").alias("days"),
        mean("total").alias("total"),
        F.min("place").alias("place"),
        F.sum("_n").alias("bookings"))
