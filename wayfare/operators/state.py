"""Aggregates kept as mergeable state: a daily run reads its delta only.

* *Day partials* hold, per day and user, counts and exact sums (decimal, squares
  too), all of which can be added and taken away; and per day the bookings, revenue
  and a distinct sketch of the users.
* The *totals* hold the sums per user over all days.
* A run takes the whole content of some days (new, late or corrected). New totals are
  the old ones plus the days' new partials less their former ones. Raw rows of other
  days are never read.

Every run writes its partials and totals into folders of its own; a manifest row per
day, written last, makes them current. A run that dies before it changes nothing, and
can be repeated.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import month_bucket

MANIFEST = "seq long, run string, day date"
SUMS = {"n": "count", "n_price": "count", "price": "money", "price2": "square", "distance": "count", "n_distance": "count",
        "time": "money", "n_time": "count", "first_class": "count"}
TYPE = {"count": "bigint", "money": "decimal(38,2)", "square": "decimal(38,4)"}


def day_partials(flights: DataFrame) -> DataFrame:
    """(day, userCode, sums) of flights with a date and a user."""
    money = lambda c: F.col(c).cast("decimal(18,2)")
    aggs = {"n": F.count(F.lit(1)), "n_price": F.count("price"), "price": F.sum(money("price")),
            "price2": F.sum((money("price") * money("price")).cast("decimal(38,4)")), "distance": F.sum("distance"),
            "n_distance": F.count("distance"), "time": F.sum(money("time")), "n_time": F.count("time"),
            "first_class": F.count_if(F.col("flightType") == "firstClass")}
    rows = flights.where(F.col("date").isNotNull() & F.col("userCode").isNotNull())
    return rows.groupBy(F.col("date").alias("day"), "userCode").agg(
        *[F.coalesce(e, F.lit(0)).cast(TYPE[SUMS[c]]).alias(c) for c, e in aggs.items()])


def day_summary(flights: DataFrame) -> DataFrame:
    """(day, bookings, revenue, users): all flights with a date; users as a sketch."""
    return (flights.where(F.col("date").isNotNull()).groupBy(F.col("date").alias("day"))
                   .agg(F.count("travelCode").alias("bookings"),
                        F.coalesce(F.sum(F.col("price").cast("decimal(18,2)")), F.lit(0)).cast("decimal(38,2)").alias("revenue"),
                        F.hll_sketch_agg("userCode").alias("users")))


class FlightState:
    """The state under a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, name: str, run: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}/{run}")

    def current(self) -> tuple[int, dict, str | None]:
        """(number of runs, the run that holds each day, the newest run)."""
        try:
            rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest").collect()  # a row per day and run
        except AnalysisException:
            return 0, {}, None
        days: dict = {}
        for r in sorted(rows, key=lambda r: (r["seq"], r["run"])):
            if r["day"] is not None:
                days[r["day"]] = r["run"]
        last = max(rows, key=lambda r: (r["seq"], r["run"]))
        return last["seq"], days, last["run"]

    def _days(self, name: str, schema: str, days: dict) -> DataFrame:
        """Rows of a partial table, each day from the run that holds it."""
        runs: dict = {}
        for d, run in days.items():
            runs.setdefault(run, []).append(d)
        # Months are folders; within them files are sorted by day.
        parts = [self._read(name, run, f"{schema}, month string").where(
            F.col("month").isin(sorted({f"{d:%Y-%m}" for d in ds})) & F.col("day").isin(ds)).drop("month") for run, ds in runs.items()]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    USER_DAY = "day date, userCode long, " + ", ".join(f"{c} {TYPE[k]}" for c, k in SUMS.items())
    TOTAL = "userCode long, " + ", ".join(f"{c} {TYPE[k]}" for c, k in SUMS.items())
    DAY = "day date, bookings long, revenue decimal(38,2), users binary"

    def _write(self, rows: DataFrame, name: str, run: str) -> None:
        (rows.withColumn("month", month_bucket("day")).repartition("month").sortWithinPartitions("month", "day")
             .write.partitionBy("month").parquet(f"{self.path}/{name}/{run}"))

    def apply(self, flights: DataFrame, emptied: list = ()) -> None:
        """Merges the whole content of the days of ``flights``; ``emptied``: days that now have no rows."""
        seq, days, newest = self.current()
        run = f"{seq + 1:06d}-{uuid.uuid4().hex[:8]}"
        self._write(day_summary(flights), "day", run)
        touched = [r["day"] for r in self._read("day", run, self.DAY).select("day").distinct().collect()]  # a row per day
        touched = sorted({*touched, *emptied})
        self._write(day_partials(flights), "user_day", run)
        new = self._read("user_day", run, self.USER_DAY).drop("month")
        old = self._days("user_day", self.USER_DAY, {d: days[d] for d in touched if d in days})
        signed = new.drop("day").unionByName(old.select("userCode", *[(-F.col(c)).cast(TYPE[k]).alias(c) for c, k in SUMS.items()]))
        if newest is not None:
            signed = signed.unionByName(self._read("total", newest, self.TOTAL))
        total = signed.groupBy("userCode").agg(*[F.sum(c).cast(TYPE[k]).alias(c) for c, k in SUMS.items()]).where("n <> 0")
        total.write.parquet(f"{self.path}/total/{run}")
        self.spark.createDataFrame([(seq + 1, run, d) for d in touched or [None]], MANIFEST).coalesce(1) \
            .write.mode("append").parquet(f"{self.path}/manifest")

    def flight_agg(self) -> DataFrame:
        """``features.flight_agg`` of all days, from the totals."""
        _, _, newest = self.current()
        t = self._read("total", newest, self.TOTAL)
        n, s, s2 = F.col("n_price"), F.col("price"), F.col("price2")
        # n * sum(x * x) - sum(x) ** 2 is exact; only the division and the root round.
        spread = (n.cast("decimal(20,0)") * s2 - (s.cast("decimal(18,2)") * s.cast("decimal(18,2)"))).cast("double")
        mean = lambda total, count: F.when(F.col(count) > 0, F.col(total).cast("double") / F.col(count))
        return t.select("userCode", mean("price", "n_price").alias("avg_flight_price"), s.cast("double").alias("total_flight_spent"),
                        n.alias("flight_count"), F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / n / (n - 1))).alias("flight_price_std"),
                        mean("distance", "n_distance").alias("avg_distance"), F.col("distance").alias("total_distance"),
                        mean("time", "n_time").alias("avg_flight_time"), F.col("time").cast("double").alias("total_flight_time"),
                        F.col("first_class").alias("first_class_count"))

    def days_table(self) -> DataFrame:
        _, days, _ = self.current()
        return self._days("day", self.DAY, days)

    def monthly_trend(self) -> DataFrame:
        """``analytics.monthly_trend`` from the day summaries."""
        return self.days_table().groupBy(month_bucket("day").alias("month")).agg(
            F.sum("bookings").alias("bookings"), F.sum("revenue").cast("double").alias("revenue"))

    def active_users(self) -> DataFrame:
        """Distinct users per month, from the union of the days' sketches."""
        return self.days_table().groupBy(month_bucket("day").alias("month")).agg(
            F.hll_sketch_estimate(F.hll_union_agg("users")).alias("active_users"))
