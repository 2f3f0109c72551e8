"""Registered data-quality, profiling and sink queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..functions.scalar import stable
from ..operators import quality as Q
from ..sources import sinks, staged
from .catalog import query, tables
from .oracle import stable as sstable

_FLIGHT_COLS = ["travelCode", "userCode", "price", "time", "distance"]


@query("validate_data", """
SELECT 'users' AS "table", 'users_not_empty' AS "check", count(*) > 0 AS passed,
       CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) AS bad_rows FROM users
UNION ALL
SELECT 'users', 'users_no_nulls', count(*) FILTER (WHERE code IS NULL OR "name" IS NULL OR gender IS NULL) = 0,
       count(*) FILTER (WHERE code IS NULL OR "name" IS NULL OR gender IS NULL) FROM users
UNION ALL
SELECT 'flights', 'flights_not_empty', count(*) > 0, CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT)
FROM flights
UNION ALL
SELECT 'flights', 'flights_no_nulls',
       count(*) FILTER (WHERE "travelCode" IS NULL OR "userCode" IS NULL OR price IS NULL) = 0,
       count(*) FILTER (WHERE "travelCode" IS NULL OR "userCode" IS NULL OR price IS NULL) FROM flights
UNION ALL
SELECT 'flights', 'prices_positive', count(*) FILTER (WHERE NOT coalesce(price > 0, false)) = 0,
       count(*) FILTER (WHERE NOT coalesce(price > 0, false)) FROM flights
UNION ALL
SELECT 'hotels', 'hotels_not_empty', count(*) > 0, CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT)
FROM hotels
""")
def q_validate_data(spark, sf):
    return Q.validate_data(*tables(spark, sf))


@query("preprocess", """
SELECT 'flights' AS "table", count(*) AS rows_before,
       count(*) FILTER (WHERE price IS NOT NULL AND price > 0) AS rows_after FROM flights
UNION ALL
SELECT 'hotels', count(*), count(*) FILTER (WHERE total IS NOT NULL AND total > 0) FROM hotels
""")
def q_preprocess(spark, sf):
    _, f, h = tables(spark, sf)
    return Q.preprocess(f, h)[2]


@query("staged_publish", """
, c AS (
  SELECT 'users' AS "table", 'users_not_empty' AS "check", CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS bad_rows, count(*) AS rows_before,
         count(*) AS rows_after, true AS required FROM users
  UNION ALL SELECT 'users', 'users_no_nulls', count(*) FILTER (WHERE code IS NULL OR "name" IS NULL OR gender IS NULL), count(*), count(*), true FROM users
  UNION ALL SELECT 'flights', 'flights_not_empty', CASE WHEN count(*) > 0 THEN 0 ELSE 1 END, count(*), count(*) FILTER (WHERE coalesce(price > 0, false)), true FROM flights
  UNION ALL SELECT 'flights', 'flights_no_nulls', count(*) FILTER (WHERE "travelCode" IS NULL OR "userCode" IS NULL OR price IS NULL), count(*),
         count(*) FILTER (WHERE coalesce(price > 0, false)), true FROM flights
  UNION ALL SELECT 'flights', 'prices_positive', count(*) FILTER (WHERE NOT coalesce(price > 0, false)), count(*), count(*) FILTER (WHERE coalesce(price > 0, false)), true FROM flights
  UNION ALL SELECT 'hotels', 'hotels_not_empty', CASE WHEN count(*) > 0 THEN 0 ELSE 1 END, count(*), count(*) FILTER (WHERE coalesce(total > 0, false)), true FROM hotels
  UNION ALL SELECT 'hotels', 'totals_positive', count(*) FILTER (WHERE NOT coalesce(total > 0, false)), count(*), count(*) FILTER (WHERE coalesce(total > 0, false)), false FROM hotels)
SELECT "table", "check", bad_rows = 0 AS passed, CAST(bad_rows AS BIGINT) AS bad_rows, rows_before, rows_after,
       (SELECT count(*) FROM c WHERE required AND bad_rows > 0) = 0 AS published FROM c
""")
def q_staged_publish(spark, sf):
    """The daily publication: checks and row counts observed on the one write of each table."""
    report, published = staged.publish(spark, staged.booking_sources(*tables(spark, sf)),
                                       f"{sinks.scratch_dir(spark)}/published-{uuid.uuid4().hex}")
    return report.drop("run").withColumn("published", F.lit(published))


def _describe_sql(table, cols):
    parts = []
    for c in cols:
        x = f'CAST("{c}" AS DOUBLE)'
        parts.append(f"""
SELECT '{c}' AS "column", count({x}) AS "count", {sstable(f'avg({x})')} AS mean,
       {sstable(f'stddev_samp({x})')} AS std, min({x}) AS "min",
       {sstable(f'quantile_cont({x}, 0.25)')} AS p25, {sstable(f'quantile_cont({x}, 0.5)')} AS p50,
       {sstable(f'quantile_cont({x}, 0.75)')} AS p75, max({x}) AS "max" FROM {table}""")
    return "\nUNION ALL".join(parts)


@query("describe", _describe_sql("flights", _FLIGHT_COLS))
def q_describe(spark, sf):
    _, f, _ = tables(spark, sf)
    d = Q.describe(f, _FLIGHT_COLS)
    return d.select("column", "count", stable("mean").alias("mean"), stable("std").alias("std"), "min",
                    stable("p25").alias("p25"), stable("p50").alias("p50"), stable("p75").alias("p75"), "max")


@query("missing_counts", """
SELECT "column", missing FROM (
  SELECT 'travelCode' AS "column", count(*) FILTER (WHERE "travelCode" IS NULL) AS missing FROM flights
  UNION ALL SELECT 'userCode', count(*) FILTER (WHERE "userCode" IS NULL) FROM flights
  UNION ALL SELECT 'from', count(*) FILTER (WHERE "from" IS NULL) FROM flights
  UNION ALL SELECT 'to', count(*) FILTER (WHERE "to" IS NULL) FROM flights
  UNION ALL SELECT 'flightType', count(*) FILTER (WHERE "flightType" IS NULL) FROM flights
  UNION ALL SELECT 'price', count(*) FILTER (WHERE price IS NULL OR isnan(price)) FROM flights
  UNION ALL SELECT 'time', count(*) FILTER (WHERE "time" IS NULL OR isnan("time")) FROM flights
  UNION ALL SELECT 'distance', count(*) FILTER (WHERE distance IS NULL) FROM flights
  UNION ALL SELECT 'agency', count(*) FILTER (WHERE agency IS NULL) FROM flights
  UNION ALL SELECT 'date', count(*) FILTER (WHERE "date" IS NULL) FROM flights
  UNION ALL SELECT 'route_cut', count(*) FILTER (WHERE route_cut IS NULL) FROM (
      SELECT CASE WHEN distance > 1000 THEN "from" END AS route_cut FROM flights)) WHERE missing > 0
""")
def q_missing_counts(spark, sf):
    _, f, _ = tables(spark, sf)
    # a derived column that is NULL for short flights, so the report is not empty
    g = f.withColumn("route_cut", F.when(F.col("distance") > 1000, F.col("from")))
    return Q.missing_counts(g)


@query("dataset_info", """
SELECT 'flights' AS "table", count(*) AS "rows", 10 AS "columns",
       'travelCode,userCode,from,to,flightType,price,time,distance,agency,date' AS column_list FROM flights
""")
def q_dataset_info(spark, sf):
    _, f, _ = tables(spark, sf)
    return Q.dataset_info(f, "flights")


@query("audit_flights", """
SELECT 'flights' AS "table", "check", bad_rows = 0 AS passed, bad_rows FROM (
  SELECT 'from_differs_to' AS "check", count(*) FILTER (WHERE NOT coalesce("from" <> "to", false)) AS bad_rows FROM flights
  UNION ALL SELECT 'distance_in_range', count(*) FILTER (WHERE NOT coalesce(distance >= 500 AND distance <= 5000, false)) FROM flights
  UNION ALL SELECT 'time_matches_distance', count(*) FILTER (WHERE NOT coalesce(
      ("time" - distance / 500) >= 0.5 - 0.01 AND ("time" - distance / 500) <= 2.0 + 0.01, false)) FROM flights
  UNION ALL SELECT 'price_in_class_band', count(*) FILTER (WHERE NOT coalesce(CASE
      WHEN "flightType" = 'economic' THEN price / (0.15 * distance) >= 0.8 - 0.01 AND price / (0.15 * distance) <= 1.2 + 0.01
      WHEN "flightType" = 'business' THEN price / (0.15 * distance) >= 1.5 - 0.01 AND price / (0.15 * distance) <= 2.5 + 0.01
      WHEN "flightType" = 'firstClass' THEN price / (0.15 * distance) >= 2.5 - 0.01 AND price / (0.15 * distance) <= 4.0 + 0.01
      END, false)) FROM flights)
""")
def q_audit_flights(spark, sf):
    _, f, _ = tables(spark, sf)
    return Q.audit_flights(f)


@query("audit_hotels", """
, dest AS (SELECT DISTINCT "travelCode", "to" AS dest FROM flights WHERE "travelCode" IS NOT NULL AND "to" IS NOT NULL),
hj AS (SELECT h.*, d.dest IS NOT NULL AS matched FROM hotels h
       LEFT JOIN dest d ON h."travelCode" = d."travelCode" AND h.place = d.dest)
SELECT 'hotels' AS "table", "check", bad_rows = 0 AS passed, bad_rows FROM (
  SELECT 'total_matches_days_price' AS "check",
         count(*) FILTER (WHERE NOT coalesce(abs(total - "days" * price) <= 0.005 * "days" + 0.005, false)) AS bad_rows FROM hj
  UNION ALL SELECT 'days_in_range', count(*) FILTER (WHERE NOT coalesce("days" >= 1 AND "days" <= 14, false)) FROM hj
  UNION ALL SELECT 'price_in_range', count(*) FILTER (WHERE NOT coalesce(price >= 80 AND price <= 500, false)) FROM hj
  UNION ALL SELECT 'place_is_flight_destination', count(*) FILTER (WHERE NOT matched) FROM hj)
""")
def q_audit_hotels(spark, sf):
    _, f, h = tables(spark, sf)
    return Q.audit_hotels(h, f)


@query("write_processed", """
SELECT 'users' AS "table", count(*) AS "rows", coalesce(CAST(sum(CAST(age AS DECIMAL(38,2))) AS DOUBLE), 0) AS checksum
FROM users
UNION ALL
SELECT 'flights', count(*), coalesce(CAST(sum(CAST(price AS DECIMAL(38,2))) AS DOUBLE), 0)
FROM flights WHERE price IS NOT NULL AND price > 0
UNION ALL
SELECT 'hotels', count(*), coalesce(CAST(sum(CAST(total AS DECIMAL(38,2))) AS DOUBLE), 0)
FROM hotels WHERE total IS NOT NULL AND total > 0
""")
def q_write_processed(spark, sf):
    u, f, h = tables(spark, sf)
    cf, ch, _ = Q.preprocess(f, h)
    out = os.path.join(sinks.scratch_dir(spark), f"processed-{uuid.uuid4().hex}")
    sinks.write_processed({"users": u, "flights": cf, "hotels": ch}, out)
    back = sinks.read_processed(spark, out)
    return sinks.processed_summary(back)
