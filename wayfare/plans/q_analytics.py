"""Registered dashboard-analytics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import stable
from ..operators import analytics as an
from ..sources import adapters as A
from ..sources.tables import table_counts
from .catalog import query, tables
from .oracle import eavg, esum, stable as sstable


@query("scan_tables", """
SELECT 'users' AS "table", count(*) AS "rows" FROM users
UNION ALL SELECT 'flights', count(*) FROM flights
UNION ALL SELECT 'hotels', count(*) FROM hotels
""")
def q_scan_tables(spark, sf):
    u, f, h = tables(spark, sf)
    return table_counts(users=u, flights=f, hotels=h)


@query("summary_metrics", f"""
SELECT (SELECT count(*) FROM users) AS total_users,
       count(*) AS total_flights,
       (SELECT count(*) FROM hotels) AS total_hotel_bookings,
       {eavg('price')} AS avg_flight_price
FROM flights
""")
def q_summary_metrics(spark, sf):
    return an.summary_metrics(*tables(spark, sf))


@query("kpi_metrics", f"""
SELECT coalesce({esum('price')}, 0) + coalesce((SELECT {esum('total')} FROM hotels), 0) AS total_revenue,
       {eavg('price')} AS avg_ticket_price,
       (SELECT {eavg('total')} FROM hotels) AS avg_hotel_spend,
       (SELECT count(DISTINCT code) FROM users) AS active_users
FROM flights
""")
def q_kpi_metrics(spark, sf):
    return an.kpi_metrics(*tables(spark, sf))


@query("category_share", """
SELECT gender, count(*) AS "count", count(*) / sum(count(*)) OVER () AS share
FROM users WHERE gender IS NOT NULL GROUP BY gender
""")
def q_category_share(spark, sf):
    u, _, _ = tables(spark, sf)
    return an.category_share(u, "gender")


@query("category_share_gender", """
SELECT gender, count(*) AS "count", count(*) / sum(count(*)) OVER () AS share
FROM users WHERE gender IS NOT NULL GROUP BY gender
""")
def q_share_gender(spark, sf):
    u, _, _ = tables(spark, sf)
    return an.category_share(u, "gender")


@query("category_share_flight_type", """
SELECT "flightType", count(*) AS "count", count(*) / sum(count(*)) OVER () AS share
FROM flights WHERE "flightType" IS NOT NULL GROUP BY "flightType"
""")
def q_share_type(spark, sf):
    _, f, _ = tables(spark, sf)
    return an.category_share(f, "flightType")


@query("revenue_by_type", f"""
SELECT "flightType", {esum('price')} AS revenue,
       {sstable(esum('price') + ' / sum(' + esum('price') + ') OVER ()', 9)} AS share
FROM flights WHERE "flightType" IS NOT NULL GROUP BY "flightType"
""")
def q_revenue_by_type(spark, sf):
    _, f, _ = tables(spark, sf)
    return an.revenue_by_type(f).withColumn("share", stable("share", 9))


def _top_sql(table, column):
    return f"""
SELECT {column}, count(*) AS "count" FROM {table} WHERE {column} IS NOT NULL
GROUP BY {column} ORDER BY "count" DESC, {column} ASC LIMIT 10
"""


@query("top_companies", _top_sql("users", "company"))
def q_top_companies(spark, sf):
    u, _, _ = tables(spark, sf)
    return an.top_companies(u)


@query("top_hotel_names", _top_sql("hotels", '"name"'))
def q_top_hotel_names(spark, sf):
    _, _, h = tables(spark, sf)
    return an.top_hotel_names(h)


@query("top_places", _top_sql("hotels", "place"))
def q_top_places(spark, sf):
    _, _, h = tables(spark, sf)
    return an.top_places(h)


@query("gender_distribution", """
SELECT gender, count(*) AS "count" FROM users WHERE gender IS NOT NULL GROUP BY gender
""")
def q_gender_distribution(spark, sf):
    u, _, _ = tables(spark, sf)
    return an.gender_distribution(u)


@query("monthly_avg_price", f"""
SELECT CAST(month("date") AS INTEGER) AS "month", {eavg('price')} AS avg_price
FROM flights WHERE "date" IS NOT NULL GROUP BY 1
""")
def q_monthly_avg_price(spark, sf):
    _, f, _ = tables(spark, sf)
    return an.monthly_avg_price(f)


@query("monthly_trend", f"""
SELECT strftime("date", '%Y-%m') AS "month", count("travelCode") AS bookings,
       coalesce({esum('price')}, 0) AS revenue
FROM flights WHERE "date" IS NOT NULL GROUP BY 1
""")
def q_monthly_trend(spark, sf):
    _, f, _ = tables(spark, sf)
    return an.monthly_trend(f)


@query("top_routes", f"""
SELECT "from" || ' → ' || "to" AS route, count(price) AS bookings,
       coalesce({esum('price')}, 0) AS revenue
FROM flights WHERE "from" IS NOT NULL AND "to" IS NOT NULL
GROUP BY 1 ORDER BY bookings DESC, route ASC LIMIT 10
""")
def q_top_routes(spark, sf):
    _, f, _ = tables(spark, sf)
    return an.top_routes(f)


@query("user_spending", f"""
SELECT u.*, coalesce(s.total_spent, 0) AS total_spent
FROM users u LEFT JOIN (
  SELECT "userCode", {esum('price')} AS total_spent FROM flights
  WHERE "userCode" IS NOT NULL GROUP BY "userCode") s ON u.code = s."userCode"
""")
def q_user_spending(spark, sf):
    u, f, _ = tables(spark, sf)
    return an.user_spending(u, f)


_SPEND = f"""
spend AS (
  SELECT u.*, coalesce(s.total_spent, 0) AS total_spent
  FROM users u LEFT JOIN (
    SELECT "userCode", {esum('price')} AS total_spent FROM flights
    WHERE "userCode" IS NOT NULL GROUP BY "userCode") s ON u.code = s."userCode"),
grouped AS (
  SELECT CASE WHEN age > 0 AND age <= 25 THEN '18-25' WHEN age > 25 AND age <= 35 THEN '26-35'
              WHEN age > 35 AND age <= 45 THEN '36-45' WHEN age > 45 AND age <= 55 THEN '46-55'
              WHEN age > 55 AND age <= 100 THEN '55+' END AS age_group, gender, total_spent
  FROM spend)
"""


@query("spend_by_age", f"""
, {_SPEND.strip()}
SELECT l.age_group, {sstable('g.avg_spent')} AS avg_spent
FROM (VALUES ('18-25'), ('26-35'), ('36-45'), ('46-55'), ('55+')) l(age_group)
LEFT JOIN (SELECT age_group, avg(total_spent) AS avg_spent FROM grouped
           WHERE age_group IS NOT NULL GROUP BY age_group) g ON l.age_group = g.age_group
""")
def q_spend_by_age(spark, sf):
    u, f, _ = tables(spark, sf)
    return an.spend_by_age(u, f).select("age_group", stable("avg_spent").alias("avg_spent"))


@query("spend_by_gender", f"""
, {_SPEND.strip()}
SELECT gender, {sstable('avg(total_spent)')} AS avg_spent
FROM grouped WHERE gender IS NOT NULL GROUP BY gender
""")
def q_spend_by_gender(spark, sf):
    u, f, _ = tables(spark, sf)
    return an.spend_by_gender(u, f).select("gender", stable("avg_spent").alias("avg_spent"))


def _hist_sql(table, column, bins):
    return f"""
SELECT b.bin, CAST(s.lo + b.bin * ((s.hi - s.lo) / {bins}) AS DOUBLE) AS bin_start,
       CAST(s.lo + (b.bin + 1) * ((s.hi - s.lo) / {bins}) AS DOUBLE) AS bin_end,
       coalesce(c.cnt, 0) AS "count"
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) b
CROSS JOIN (SELECT min({column}) AS lo, max({column}) AS hi FROM {table}) s
LEFT JOIN (
  SELECT CAST(CASE WHEN s.hi = s.lo THEN 0
              ELSE least(floor(({column} - s.lo) / ((s.hi - s.lo) / {bins})), {bins - 1}) END AS INTEGER) AS bin,
         count(*) AS cnt
  FROM {table}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {table}) s
  WHERE {column} IS NOT NULL GROUP BY 1) c ON b.bin = c.bin
"""


@query("age_histogram", _hist_sql("users", "age", 20))
def q_age_histogram(spark, sf):
    u, _, _ = tables(spark, sf)
    return an.age_histogram(u, 20)


@query("hotel_price_histogram", _hist_sql("hotels", "price", 30))
def q_hotel_price_histogram(spark, sf):
    _, _, h = tables(spark, sf)
    return an.hotel_price_histogram(h, 30)


@query("price_box", f"""
, q AS (
  SELECT "flightType", count(price) AS n, min(price) AS "min", max(price) AS "max",
         quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
         quantile_cont(price, 0.75) AS q3
  FROM flights WHERE "flightType" IS NOT NULL AND price IS NOT NULL GROUP BY 1),
f AS (SELECT q.*, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT f."flightType", n, "min", "max", {sstable('q1')} AS q1, {sstable('median')} AS median,
       {sstable('q3')} AS q3, {sstable('iqr')} AS iqr,
       min(CASE WHEN price >= lower_fence AND price <= upper_fence THEN price END) AS lower_whisker,
       max(CASE WHEN price >= lower_fence AND price <= upper_fence THEN price END) AS upper_whisker,
       count(*) FILTER (WHERE NOT (price >= lower_fence AND price <= upper_fence)) AS outliers
FROM f JOIN flights x ON x."flightType" = f."flightType" AND x.price IS NOT NULL
GROUP BY f."flightType", n, "min", "max", q1, median, q3, iqr
""")
def q_price_box(spark, sf):
    _, f, _ = tables(spark, sf)
    b = an.price_box(f)
    return b.select("flightType", "n", "min", "max", stable("q1").alias("q1"),
                    stable("median").alias("median"), stable("q3").alias("q3"),
                    stable("iqr").alias("iqr"), "lower_whisker", "upper_whisker", "outliers")


@query("distinct_values", """
SELECT 'from' AS field, "from" AS value FROM flights WHERE "from" IS NOT NULL
UNION SELECT 'to', "to" FROM flights WHERE "to" IS NOT NULL
UNION SELECT 'agency', agency FROM flights WHERE agency IS NOT NULL
UNION SELECT 'company', company FROM users WHERE company IS NOT NULL
UNION SELECT 'place', place FROM hotels WHERE place IS NOT NULL
""")
def q_distinct_values(spark, sf):
    u, f, h = tables(spark, sf)
    parts = [an.distinct_values_by_column(df, cols) for df, cols in ((f, ["from", "to", "agency"]), (u, ["company"]), (h, ["place"]))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select(F.col("column").alias("field"), "value")


@query("known_cities", """
SELECT "from" AS city FROM flights WHERE "from" IS NOT NULL
UNION SELECT "to" FROM flights WHERE "to" IS NOT NULL
""")
def q_known_cities(spark, sf):
    _, f, _ = tables(spark, sf)
    return an.known_cities(f)


_PRICE_REQ = """
pr0 AS (
  SELECT "travelCode" AS request_id, min("from") AS "from", min("to") AS "to",
         min("flightType") AS "flightType", min(agency) AS agency, min("time") AS "time",
         min(distance) AS distance, min("date") AS "date"
  FROM flights GROUP BY "travelCode"),
price_requests AS (
  SELECT request_id,
         CASE WHEN request_id % 223 = 13 THEN NULL WHEN request_id % 97 = 3 THEN 'Atlantis' ELSE "from" END AS "from",
         CASE WHEN request_id % 83 = 6 THEN 'Lemuria' WHEN request_id % 227 = 17 THEN NULL ELSE "to" END AS "to",
         CASE WHEN request_id % 101 = 7 THEN 'economy' ELSE "flightType" END AS "flightType",
         CASE WHEN request_id % 7 = 0 THEN NULL WHEN request_id % 89 = 5 THEN 'NewCo' ELSE agency END AS agency,
         CASE WHEN request_id % 5 = 0 THEN NULL ELSE "time" END AS "time",
         CASE WHEN request_id % 211 = 11 THEN NULL ELSE distance END AS distance,
         CASE WHEN request_id % 3 = 0 THEN NULL ELSE CAST(month("date") AS INTEGER) END AS "month",
         CASE WHEN request_id % 3 = 0 THEN NULL ELSE CAST(isodow("date") - 1 AS INTEGER) END AS day_of_week,
         CASE WHEN request_id % 3 = 0 THEN NULL ELSE CAST(isodow("date") >= 6 AS INTEGER) END AS is_weekend
  FROM pr0)
"""


@query("unknown_city", f"""
, {_PRICE_REQ.strip()}
SELECT r.*, s.field, s.city
FROM price_requests r, LATERAL (VALUES ('from', r."from"), ('to', r."to")) s(field, city)
WHERE s.city IS NOT NULL AND s.city <> ''
  AND s.city NOT IN (SELECT "from" FROM flights WHERE "from" IS NOT NULL UNION SELECT "to" FROM flights WHERE "to" IS NOT NULL)
""")
def q_unknown_city(spark, sf):
    _, f, _ = tables(spark, sf)
    return an.unknown_cities(A.price_requests(f), f)


@query("similar_flights", f"""
, {_PRICE_REQ.strip()},
br AS (SELECT "from", "flightType", {eavg('price')} AS m1, count(price) AS n1
       FROM flights WHERE price IS NOT NULL GROUP BY 1, 2),
bt AS (SELECT "flightType", {eavg('price')} AS m2 FROM flights WHERE price IS NOT NULL GROUP BY 1)
SELECT r.*,
       CASE WHEN coalesce(br.n1, 0) > 0 THEN 'route' WHEN bt.m2 IS NOT NULL THEN 'type' END AS basis,
       CASE WHEN coalesce(br.n1, 0) > 0 THEN br.m1 ELSE bt.m2 END AS similar_avg_price,
       CASE WHEN coalesce(br.n1, 0) > 0 THEN r.predicted_price - br.m1 END AS difference
FROM (SELECT *, floor(distance * 0.15 * 100 + 0.5) / 100 AS predicted_price FROM price_requests) r
LEFT JOIN br ON r."from" = br."from" AND r."flightType" = br."flightType"
LEFT JOIN bt ON r."flightType" = bt."flightType"
""")
def q_similar_flights(spark, sf):
    _, f, _ = tables(spark, sf)
    # A prediction by a fixed rule, so that the difference to it has an SQL form.
    asked = A.price_requests(f).withColumn("predicted_price", A.round2(F.col("distance") * 0.15))
    return an.similar_flights(asked, f, "predicted_price")


@query("head_preview", """
SELECT * FROM flights ORDER BY "travelCode", "userCode", "from", "to", "flightType", price,
  "time", distance, agency, "date" LIMIT 20
""")
def q_head_preview(spark, sf):
    _, f, _ = tables(spark, sf)
    return an.head_preview(f, f.columns)


@query("sample_points", """
SELECT distance, price, "flightType" FROM flights
ORDER BY ((("travelCode" % 1000003) + 1000003) % 1000003 * 7919 + 42) % 1000003,
         distance, price, "flightType"
LIMIT 500
""")
def q_sample_points(spark, sf):
    _, f, _ = tables(spark, sf)
    return an.sample_points(f)
