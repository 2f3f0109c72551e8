"""Registered feature, join and scalar queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.scalar import stable
from ..ml.scale import standard_scale
from ..ml.split import split_flag
from ..operators import dictionary as D
from ..operators import features as FT
from ..operators import requests as R
from ..operators import state as ST
from ..operators import recommend as RC
from ..session import shared_folder, written
from ..sources import adapters as A
from .catalog import query, tables
from .oracle import eavg, esum, stable as sstable
from .q_analytics import _PRICE_REQ

FA_SQL = f"""
fa AS (
  SELECT "userCode", {eavg('price')} AS avg_flight_price,
         coalesce({esum('price')}, 0) AS total_flight_spent, count(price) AS flight_count,
         stddev_samp(price) AS flight_price_std, avg(distance) AS avg_distance,
         CAST(coalesce(sum(distance), 0) AS BIGINT) AS total_distance,
         {eavg('"time"')} AS avg_flight_time, coalesce({esum('"time"')}, 0) AS total_flight_time,
         count(*) FILTER (WHERE "flightType" = 'firstClass') AS first_class_count
  FROM flights WHERE "userCode" IS NOT NULL GROUP BY "userCode")
"""
HA_SQL = f"""
ha AS (
  SELECT "userCode", {eavg('total')} AS avg_hotel_total,
         coalesce({esum('total')}, 0) AS total_hotel_spent, count(total) AS hotel_booking_count,
         avg("days") AS avg_stay_days, CAST(coalesce(sum("days"), 0) AS BIGINT) AS total_stay_days,
         {eavg('price')} AS avg_hotel_price_per_day
  FROM hotels WHERE "userCode" IS NOT NULL GROUP BY "userCode")
"""
FA_COLS = ["avg_flight_price", "total_flight_spent", "flight_count", "flight_price_std",
           "avg_distance", "total_distance", "avg_flight_time", "total_flight_time",
           "first_class_count"]
HA_COLS = ["avg_hotel_total", "total_hotel_spent", "hotel_booking_count", "avg_stay_days",
           "total_stay_days", "avg_hotel_price_per_day"]


@query("flight_agg", f"""
, {FA_SQL.strip()}
SELECT "userCode", avg_flight_price, total_flight_spent, flight_count,
       {sstable('flight_price_std')} AS flight_price_std, avg_distance, total_distance,
       avg_flight_time, total_flight_time, first_class_count FROM fa
""")
def q_flight_agg(spark, sf):
    _, f, _ = tables(spark, sf)
    return FT.flight_agg(f).withColumn("flight_price_std", stable("flight_price_std"))


@query("flight_state", f"""
, {FA_SQL.strip()}
SELECT "userCode", avg_flight_price, total_flight_spent, flight_count,
       {sstable('flight_price_std')} AS flight_price_std, avg_distance, total_distance,
       avg_flight_time, total_flight_time, first_class_count FROM fa
""")
def q_flight_state(spark, sf):
    """``flight_agg`` from mergeable state after three daily runs: an older half in
    which some days are wrong, the newer half, and the wrong days' corrections."""
    _, f, _ = tables(spark, sf)
    f = written(f, "flights")
    cut, odd = F.lit("1995-06-01").cast("date"), F.dayofmonth("date") == 13
    state = ST.FlightState(spark, f"{shared_folder(spark)}/flight-state-{uuid.uuid4().hex}")
    wrong = f.where(F.col("date") < cut).where(~(odd & (F.pmod("travelCode", F.lit(3)) == 0)))
    state.apply(wrong.withColumn("price", F.when(odd, F.col("price") * 2).otherwise(F.col("price"))))
    state.apply(f.where(F.col("date") >= cut))
    state.apply(f.where((F.col("date") < cut) & odd))
    return state.flight_agg().withColumn("flight_price_std", stable("flight_price_std"))


@query("hotel_agg", f", {HA_SQL.strip()}\nSELECT * FROM ha")
def q_hotel_agg(spark, sf):
    _, _, h = tables(spark, sf)
    return FT.hotel_agg(h)


def _fill(cols, prefix):
    return ", ".join(f"coalesce({prefix}.{c}, 0) AS {c}" if c != "flight_price_std"
                     else f"{sstable(f'coalesce({prefix}.{c}, 0)')} AS {c}" for c in cols)


@query("user_features", f"""
, {FA_SQL.strip()}, {HA_SQL.strip()}
SELECT u.code, u.company, u."name", u.gender, u.age, coalesce(fa."userCode", 0) AS "userCode",
       {_fill(FA_COLS, 'fa')}, {_fill(HA_COLS, 'ha')}
FROM users u LEFT JOIN fa ON u.code = fa."userCode" LEFT JOIN ha ON fa."userCode" = ha."userCode"
""")
def q_user_features(spark, sf):
    u, f, h = tables(spark, sf)
    return FT.user_features(u, f, h).withColumn("flight_price_std", stable("flight_price_std"))


@query("user_features_slim", f"""
, fs AS (SELECT "userCode", {eavg('price')} AS avg_price, coalesce({esum('price')}, 0) AS total_spent,
               count(price) AS flight_count, avg(distance) AS avg_distance
        FROM flights WHERE "userCode" IS NOT NULL GROUP BY 1),
hs AS (SELECT "userCode", {eavg('total')} AS avg_hotel, count(total) AS hotel_count, avg("days") AS avg_days
       FROM hotels WHERE "userCode" IS NOT NULL GROUP BY 1)
SELECT u.*, coalesce(fs."userCode", 0) AS "userCode", coalesce(avg_price, 0) AS avg_price,
       coalesce(total_spent, 0) AS total_spent, coalesce(flight_count, 0) AS flight_count,
       coalesce(avg_distance, 0) AS avg_distance, coalesce(avg_hotel, 0) AS avg_hotel,
       coalesce(hotel_count, 0) AS hotel_count, coalesce(avg_days, 0) AS avg_days
FROM users u LEFT JOIN fs ON u.code = fs."userCode" LEFT JOIN hs ON fs."userCode" = hs."userCode"
""")
def q_user_features_slim(spark, sf):
    return FT.user_features_slim(*tables(spark, sf))


@query("user_profiles", f"""
, ua AS (SELECT "userCode", {eavg('price')} AS avg_price, stddev_samp(price) AS price_std,
               avg("days") AS avg_days, CAST(coalesce(sum("days"), 0) AS BIGINT) AS total_days,
               {eavg('total')} AS avg_total, coalesce({esum('total')}, 0) AS total_spent
        FROM hotels WHERE "userCode" IS NOT NULL GROUP BY 1)
SELECT u.*, coalesce(ua."userCode", 0) AS "userCode", coalesce(avg_price, 0) AS avg_price,
       {sstable('coalesce(price_std, 0)')} AS price_std, coalesce(avg_days, 0) AS avg_days,
       coalesce(total_days, 0) AS total_days, coalesce(avg_total, 0) AS avg_total,
       coalesce(total_spent, 0) AS total_spent
FROM users u LEFT JOIN ua ON u.code = ua."userCode"
""")
def q_user_profiles(spark, sf):
    u, _, h = tables(spark, sf)
    return FT.user_profiles(u, h).withColumn("price_std", stable("price_std"))


@query("fill_missing", f"""
SELECT u.code, coalesce(s.n, 0) AS hotel_bookings, coalesce(s.spent, 0) AS hotel_spent
FROM users u LEFT JOIN (SELECT "userCode", count(*) AS n, {esum('total')} AS spent
                        FROM hotels GROUP BY 1) s ON u.code = s."userCode"
""")
def q_fill_missing(spark, sf):
    u, _, h = tables(spark, sf)
    s = h.where(F.col("userCode").isNotNull()).groupBy("userCode").agg(
        F.count(F.lit(1)).alias("hotel_bookings"), S.exact_sum("total").alias("hotel_spent"))
    return FT.fill_numeric(u.join(s, u.code == s.userCode, "left").select("code", "hotel_bookings", "hotel_spent"))


HOTEL_FEATURES_SQL = f"""
hi AS (SELECT "name" || '_' || place AS hotel_id, {eavg('price')} AS price, avg("days") AS "days",
              {eavg('total')} AS total, min(place) AS place, count(*) AS bookings
       FROM hotels WHERE "name" || '_' || place IS NOT NULL GROUP BY 1),
pdict AS (SELECT place AS value, CAST(row_number() OVER (ORDER BY place) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT place FROM hi WHERE place IS NOT NULL)),
hf0 AS (SELECT hi.*, coalesce(pdict.code, 0) AS place_encoded FROM hi LEFT JOIN pdict ON hi.place = pdict.value),
hst AS (SELECT avg(price) AS m1, CASE WHEN coalesce(stddev_pop(price), 0) = 0 THEN 1 ELSE stddev_pop(price) END AS s1,
               avg("days") AS m2, CASE WHEN coalesce(stddev_pop("days"), 0) = 0 THEN 1 ELSE stddev_pop("days") END AS s2,
               avg(total) AS m3, CASE WHEN coalesce(stddev_pop(total), 0) = 0 THEN 1 ELSE stddev_pop(total) END AS s3,
               avg(place_encoded) AS m4,
               CASE WHEN coalesce(stddev_pop(place_encoded), 0) = 0 THEN 1 ELSE stddev_pop(place_encoded) END AS s4
        FROM hf0),
hfeat AS (SELECT hf0.*, (price - m1) / s1 AS f_price, ("days" - m2) / s2 AS f_days,
                 (total - m3) / s3 AS f_total, (place_encoded - m4) / s4 AS f_place FROM hf0, hst)
"""


@query("hotel_features", f"""
, {HOTEL_FEATURES_SQL.strip()}
SELECT hotel_id, price, "days", total, place, bookings, place_encoded,
       {sstable('f_price', 9)} AS f_price, {sstable('f_days', 9)} AS f_days,
       {sstable('f_total', 9)} AS f_total, {sstable('f_place', 9)} AS f_place
FROM hfeat
""")
def q_hotel_features(spark, sf):
    _, _, h = tables(spark, sf)
    hf, _, _ = RC.hotel_features(h)
    return hf.select("hotel_id", "price", "days", "total", "place", "bookings", "place_encoded",
                     *[stable(c, 9).alias(c) for c in RC.FEATURES])


@query("hotel_info_lookup", f"""
, {HOTEL_FEATURES_SQL.strip()}
SELECT h."travelCode", h."userCode", h."name" || '_' || h.place AS hotel_id, hi.place AS hotel_place,
       hi.price AS avg_price
FROM hotels h JOIN hi ON h."name" || '_' || h.place = hi.hotel_id
""")
def q_hotel_info_lookup(spark, sf):
    _, _, h = tables(spark, sf)
    info = FT.hotel_info(h).select("hotel_id", F.col("place").alias("hotel_place"),
                                   F.col("price").alias("avg_price"))
    stays = FT.hotel_table(h).select("travelCode", "userCode", "hotel_id")
    return stays.join(info, "hotel_id").select("travelCode", "userCode", "hotel_id", "hotel_place", "avg_price")


@query("label_encode", """
SELECT 'from' AS field, value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT "from" AS value FROM flights WHERE "from" IS NOT NULL)
UNION ALL SELECT 'to', value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER)
  FROM (SELECT DISTINCT "to" AS value FROM flights WHERE "to" IS NOT NULL)
UNION ALL SELECT 'flightType', value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER)
  FROM (SELECT DISTINCT "flightType" AS value FROM flights WHERE "flightType" IS NOT NULL)
UNION ALL SELECT 'agency', value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER)
  FROM (SELECT DISTINCT agency AS value FROM flights WHERE agency IS NOT NULL)
UNION ALL SELECT 'company', value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER)
  FROM (SELECT DISTINCT company AS value FROM users WHERE company IS NOT NULL)
""")
def q_label_encode(spark, sf):
    u, f, _ = tables(spark, sf)
    both = D.distributed_dictionary(f, ["from", "to", "flightType", "agency"]).unionByName(D.distributed_dictionary(u, ["company"]))
    return both.select("field", "value", F.col("code").cast("int").alias("code"))


_ENC_SQL = """
dfrom AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT "from" AS value FROM flights WHERE "from" IS NOT NULL)),
dtype AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT "flightType" AS value FROM flights WHERE "flightType" IS NOT NULL)),
dagency AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code
            FROM (SELECT DISTINCT agency AS value FROM flights WHERE agency IS NOT NULL)),
enc AS (
  SELECT r.request_id, r."from", r."flightType", r.agency,
         coalesce(dfrom.code, 0) AS from_encoded, coalesce(dtype.code, 0) AS "flightType_encoded",
         coalesce(dagency.code, 0) AS agency_encoded
  FROM price_requests r
  LEFT JOIN dfrom ON r."from" = dfrom.value
  LEFT JOIN dtype ON r."flightType" = dtype.value
  LEFT JOIN dagency ON r.agency = dagency.value)
"""


def _encoded_requests(spark, sf):
    _, f, _ = tables(spark, sf)
    r = A.price_requests(f).select("request_id", "from", "flightType", "agency")
    columns = ["from", "flightType", "agency"]
    d = D.distributed_dictionary(f, columns)
    e = D.encode_by(r, d, columns)
    return d, e.select(*r.columns, *[F.col(f"{c}_encoded").cast("int").alias(f"{c}_encoded") for c in columns])


@query("encode_unseen", f", {_PRICE_REQ.strip()}, {_ENC_SQL.strip()}\nSELECT * FROM enc")
def q_encode_unseen(spark, sf):
    return _encoded_requests(spark, sf)[1]


@query("label_decode", f"""
, {_PRICE_REQ.strip()}, {_ENC_SQL.strip()}
SELECT enc.request_id, enc."flightType_encoded", dtype.value AS "flightType_label"
FROM enc LEFT JOIN dtype ON enc."flightType_encoded" = dtype.code
""")
def q_label_decode(spark, sf):
    dictionary, r = _encoded_requests(spark, sf)
    d = D.decode_by(r, dictionary, "flightType", "flightType_encoded", "flightType_label")
    return d.select("request_id", "flightType_encoded", "flightType_label")


@query("date_features", """
SELECT "travelCode", "date", CAST(month("date") AS INTEGER) AS "month",
       CAST(isodow("date") - 1 AS INTEGER) AS day_of_week,
       CAST(isodow("date") >= 6 AS INTEGER) AS is_weekend
FROM flights
""")
def q_date_features(spark, sf):
    _, f, _ = tables(spark, sf)
    return f.select("travelCode", "date", *S.date_features("date"))


@query("day_name_map", """
SELECT dayname("date") AS day_name,
       CAST(CASE dayname("date") WHEN 'Monday' THEN 0 WHEN 'Tuesday' THEN 1 WHEN 'Wednesday' THEN 2
            WHEN 'Thursday' THEN 3 WHEN 'Friday' THEN 4 WHEN 'Saturday' THEN 5 WHEN 'Sunday' THEN 6 END
            AS INTEGER) AS day_of_week,
       CAST(dayname("date") IN ('Saturday', 'Sunday') AS INTEGER) AS is_weekend,
       count(*) AS flights
FROM flights WHERE "date" IS NOT NULL GROUP BY 1, 2, 3
""")
def q_day_name_map(spark, sf):
    _, f, _ = tables(spark, sf)
    dn = F.date_format("date", "EEEE")
    idx = S.day_name_to_index(dn)
    return (f.where(F.col("date").isNotNull())
             .groupBy(dn.alias("day_name"), idx.alias("day_of_week"),
                      idx.isin(5, 6).cast("int").alias("is_weekend"))
             .agg(F.count(F.lit(1)).alias("flights")))


@query("parse_dates", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date_text,
       CAST(strptime(strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS "date"
FROM orders
""")
def q_parse_dates(spark, sf):
    """Order dates rendered as text (as in the CSV sources) and parsed back."""
    o = A.base(spark, sf, "orders")
    txt = F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd")
    return o.select("o_orderkey", txt.alias("date_text"), S.parse_date(txt).alias("date"))


@query("month_bucket", """
SELECT "travelCode", "date", strftime("date", '%Y-%m') AS month_year FROM flights
""")
def q_month_bucket(spark, sf):
    _, f, _ = tables(spark, sf)
    return f.select("travelCode", "date", S.month_bucket("date").alias("month_year"))


@query("route_concat", """
SELECT "travelCode", "from", "to", "from" || ' → ' || "to" AS route FROM flights
""")
def q_route_concat(spark, sf):
    _, f, _ = tables(spark, sf)
    return f.select("travelCode", "from", "to", S.route("from", "to").alias("route"))


@query("hotel_id", """
SELECT DISTINCT "name" || '_' || place AS hotel_id, split_part("name" || '_' || place, '_', 1) AS hotel_name,
       place FROM hotels
""")
def q_hotel_id(spark, sf):
    _, _, h = tables(spark, sf)
    hid = S.hotel_id("name", "place")
    return h.select(hid.alias("hotel_id"), S.hotel_name_from_id(hid).alias("hotel_name"), "place").distinct()


@query("age_group", """
SELECT code, age, CASE WHEN age > 0 AND age <= 25 THEN '18-25' WHEN age > 25 AND age <= 35 THEN '26-35'
                       WHEN age > 35 AND age <= 45 THEN '36-45' WHEN age > 45 AND age <= 55 THEN '46-55'
                       WHEN age > 55 AND age <= 100 THEN '55+' END AS age_group
FROM users
""")
def q_age_group(spark, sf):
    u, _, _ = tables(spark, sf)
    return u.select("code", "age", S.age_group("age").alias("age_group"))


@query("clean_flights", "SELECT * FROM flights WHERE price IS NOT NULL AND price > 0")
def q_clean_flights(spark, sf):
    from ..operators.quality import clean_positive
    _, f, _ = tables(spark, sf)
    return clean_positive(f, "price")


@query("clean_hotels", "SELECT * FROM hotels WHERE total IS NOT NULL AND total > 0")
def q_clean_hotels(spark, sf):
    from ..operators.quality import clean_positive
    _, _, h = tables(spark, sf)
    return clean_positive(h, "total")


@query("request_validate", f"""
, {_PRICE_REQ.strip()}
SELECT request_id, CASE WHEN "from" IS NULL THEN 'Missing required field: from'
                        WHEN "to" IS NULL THEN 'Missing required field: to'
                        WHEN "flightType" IS NULL THEN 'Missing required field: flightType'
                        WHEN distance IS NULL THEN 'Missing required field: distance' END AS error
FROM price_requests
""")
def q_request_validate(spark, sf):
    _, f, _ = tables(spark, sf)
    return R.request_validate(A.price_requests(f)).select("request_id", "error")


@query("request_defaults", f"""
, {_PRICE_REQ.strip()}
SELECT request_id, "from", "to", "flightType", coalesce(agency, 'Unknown') AS agency,
       coalesce("time", distance / 500) AS "time", distance, coalesce("month", 6) AS "month",
       coalesce(day_of_week, 2) AS day_of_week, coalesce(is_weekend, 0) AS is_weekend
FROM price_requests
WHERE "from" IS NOT NULL AND "to" IS NOT NULL AND "flightType" IS NOT NULL AND distance IS NOT NULL
""")
def q_request_defaults(spark, sf):
    _, f, _ = tables(spark, sf)
    return R.request_defaults(R.accepted(R.request_validate(A.price_requests(f))))


REC_REQ_SQL = """
rec_requests AS (
  SELECT code AS request_id, code AS user_code,
         CASE WHEN code % 3 = 0 THEN 'collaborative' WHEN code % 3 = 1 THEN 'content' ELSE 'hybrid' END AS method,
         5 AS n_recommendations,
         CASE WHEN code % 4 = 0 THEN
           {'price': CASE WHEN code % 8 = 4 THEN NULL ELSE CAST(80 + code % 420 AS DOUBLE) END,
            'days': CAST(1 + code % 14 AS DOUBLE),
            'total': CAST(80 + code % 420 AS DOUBLE) * CAST(1 + code % 14 AS DOUBLE),
            'place': CASE WHEN code % 12 = 8 THEN 'Atlantis' ELSE n.n_name END} END AS preferences
  FROM users LEFT JOIN nation n ON code % 25 = n.n_nationkey)
"""
BUDGET_REQ_SQL = """
budget_requests AS (
  SELECT code AS request_id, CAST(50 + code % 450 AS DOUBLE) AS budget,
         CAST(1 + code % 14 AS INTEGER) AS stay_days,
         CASE WHEN code % 2 = 0 THEN 'Any' ELSE n.n_name END AS destination
  FROM users LEFT JOIN nation n ON code % 25 = n.n_nationkey)
"""


def rec_requests(spark, sf):
    u = A.users(spark, sf)
    return A.rec_requests(u, A.base(spark, sf, "nation"))


def budget_requests(spark, sf):
    u = A.users(spark, sf)
    return A.budget_requests(u, A.base(spark, sf, "nation"))


@query("preference_defaults", f"""
, {REC_REQ_SQL.strip()}
SELECT request_id, coalesce(preferences.price, 200.0) AS pref_price,
       coalesce(preferences.days, 3.0) AS pref_days, coalesce(preferences.total, 600.0) AS pref_total,
       preferences.place AS pref_place
FROM rec_requests
""")
def q_preference_defaults(spark, sf):
    return R.preference_defaults(rec_requests(spark, sf)).select(
        "request_id", "pref_price", "pref_days", "pref_total", "pref_place")


@query("budget_vector", f"""
, {BUDGET_REQ_SQL.strip()}
SELECT request_id, budget AS pref_price, CAST(stay_days AS DOUBLE) AS pref_days,
       budget * stay_days AS pref_total, 0 AS pref_place_encoded
FROM budget_requests
""")
def q_budget_vector(spark, sf):
    return R.budget_vector(budget_requests(spark, sf)).select(
        "request_id", "pref_price", "pref_days", "pref_total", "pref_place_encoded")


SPLIT_SQL = '(((("travelCode" % 1000003) + 1000003) % 1000003 * 7919 + 42) % 1000003) % 100 < 80'


@query("standard_scale", f"""
, st AS (SELECT avg("time") AS mt,
                CASE WHEN coalesce(stddev_pop("time"), 0) = 0 THEN 1 ELSE stddev_pop("time") END AS stt,
                avg(distance) AS md,
                CASE WHEN coalesce(stddev_pop(distance), 0) = 0 THEN 1 ELSE stddev_pop(distance) END AS sd
         FROM flights WHERE {SPLIT_SQL})
SELECT "travelCode", {SPLIT_SQL} AS is_train,
       {sstable('("time" - mt) / stt', 9)} AS time_scaled,
       {sstable('(distance - md) / sd', 9)} AS distance_scaled
FROM flights, st
""")
def q_standard_scale(spark, sf):
    _, f, _ = tables(spark, sf)
    f = f.select("travelCode", "time", "distance", split_flag("travelCode").alias("is_train"))
    _, _, scaled = standard_scale(f.where("is_train"), ["time", "distance"], f)
    return scaled.select("travelCode", "is_train", stable("time_scaled", 9).alias("time_scaled"),
                         stable("distance_scaled", 9).alias("distance_scaled"))


@query("round_price", """
SELECT "travelCode", price, round(price / 3, 2) AS price_third FROM flights
""")
def q_round_price(spark, sf):
    _, f, _ = tables(spark, sf)
    return f.select("travelCode", "price", S.round_price(F.col("price") / 3).alias("price_third"))


@query("user_history", """
SELECT "userCode", "name", place, "days", total, "date" FROM (
  SELECT *, row_number() OVER (PARTITION BY "userCode"
                               ORDER BY "date", "travelCode", "name", place, "days", total) AS rn
  FROM hotels WHERE "userCode" IS NOT NULL) WHERE rn <= 5
""")
def q_user_history(spark, sf):
    from ..operators.recommend import user_history
    _, _, h = tables(spark, sf)
    return user_history(h, 5)
