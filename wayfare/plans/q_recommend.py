"""Registered recommender queries.

Requests: one per user (the whole users table), see ``rec_requests`` and
``budget_requests`` in ``q_features``. The SQL oracles compute cosine by a
self-join on the hotel (the plain definition); the Spark plans use the
blocked exact kernel. Scores are rounded to 9 decimals on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import recommend as RC
from .catalog import query, tables
from .oracle import eavg, esum
from .q_features import BUDGET_REQ_SQL, HOTEL_FEATURES_SQL, REC_REQ_SQL, budget_requests, rec_requests


def r9(x: str) -> str:
    return f"(floor(({x}) * 1000000000 + 0.5) / 1000000000)"


RATINGS_SQL = f"""
pairs AS (SELECT "userCode" AS u, "name" || '_' || place AS h, {esum('total')} AS spend
          FROM hotels WHERE "userCode" IS NOT NULL AND "name" || '_' || place IS NOT NULL
            AND total IS NOT NULL GROUP BY 1, 2),
ratings AS (SELECT u, h, spend,
                   spend / CASE WHEN rs = 0 THEN 1 ELSE rs END AS rating
            FROM (SELECT *, CAST(sum(CAST(spend AS DECIMAL(38,2))) OVER (PARTITION BY u) AS DOUBLE) AS rs
                  FROM pairs))
"""

NEIGHBOURS_SQL = f"""
norms AS (SELECT u, sqrt(sum(rating * rating)) AS nr FROM ratings GROUP BY u),
dots AS (SELECT a.u, b.u AS v, sum(a.rating * b.rating) AS dot
         FROM ratings a JOIN ratings b ON a.h = b.h AND a.u <> b.u GROUP BY 1, 2),
cos AS (SELECT d.u, d.v, {r9('CASE WHEN na.nr * nb.nr = 0 THEN 0 ELSE d.dot / (na.nr * nb.nr) END')} AS sim
        FROM dots d JOIN norms na ON d.u = na.u JOIN norms nb ON d.v = nb.u),
nbrs AS (SELECT * FROM (SELECT u, v, sim, row_number() OVER (PARTITION BY u ORDER BY sim DESC, v ASC) AS rk
                        FROM cos WHERE sim > 0) WHERE rk <= 10)
"""

COLLAB_SQL = f"""
cs0 AS (SELECT n.u, r.h, {r9('sum(n.sim * r.rating)')} AS score
        FROM nbrs n JOIN ratings r ON r.u = n.v GROUP BY 1, 2),
cscore AS (SELECT * FROM cs0 WHERE score > 0
           AND NOT EXISTS (SELECT 1 FROM ratings b WHERE b.u = cs0.u AND b.h = cs0.h AND b.rating > 0))
"""


def _collab_for(reqs: str, factor: int) -> str:
    return f"""
SELECT * FROM (
  SELECT q.request_id, q.user_code, c.h AS hotel_id, c.score,
         row_number() OVER (PARTITION BY q.request_id ORDER BY c.score DESC, c.h ASC) AS rank,
         q.n_recommendations * {factor} AS nn
  FROM {reqs} q JOIN cscore c ON q.user_code = c.u) WHERE rank <= nn
"""


CONTENT_SQL = f"""
hq AS (SELECT "userCode", {eavg('price')} AS pp, avg("days") AS pd, {eavg('total')} AS pt
       FROM hotels WHERE "userCode" IS NOT NULL GROUP BY 1),
cq AS (
  SELECT r.request_id, coalesce(r.preferences.price, 200.0) AS pp, coalesce(r.preferences.days, 3.0) AS pd,
         coalesce(r.preferences.total, 600.0) AS pt, coalesce(pdict.code, 0) AS pl
  FROM rec_requests r LEFT JOIN pdict ON r.preferences.place = pdict.value
  WHERE r.preferences IS NOT NULL
  UNION ALL
  SELECT r.request_id, hq.pp, hq.pd, hq.pt, 0 FROM rec_requests r JOIN hq ON r.user_code = hq."userCode"
  WHERE r.preferences IS NULL),
"""


def _knn_sql(qtable: str) -> str:
    return f"""
qs_{qtable} AS (SELECT request_id, (pp - m1) / s1 AS a, (pd - m2) / s2 AS b, (pt - m3) / s3 AS c,
                       (pl - m4) / s4 AS d FROM {qtable}, hst),
knn_{qtable} AS (
  SELECT * FROM (
    SELECT request_id, hotel_id, similarity,
           row_number() OVER (PARTITION BY request_id ORDER BY similarity DESC, hotel_id ASC) AS rank
    FROM (SELECT q.request_id, h.hotel_id,
                 {r9('CASE WHEN sqrt(a*a + b*b + c*c + d*d) * sqrt(f_price*f_price + f_days*f_days + f_total*f_total + f_place*f_place) = 0 THEN 0 ELSE (a*f_price + b*f_days + c*f_total + d*f_place) / (sqrt(a*a + b*b + c*c + d*d) * sqrt(f_price*f_price + f_days*f_days + f_total*f_total + f_place*f_place)) END')} AS similarity
          FROM qs_{qtable} q, hfeat h)) WHERE rank <= 10)
"""


INFO = "hi"  # hotel_info CTE (from HOTEL_FEATURES_SQL): hotel_id, price, place


@query("user_item", f"""
, {RATINGS_SQL.strip()}
SELECT u AS "userCode", h AS hotel_id, spend, rating FROM ratings
""")
def q_user_item(spark, sf):
    _, _, h = tables(spark, sf)
    return RC.user_item(h)


@query("row_normalize", f"""
, {RATINGS_SQL.strip()}
SELECT u AS "userCode", count(*) AS hotels, {r9('sum(rating)')} AS rating_sum FROM ratings GROUP BY 1
""")
def q_row_normalize(spark, sf):
    from ..functions.scalar import stable
    _, _, h = tables(spark, sf)
    r = RC.user_item(h)
    return r.groupBy("userCode").agg(F.count(F.lit(1)).alias("hotels"),
                                     stable(F.sum("rating"), 9).alias("rating_sum"))


@query("user_similarity", f"""
, {RATINGS_SQL.strip()}, {NEIGHBOURS_SQL.strip()},
people AS (SELECT DISTINCT u FROM ratings),
everyone AS (SELECT a.u, b.u AS v, coalesce(c.sim, 0.0) AS sim
             FROM people a JOIN people b ON a.u <> b.u LEFT JOIN cos c ON c.u = a.u AND c.v = b.u)
SELECT u AS "userCode", v AS neighbor, sim AS similarity, rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY u ORDER BY sim DESC, v ASC) AS INTEGER) AS rank FROM everyone)
WHERE rank <= 10
""")
def q_user_similarity(spark, sf):
    _, _, h = tables(spark, sf)
    return RC.user_similarity(RC.user_item(h))


@query("not_booked", f"""
, {RATINGS_SQL.strip()}, {NEIGHBOURS_SQL.strip()},
cand AS (SELECT DISTINCT n.u, r.h FROM nbrs n JOIN ratings r ON r.u = n.v)
SELECT u AS "userCode", h AS hotel_id FROM cand
WHERE NOT EXISTS (SELECT 1 FROM ratings b WHERE b.u = cand.u AND b.h = cand.h AND b.rating > 0)
""")
def q_not_booked(spark, sf):
    _, _, h = tables(spark, sf)
    r = RC.user_item(h)
    nb = RC.user_similarity(r, positive_only=True)
    cand = (nb.join(r.select(F.col("userCode").alias("neighbor"), "hotel_id"), "neighbor")
              .select("userCode", "hotel_id").distinct())
    booked = r.where(F.col("rating") > 0).select("userCode", "hotel_id")
    return cand.join(booked, ["userCode", "hotel_id"], "left_anti")


@query("recommend_collab", f"""
, {RATINGS_SQL.strip()}, {NEIGHBOURS_SQL.strip()}, {COLLAB_SQL.strip()}, {REC_REQ_SQL.strip()},
{HOTEL_FEATURES_SQL.strip()}
SELECT t.request_id, t.user_code, t.hotel_id, t.score, CAST(t.rank AS INTEGER) AS rank,
       hi.place, hi.price AS avg_price, split_part(t.hotel_id, '_', 1) AS "name"
FROM ({_collab_for('rec_requests', 1)}) t LEFT JOIN hi ON t.hotel_id = hi.hotel_id
""")
def q_recommend_collab(spark, sf):
    _, _, h = tables(spark, sf)
    return RC.recommend_collab(h, rec_requests(spark, sf))


@query("recommend_content_user", f"""
, {HOTEL_FEATURES_SQL.strip()}, {REC_REQ_SQL.strip()},
hq AS (SELECT "userCode", {eavg('price')} AS pp, avg("days") AS pd, {eavg('total')} AS pt
       FROM hotels WHERE "userCode" IS NOT NULL GROUP BY 1),
uq AS (SELECT r.request_id, hq.pp, hq.pd, hq.pt, 0 AS pl FROM rec_requests r JOIN hq ON r.user_code = hq."userCode"),
{_knn_sql('uq').strip()}
SELECT k.request_id, r.user_code, k.hotel_id, k.similarity, CAST(k.rank AS INTEGER) AS rank,
       hi.place, hi.price AS avg_price, split_part(k.hotel_id, '_', 1) AS "name"
FROM knn_uq k JOIN rec_requests r ON k.request_id = r.request_id LEFT JOIN hi ON k.hotel_id = hi.hotel_id
WHERE k.rank <= r.n_recommendations
""")
def q_recommend_content_user(spark, sf):
    _, _, h = tables(spark, sf)
    return RC.recommend_content(h, rec_requests(spark, sf), use_preferences=False)


@query("recommend_content_prefs", f"""
, {HOTEL_FEATURES_SQL.strip()}, {REC_REQ_SQL.strip()},
{CONTENT_SQL.strip()}
{_knn_sql('cq').strip()}
SELECT k.request_id, r.user_code, k.hotel_id, k.similarity, CAST(k.rank AS INTEGER) AS rank,
       hi.place, hi.price AS avg_price, split_part(k.hotel_id, '_', 1) AS "name"
FROM knn_cq k JOIN rec_requests r ON k.request_id = r.request_id LEFT JOIN hi ON k.hotel_id = hi.hotel_id
WHERE k.rank <= r.n_recommendations
""")
def q_recommend_content_prefs(spark, sf):
    _, _, h = tables(spark, sf)
    return RC.recommend_content(h, rec_requests(spark, sf))


@query("recommend_budget", f"""
, {HOTEL_FEATURES_SQL.strip()}, {BUDGET_REQ_SQL.strip()},
bq AS (SELECT request_id, budget AS pp, CAST(stay_days AS DOUBLE) AS pd, budget * stay_days AS pt, 0 AS pl
       FROM budget_requests),
{_knn_sql('bq').strip()}
SELECT request_id, hotel_id, similarity, CAST(rank AS INTEGER) AS rank, place, avg_price, "name" FROM (
  SELECT k.*, hi.place, hi.price AS avg_price, split_part(k.hotel_id, '_', 1) AS "name",
         row_number() OVER (PARTITION BY k.request_id ORDER BY k.rank) AS pos
  FROM knn_bq k JOIN budget_requests b ON k.request_id = b.request_id
  LEFT JOIN hi ON k.hotel_id = hi.hotel_id
  WHERE b.destination = 'Any' OR hi.place = b.destination) WHERE pos <= 5
""")
def q_recommend_budget(spark, sf):
    _, _, h = tables(spark, sf)
    return RC.recommend_budget(h, budget_requests(spark, sf))


HYBRID_SQL = f"""
, {RATINGS_SQL.strip()}, {NEIGHBOURS_SQL.strip()}, {COLLAB_SQL.strip()}, {REC_REQ_SQL.strip()},
{HOTEL_FEATURES_SQL.strip()},
{CONTENT_SQL.strip()}
{_knn_sql('cq').strip()},
col2 AS ({_collab_for('rec_requests', 2)}),
con2 AS (SELECT k.* FROM knn_cq k JOIN rec_requests r ON k.request_id = r.request_id
         WHERE k.rank <= 2 * r.n_recommendations),
merged AS (
  SELECT coalesce(a.request_id, b.request_id) AS request_id, coalesce(a.hotel_id, b.hotel_id) AS hotel_id,
         coalesce(a.score, 0) AS collab_score, coalesce(b.similarity, 0) AS content_score
  FROM col2 a FULL OUTER JOIN con2 b ON a.request_id = b.request_id AND a.hotel_id = b.hotel_id),
hyb AS (
  SELECT * FROM (
    SELECT m.*, r.user_code, {r9('0.6 * collab_score + 0.4 * content_score')} AS hybrid_score,
           r.n_recommendations AS nn
    FROM merged m JOIN rec_requests r ON m.request_id = r.request_id)),
hyb_top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id
                                                        ORDER BY hybrid_score DESC, hotel_id ASC) AS rank
                           FROM hyb) WHERE rank <= nn)
"""


@query("collab_content_merge", HYBRID_SQL + """
SELECT request_id, hotel_id, collab_score, content_score FROM merged
""")
def q_collab_content_merge(spark, sf):
    _, _, h = tables(spark, sf)
    req = rec_requests(spark, sf)
    model = RC.hotel_features(h)
    col = RC.recommend_collab(h, req, 2, feats=model[0])
    con = RC.recommend_content(h, req, 2, model=model)
    return RC.collab_content_merge(col, con)


@query("recommend_hybrid", HYBRID_SQL + """
SELECT t.request_id, t.user_code, t.hotel_id, t.collab_score, t.content_score, t.hybrid_score,
       CAST(t.rank AS INTEGER) AS rank, hi.place, hi.price AS avg_price, split_part(t.hotel_id, '_', 1) AS "name"
FROM hyb_top t LEFT JOIN hi ON t.hotel_id = hi.hotel_id
""")
def q_recommend_hybrid(spark, sf):
    _, _, h = tables(spark, sf)
    return RC.recommend_hybrid(h, rec_requests(spark, sf))


@query("recommend", HYBRID_SQL + f"""
, col1 AS ({_collab_for('rec_requests', 1)}),
con1 AS (SELECT k.*, r.user_code FROM knn_cq k JOIN rec_requests r ON k.request_id = r.request_id
         WHERE k.rank <= r.n_recommendations),
allr AS (
  SELECT request_id, user_code, rank, hotel_id, score FROM col1
  WHERE request_id IN (SELECT request_id FROM rec_requests WHERE method = 'collaborative')
  UNION ALL
  SELECT request_id, user_code, rank, hotel_id, similarity FROM con1
  WHERE request_id IN (SELECT request_id FROM rec_requests WHERE method = 'content')
  UNION ALL
  SELECT request_id, user_code, rank, hotel_id, hybrid_score FROM hyb_top
  WHERE request_id IN (SELECT request_id FROM rec_requests
                       WHERE method IS NULL OR method NOT IN ('collaborative', 'content')))
SELECT a.request_id, a.user_code, r.method, CAST(a.rank AS INTEGER) AS rank, a.hotel_id,
       split_part(a.hotel_id, '_', 1) AS "name", hi.place, hi.price AS avg_price, a.score
FROM allr a JOIN rec_requests r ON a.request_id = r.request_id LEFT JOIN hi ON a.hotel_id = hi.hotel_id
""")
def q_recommend(spark, sf):
    _, _, h = tables(spark, sf)
    return RC.recommend(h, rec_requests(spark, sf))


@query("recommend_api", f"""
, {RATINGS_SQL.strip()}, {NEIGHBOURS_SQL.strip()}, {COLLAB_SQL.strip()}, {REC_REQ_SQL.strip()},
{HOTEL_FEATURES_SQL.strip()},
pq AS (SELECT r.request_id, coalesce(r.preferences.price, 200.0) AS pp, coalesce(r.preferences.days, 3.0) AS pd,
              coalesce(r.preferences.total, 600.0) AS pt, coalesce(pdict.code, 0) AS pl
       FROM rec_requests r LEFT JOIN pdict ON r.preferences.place = pdict.value
       WHERE r.method = 'content' AND r.preferences IS NOT NULL),
{_knn_sql('pq').strip()},
col1 AS ({_collab_for('rec_requests', 1)}),
allr AS (
  SELECT request_id, user_code, rank, hotel_id, score FROM col1
  WHERE request_id NOT IN (SELECT request_id FROM pq)
  UNION ALL
  SELECT k.request_id, r.user_code, k.rank, k.hotel_id, k.similarity FROM knn_pq k
  JOIN rec_requests r ON k.request_id = r.request_id WHERE k.rank <= r.n_recommendations)
SELECT a.request_id, a.user_code, r.method, CAST(a.rank AS INTEGER) AS rank, a.hotel_id,
       split_part(a.hotel_id, '_', 1) AS "name", hi.place, hi.price AS avg_price, a.score
FROM allr a JOIN rec_requests r ON a.request_id = r.request_id LEFT JOIN hi ON a.hotel_id = hi.hotel_id
""")
def q_recommend_api(spark, sf):
    _, _, h = tables(spark, sf)
    return RC.recommend_api(h, rec_requests(spark, sf))


@query("popular_hotels", f"""
, {HOTEL_FEATURES_SQL.strip()}
SELECT hotel_id, split_part(hotel_id, '_', 1) AS "name", place, price AS avg_price, bookings AS booking_count
FROM hi ORDER BY bookings DESC, hotel_id ASC LIMIT 10
""")
def q_popular_hotels(spark, sf):
    _, _, h = tables(spark, sf)
    return RC.popular_hotels(h, 10)


@query("popular_hotels_by_total", f"""
, {HOTEL_FEATURES_SQL.strip()}
SELECT hotel_id, split_part(hotel_id, '_', 1) AS "name", place, price AS avg_price, total AS avg_total
FROM hi ORDER BY total DESC, hotel_id ASC LIMIT 10
""")
def q_popular_hotels_by_total(spark, sf):
    _, _, h = tables(spark, sf)
    return RC.popular_hotels_by_total(h, 10)


@query("hotels_by_place", f"""
SELECT place, CAST(rank AS INTEGER) AS rank, hotel_id, split_part(hotel_id, '_', 1) AS "name", avg_price,
       booking_count FROM (
  SELECT place, hotel_id, avg_price, booking_count,
         row_number() OVER (PARTITION BY place ORDER BY booking_count DESC, hotel_id ASC) AS rank
  FROM (SELECT place, "name" || '_' || place AS hotel_id, count(total) AS booking_count,
               {eavg('price')} AS avg_price
        FROM hotels WHERE place IS NOT NULL GROUP BY 1, 2)) WHERE rank <= 5
""")
def q_hotels_by_place(spark, sf):
    _, _, h = tables(spark, sf)
    return RC.hotels_by_place(h, 5)
