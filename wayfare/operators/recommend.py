"""Hotel recommendations: collaborative, content-based, hybrid, popularity.

Data model: the user x hotel interaction matrix is kept as a long sparse
table ``(userCode, hotel_id, rating)`` (never a dense matrix). Ratings are
the user's total spend at the hotel divided by the user's total spend.

* Collaborative: 10 most similar other users by cosine of rating vectors
  (exact blocked kernel in ``knn``), score(h) = sum(sim * rating(v, h)) over
  those neighbours, already booked hotels removed, positive scores only.
* Content-based: hotels are profiled by (mean nightly price, mean days, mean
  total, place code), standard scaled over hotels; a query vector (a user's
  history means, explicit preferences, or a budget) is scaled the same way
  and its 10 nearest hotels by cosine are returned.
* Hybrid: 0.6 * collaborative + 0.4 * content over the union of both lists.

Every function takes a *request table* (one row per request), so a batch of
users is served by one plan; nothing loops on the driver.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import exact_sum, hotel_name_from_id, stable
from ..ml.scale import apply_scaler, fit_scaler
from . import encoding as E
from .features import hotel_info, hotel_table
from .cells import nearest_by_cells
from .knn import pack_long, topk_cosine

# Fixed parameters of the original recommender.
NEIGHBOURS = 10          # similar users / nearest hotels considered
HYBRID_COLLAB_WEIGHT = 0.6
HYBRID_CONTENT_WEIGHT = 0.4
FEATURES = ["f_price", "f_days", "f_total", "f_place"]
RAW_FEATURES = ["price", "days", "total", "place_encoded"]
SCORE_DIGITS = 9


# ----------------------------------------------------------------- ratings

def row_normalize(df: DataFrame, key: str, value: str, out: str = "rating",
                  scale: int | None = 2) -> DataFrame:
    """value / sum(value) per key (a zero sum divides by 1).

    The per-key sum is a window over rows already aggregated to one per
    (key, item), so a window partition holds at most one row per item. With
    ``scale`` the sum is exact (DECIMAL) for values with that many decimals.
    """
    v = F.col(value) if scale is None else F.col(value).cast(f"decimal(38,{scale})")
    s = F.sum(v).over(Window.partitionBy(key)).cast("double")
    return df.withColumn(out, F.col(value) / F.when(s == 0, F.lit(1.0)).otherwise(s))


def user_item(hotels: DataFrame) -> DataFrame:
    """(userCode, hotel_id, spend, rating): spend summed per pair, row-normalised."""
    h = hotel_table(hotels).where(F.col("userCode").isNotNull() & F.col("hotel_id").isNotNull()
                                  & F.col("total").isNotNull())
    pairs = h.groupBy("userCode", "hotel_id").agg(exact_sum("total").alias("spend"))
    # read by the similarity search (twice), the scoring join and the
    # booked-hotel anti join: persisted once
    return row_normalize(pairs, "userCode", "spend").persist(StorageLevel.MEMORY_AND_DISK)


# ----------------------------------------------------------- hotel profiles

def hotel_features(hotels: DataFrame):
    """(features, scaler, place dictionary).

    features: hotel_info + ``place_encoded`` + scaled ``f_*`` columns. The
    scaler (population statistics over hotels) is returned so query vectors
    are scaled with the same numbers.
    """
    # The profile table (one row per hotel) is read by the kNN search, the
    # scaler and the result lookup: persist it rather than re-aggregate the
    # stays for each use.
    info = hotel_info(hotels).persist(StorageLevel.MEMORY_AND_DISK)
    places = E.build_dictionary(info, "place")
    enc = E.encode(info, "place", places, "place_encoded")
    scaler = fit_scaler(enc, RAW_FEATURES)
    scaled = apply_scaler(enc, scaler, RAW_FEATURES, "_s")
    out = scaled.select(*enc.columns, *[F.col(f"{r}_s").alias(f) for r, f in zip(RAW_FEATURES, FEATURES)])
    return out.persist(StorageLevel.MEMORY_AND_DISK), scaler, places


def _vectors(df: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    """Dense feature columns -> vectors (id, vals)."""
    return df.select(F.col(id_col).alias("id"), F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]).alias("vals"))


def scale_queries(queries: DataFrame, scaler: DataFrame, id_col: str = "request_id") -> DataFrame:
    """Query rows with pref_price, pref_days, pref_total, pref_place_encoded ->
    scaled feature columns ``f_*`` (same scaler as the hotels)."""
    q = queries.select(F.col(id_col).alias("_qid"),
                       F.col("pref_price").alias("price"), F.col("pref_days").alias("days"),
                       F.col("pref_total").alias("total"),
                       F.col("pref_place_encoded").alias("place_encoded"))
    s = apply_scaler(q, scaler, RAW_FEATURES, "_s")
    return s.select(F.col("_qid").alias(id_col),
                    *[F.col(f"{r}_s").alias(f) for r, f in zip(RAW_FEATURES, FEATURES)])


def nearest_hotels(query_features: DataFrame, hotel_feats: DataFrame, id_col: str = "request_id",
                   k: int = NEIGHBOURS) -> DataFrame:
    """k nearest hotels by cosine of scaled profiles: (id, hotel_id, similarity, rank)."""
    qv = _vectors(query_features, id_col, FEATURES)
    hv = _vectors(hotel_feats, "hotel_id", FEATURES)
    nn = nearest_by_cells(qv, hv, k, len(FEATURES), digits=SCORE_DIGITS)
    return nn.select(F.col("qid").alias(id_col), F.col("cid").alias("hotel_id"),
                     F.col("score").alias("similarity"), "rank")


def _with_info(df: DataFrame, feats: DataFrame) -> DataFrame:
    info = feats.select("hotel_id", "place", F.col("price").alias("avg_price"))
    return (df.join(info, "hotel_id", "left")
              .withColumn("name", hotel_name_from_id("hotel_id")))


# ----------------------------------------------------------- collaborative

def user_similarity(ratings: DataFrame, users: DataFrame | None = None,
                    k: int = NEIGHBOURS, positive_only: bool = False, grid: tuple[int, int] | None = None) -> DataFrame:
    """Top-k other users by cosine of rating vectors for each user in
    ``users`` (column ``user_code``; default: every user with ratings).
    ``positive_only`` leaves out neighbours with similarity 0, which add
    nothing to a score."""
    # Integer keys: the kernel factorises keys per group, which is much
    # cheaper on 64-bit hashes than on strings.
    cand = pack_long(ratings.select(F.col("userCode").alias("id"), F.xxhash64("hotel_id").alias("key"),
                                    F.col("rating").alias("value")))
    q = cand
    if users is not None:
        q = cand.join(users.select(F.col("user_code").alias("id")).distinct(), "id", "left_semi")
    nn = topk_cosine(q, cand, k, exclude_self=True, min_score=0.0 if positive_only else None, grid=grid,
                     digits=SCORE_DIGITS)
    return nn.select(F.col("qid").alias("userCode"), F.col("cid").alias("neighbor"),
                     F.col("score").alias("similarity"), "rank")


def collab_scores(ratings: DataFrame, neighbours: DataFrame) -> DataFrame:
    """score(u, h) = sum(sim(u, v) * rating(v, h)) over u's neighbours v, minus
    hotels u already booked, positive scores only.

    The neighbour join is on v; a user who is everyone's neighbour is a hot
    key there, which AQE's skew-join handling splits.
    """
    r = ratings.select(F.col("userCode").alias("neighbor"), "hotel_id", "rating")
    s = (neighbours.join(r, "neighbor")
           .groupBy("userCode", "hotel_id")
           .agg(F.sum(F.col("similarity") * F.col("rating")).alias("score")))
    booked = ratings.where(F.col("rating") > 0).select("userCode", "hotel_id")
    s = s.join(booked, ["userCode", "hotel_id"], "left_anti")
    return s.withColumn("score", stable("score", SCORE_DIGITS)).where(F.col("score") > 0)


def _top_n(df: DataFrame, part: str, score: str, n_col) -> DataFrame:
    w = Window.partitionBy(part).orderBy(F.col(score).desc(), F.col("hotel_id").asc())
    # planned with a partial group limit before the shuffle
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n_col)


def recommend_collab(hotels: DataFrame, requests: DataFrame, n_factor: int = 1,
                     feats: DataFrame | None = None, ratings: DataFrame | None = None,
                     scores: DataFrame | None = None) -> DataFrame:
    """Collaborative top-n per request (columns request_id, user_code,
    n_recommendations). Unknown users and users without stays get no rows.
    ``scores``: ``collab_scores`` of at least these users, if known already."""
    ratings = ratings if ratings is not None else user_item(hotels)
    feats = feats if feats is not None else hotel_info(hotels)
    sc = scores if scores is not None else collab_scores(ratings, user_similarity(ratings, requests, positive_only=True))
    req = requests.select("request_id", "user_code", (F.col("n_recommendations") * n_factor).alias("_n"))
    j = req.join(sc, req.user_code == sc.userCode).drop("userCode")
    top = _top_n(j, "request_id", "score", F.col("_n")).drop("_n")
    return _with_info(top, feats)


# ----------------------------------------------------------- content-based

def history_queries(hotels: DataFrame, requests: DataFrame) -> DataFrame:
    """Query vectors from each requesting user's stays: mean nightly price,
    mean days, mean total, place code 0. Users without stays get no row."""
    from ..functions.scalar import exact_avg
    h = hotels.where(F.col("userCode").isNotNull())
    means = h.groupBy("userCode").agg(exact_avg("price").alias("pref_price"),
                                      F.avg("days").alias("pref_days"),
                                      exact_avg("total").alias("pref_total"))
    return (requests.select("request_id", "user_code")
                    .join(means, F.col("user_code") == F.col("userCode"))
                    .select("request_id", "pref_price", "pref_days", "pref_total",
                            F.lit(0).alias("pref_place_encoded")))


def preference_queries(requests: DataFrame, places: DataFrame) -> DataFrame:
    """Query vectors from the preference struct with defaults; the place is
    encoded with the hotel place dictionary (missing or unseen -> 0)."""
    from .requests import preference_defaults
    p = preference_defaults(requests.where(F.col("preferences").isNotNull()))
    p = E.encode(p, "pref_place", places, "pref_place_encoded")
    return p.select("request_id", "pref_price", "pref_days", "pref_total", "pref_place_encoded")


def content_queries(hotels: DataFrame, requests: DataFrame, places: DataFrame) -> DataFrame:
    """Preferences when given, otherwise the user's history."""
    with_p = preference_queries(requests, places)
    hist = history_queries(hotels, requests.where(F.col("preferences").isNull()))
    return with_p.unionByName(hist)


def recommend_content(hotels: DataFrame, requests: DataFrame, n_factor: int = 1,
                      use_preferences: bool = True, model=None) -> DataFrame:
    """Content-based: the 10 nearest hotels to each query vector, first n."""
    feats, scaler, places = model or hotel_features(hotels)
    if use_preferences:
        qv = content_queries(hotels, requests, places)
    else:
        qv = history_queries(hotels, requests)
    nn = nearest_hotels(scale_queries(qv, scaler), feats)
    req = requests.select("request_id", "user_code", (F.col("n_recommendations") * n_factor).alias("_n"))
    j = nn.join(req, "request_id").where(F.col("rank") <= F.col("_n")).drop("_n")
    return _with_info(j, feats)


def recommend_budget(hotels: DataFrame, budget_requests: DataFrame, n: int = 5, model=None) -> DataFrame:
    """Budget search: vector (budget, days, budget*days, 0), 10 nearest hotels,
    destination filter applied after the search ('Any' keeps all), first n."""
    from .requests import budget_vector
    feats, scaler, _ = model or hotel_features(hotels)
    qv = budget_vector(budget_requests)
    nn = nearest_hotels(scale_queries(qv, scaler), feats)
    j = _with_info(nn, feats).join(budget_requests.select("request_id", "destination"), "request_id")
    j = j.where((F.col("destination") == "Any") | (F.col("place") == F.col("destination")))
    w = Window.partitionBy("request_id").orderBy("rank")
    return (j.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= n)
             .drop("pos", "destination"))


# ------------------------------------------------------------------ hybrid

def collab_content_merge(collab: DataFrame, content: DataFrame) -> DataFrame:
    """Union by (request, hotel) of two lists; a missing score is 0."""
    c1 = collab.select("request_id", "hotel_id", F.col("score").alias("collab_score"))
    c2 = content.select("request_id", "hotel_id", F.col("similarity").alias("content_score"))
    m = c1.join(c2, ["request_id", "hotel_id"], "full_outer")
    return m.select("request_id", "hotel_id",
                    F.coalesce("collab_score", F.lit(0.0)).alias("collab_score"),
                    F.coalesce("content_score", F.lit(0.0)).alias("content_score"))


def recommend_hybrid(hotels: DataFrame, requests: DataFrame, model=None, ratings=None) -> DataFrame:
    """0.6 * collaborative + 0.4 * content over both lists (2n each), top n."""
    model = model or hotel_features(hotels)
    feats = model[0]
    col = recommend_collab(hotels, requests, 2, feats=feats, ratings=ratings)
    con = recommend_content(hotels, requests, 2, model=model)
    m = collab_content_merge(col, con)
    m = m.withColumn("hybrid_score", stable(HYBRID_COLLAB_WEIGHT * F.col("collab_score")
                                            + HYBRID_CONTENT_WEIGHT * F.col("content_score"),
                                            SCORE_DIGITS))
    req = requests.select("request_id", "user_code", F.col("n_recommendations").alias("_n"))
    j = m.join(req, "request_id")
    top = _top_n(j, "request_id", "hybrid_score", F.col("_n")).drop("_n")
    return _with_info(top, feats)


# --------------------------------------------------------------- dispatch

OUT_COLS = ["request_id", "user_code", "method", "rank", "hotel_id", "name", "place",
            "avg_price", "score"]


def recommend(hotels: DataFrame, requests: DataFrame) -> DataFrame:
    """Per request ``method``: 'collaborative', 'content', anything else hybrid."""
    model = hotel_features(hotels)
    ratings = user_item(hotels)
    m = F.coalesce(F.col("method"), F.lit("hybrid"))
    # One collaborative and one content search serve all methods; a list is 2n long for hybrids and n otherwise.
    twice = ~m.isin("collaborative", "content")
    asked = requests.withColumn("_n", F.col("n_recommendations") * F.when(twice, 2).otherwise(1))
    lists = asked.select("request_id", "user_code", "preferences", F.col("_n").alias("n_recommendations"), m.alias("_m"))
    col = recommend_collab(hotels, lists.where("_m <> 'content'"), feats=model[0], ratings=ratings)
    con = recommend_content(hotels, lists.where("_m <> 'collaborative'"), model=model)
    both = collab_content_merge(col, con).join(requests.select("request_id", "user_code", "n_recommendations", "method"), "request_id")
    mixed = stable(HYBRID_COLLAB_WEIGHT * F.col("collab_score") + HYBRID_CONTENT_WEIGHT * F.col("content_score"), SCORE_DIGITS)
    score = F.when(m == "collaborative", F.col("collab_score")).when(m == "content", F.col("content_score")).otherwise(mixed)
    top = _top_n(both.withColumn("score", score), "request_id", "score", F.col("n_recommendations"))
    return _with_info(top, model[0]).select(*OUT_COLS)


def recommend_api(hotels: DataFrame, requests: DataFrame) -> DataFrame:
    """API dispatch: content-based only for method 'content' with preferences;
    every other request is collaborative (including 'hybrid')."""
    feats, scaler, places = hotel_features(hotels)
    content_mask = (F.col("method") == "content") & F.col("preferences").isNotNull()
    r_con = requests.where(content_mask)
    r_col = requests.where(~content_mask | F.col("method").isNull())
    a = recommend_collab(hotels, r_col, feats=feats) \
        .select("request_id", "user_code", "rank", "hotel_id", "name", "place", "avg_price", "score")
    qv = preference_queries(r_con, places)
    nn = nearest_hotels(scale_queries(qv, scaler), feats)
    req = r_con.select("request_id", "user_code", "n_recommendations")
    b = (_with_info(nn.join(req, "request_id").where(F.col("rank") <= F.col("n_recommendations")), feats)
         .select("request_id", "user_code", "rank", "hotel_id", "name", "place", "avg_price",
                 F.col("similarity").alias("score")))
    meth = requests.select("request_id", "method")
    return a.unionByName(b).join(meth, "request_id").select(*OUT_COLS)


# ------------------------------------------------------------- popularity

def popular_hotels(hotels: DataFrame, n: int = 10) -> DataFrame:
    """Top-n hotels by number of stays, with place and mean nightly price."""
    info = hotel_info(hotels)
    top = info.orderBy(F.col("bookings").desc(), F.col("hotel_id").asc()).limit(n)
    return top.select("hotel_id", hotel_name_from_id("hotel_id").alias("name"), "place",
                      F.col("price").alias("avg_price"), F.col("bookings").alias("booking_count"))


def popular_hotels_by_total(hotels: DataFrame, n: int = 10) -> DataFrame:
    """API variant: top-n hotels by mean stay total."""
    info = hotel_info(hotels)
    top = info.orderBy(F.col("total").desc(), F.col("hotel_id").asc()).limit(n)
    return top.select("hotel_id", hotel_name_from_id("hotel_id").alias("name"), "place",
                      F.col("price").alias("avg_price"), F.col("total").alias("avg_total"))


def hotels_by_place(hotels: DataFrame, n: int = 5, places: DataFrame | None = None) -> DataFrame:
    """Top-n hotels by stays within each place (or each requested place),
    with mean nightly price. An unknown place yields no rows."""
    from ..functions.scalar import exact_avg
    h = hotel_table(hotels).where(F.col("place").isNotNull())
    if places is not None:
        h = h.join(places.select("place").distinct(), "place", "left_semi")
    st = h.groupBy("place", "hotel_id").agg(F.count("total").alias("booking_count"),
                                            exact_avg("price").alias("avg_price"))
    w = Window.partitionBy("place").orderBy(F.col("booking_count").desc(), F.col("hotel_id").asc())
    top = st.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return top.select("place", "rank", "hotel_id", hotel_name_from_id("hotel_id").alias("name"),
                      "avg_price", "booking_count")


def user_history(hotels: DataFrame, n: int = 5) -> DataFrame:
    """Each user's first n stays (by date, then travelCode): name, place,
    days, total, date. ``row_number() <= n`` is planned with a partial
    per-partition group limit, so a heavy user ships n rows per partition."""
    h = hotels.where(F.col("userCode").isNotNull())
    w = Window.partitionBy("userCode").orderBy("date", "travelCode", "name", "place", "days", "total")
    return (h.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
             .select("userCode", "name", "place", "days", "total", "date"))
