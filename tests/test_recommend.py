import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfare.operators import recommend as RC
from small_tables import hotels_df

D = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def hotels(spark):
    rows = []
    tc = 0
    # users 1 and 2 are twins (same hotels, same spend); user 3 overlaps; user 4 books everything
    book = {1: ["A_P", "B_P"], 2: ["A_P", "B_P"], 3: ["A_P", "C_Q"], 4: ["A_P", "B_P", "C_Q", "D_Q"],
            5: ["D_Q"]}
    for u, hs in book.items():
        for h in hs:
            tc += 1
            name, place = h.split("_")
            rows.append((tc, u, name, place, 2, 100.0 + u, 2 * (100.0 + u), D))
    return hotels_df(spark, rows)


def reqs(spark, rows):
    return spark.createDataFrame(rows, "request_id long, user_code long, method string, n_recommendations int, "
                                       "preferences struct<price:double,days:double,total:double,place:string>")


def test_user_item_normalised(hotels):
    r = RC.user_item(hotels).groupBy("userCode").agg(F.sum("rating").alias("s")).collect()
    assert all(abs(x.s - 1.0) < 1e-12 for x in r)


def test_collab_excludes_booked_and_unknown(spark, hotels):
    rq = reqs(spark, [(1, 1, "collaborative", 5, None), (2, 99, "collaborative", 5, None),
                      (3, 4, "collaborative", 5, None)])
    out = RC.recommend_collab(hotels, rq).collect()
    booked = {(r.userCode, r.hotel_id) for r in RC.user_item(hotels).collect()}
    assert all((r.user_code, r.hotel_id) not in booked for r in out)
    assert not [r for r in out if r.request_id == 2]          # unknown user
    assert not [r for r in out if r.request_id == 3]          # booked everything
    got1 = [r.hotel_id for r in sorted([r for r in out if r.request_id == 1], key=lambda r: r.rank)]
    assert set(got1) <= {"C_Q", "D_Q"} and got1


def test_twin_is_a_neighbour_not_self(spark, hotels):
    nb = RC.user_similarity(RC.user_item(hotels)).where("userCode = 1").orderBy("rank").collect()
    assert nb[0].neighbor == 2 and nb[0].similarity == 1.0
    assert all(r.neighbor != 1 for r in nb)


def test_content_and_budget(spark, hotels):
    rq = reqs(spark, [(1, 1, "content", 2, None), (2, 5, "content", 3, (150.0, None, None, "Q")),
                      (3, 77, "content", 3, None)])
    out = RC.recommend_content(hotels, rq).collect()
    by = {}
    for r in out:
        by.setdefault(r.request_id, []).append(r)
    assert len(by[1]) == 2 and len(by[2]) == 3 and 3 not in by   # no history -> empty
    b = spark.createDataFrame([(1, 150.0, 2, "Q"), (2, 150.0, 2, "Any"), (3, 150.0, 2, "Nowhere")],
                              "request_id long, budget double, stay_days int, destination string")
    res = RC.recommend_budget(hotels, b).collect()
    assert all(r.place == "Q" for r in res if r.request_id == 1)
    assert len([r for r in res if r.request_id == 2]) == 4 and not [r for r in res if r.request_id == 3]


def test_hybrid_weights(spark, hotels):
    rq = reqs(spark, [(1, 1, "hybrid", 5, None)])
    out = RC.recommend_hybrid(hotels, rq).collect()
    for r in out:
        assert abs(r.hybrid_score - (0.6 * r.collab_score + 0.4 * r.content_score)) < 1e-8
    ranks = [r.rank for r in sorted(out, key=lambda r: r.rank)]
    assert ranks == list(range(1, len(out) + 1))


def test_dispatchers(spark, hotels):
    rq = reqs(spark, [(1, 1, "collaborative", 2, None), (2, 1, "content", 2, None), (3, 1, "hybrid", 2, None),
                      (4, 1, "content", 2, (150.0, 2.0, 300.0, "P"))])
    r = RC.recommend(hotels, rq).groupBy("request_id").count().collect()
    assert {x.request_id for x in r} == {1, 2, 3, 4}
    a = {x.request_id: x["count"] for x in RC.recommend_api(hotels, rq).groupBy("request_id").count().collect()}
    # API: content only with preferences; request 2 (content, no prefs) falls to collaborative
    assert a[4] == 2 and 2 in a


def test_popular_and_by_place(hotels):
    p = RC.popular_hotels(hotels, 2).collect()
    assert [r.hotel_id for r in p] == ["A_P", "B_P"] and p[0].booking_count == 4
    bp = RC.hotels_by_place(hotels, 1).collect()
    assert {(r.place, r.hotel_id) for r in bp} == {("P", "A_P"), ("Q", "C_Q")}
