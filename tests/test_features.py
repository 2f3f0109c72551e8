import datetime as dt

import pytest

from wayfare.operators import features as FT
from small_tables import flights_df, hotels_df, users_df

D = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    users = users_df(spark, [(1, "A", "u1", "male", 30), (2, "B", "u2", "female", 40),
                             (3, "A", "u3", "female", 50), (4, "C", "u4", "male", 60)])
    flights = flights_df(spark, [
        (10, 1, "X", "Y", "firstClass", 100.0, 2.0, 1000, "ag", D),
        (11, 1, "X", "Z", "economic", 300.0, 3.0, 2000, "ag", D),
        (12, 2, "Y", "X", "business", 50.0, 1.5, 500, "ag", D),   # user 2: one flight
        (13, None, "Y", "X", "business", 70.0, 1.5, 500, "ag", D),  # null key dropped
    ])
    hotels = hotels_df(spark, [
        (10, 1, "H", "Y", 2, 100.0, 200.0, D),
        (20, 3, "H", "Z", 3, 50.0, 150.0, D),   # user 3: hotels but no flights
    ])
    return users, flights, hotels


def test_flight_agg_nulls_and_std(tables):
    _, f, _ = tables
    rows = {r.userCode: r for r in FT.flight_agg(f).collect()}
    assert set(rows) == {1, 2}
    assert rows[1].flight_count == 2 and rows[1].total_flight_spent == 400.0
    assert rows[1].first_class_count == 1
    assert rows[2].flight_price_std is None  # one row -> NULL before filling


def test_user_features_hotel_key_chain(tables):
    u, f, h = tables
    ref = {r.code: r for r in FT.user_features(u, f, h).collect()}
    # user 3 has stays but no flights: the original chain gives hotel features 0
    assert ref[3].hotel_booking_count == 0 and ref[3].total_hotel_spent == 0.0
    assert ref[2].flight_price_std == 0.0  # filled
    assert ref[4].flight_count == 0 and ref[4].userCode == 0
    sane = {r.code: r for r in FT.user_features(u, f, h, hotel_key="code").collect()}
    assert sane[3].hotel_booking_count == 1 and sane[3].total_hotel_spent == 150.0


def test_user_profiles_fill(tables):
    u, _, h = tables
    rows = {r.code: r for r in FT.user_profiles(u, h).collect()}
    assert rows[2].avg_price == 0.0 and rows[1].total_spent == 200.0 and rows[1].price_std == 0.0


def test_hotel_info(tables):
    _, _, h = tables
    rows = {r.hotel_id: r for r in FT.hotel_info(h).collect()}
    assert set(rows) == {"H_Y", "H_Z"} and rows["H_Y"].place == "Y"


def test_hotel_info_sums_stays_by_hash(spark):
    rows = [(1, 1, "A", "P", 2, 10.25, 20.5, D), (2, 1, "A", "P", 3, None, 30.25, D), (3, None, "A", "P", None, 20.5, None, D),
            (4, 1, "A_B", "C", 1, 5.0, 5.0, D), (5, 1, "A", "B_C", 4, 7.0, 28.0, D),  # one id, two places
            (6, 1, "E", "P", None, None, None, D), (7, 1, None, "P", 1, 1.0, 1.0, D), (8, 1, "A", None, 1, 1.0, 1.0, D)]
    info = FT.hotel_info(hotels_df(spark, rows))
    assert {tuple(r) for r in info.select("hotel_id", "price", "days", "total", "place", "bookings").collect()} == {
        ("A_P", 15.375, 2.5, 25.375, "P", 3), ("A_B_C", 6.0, 2.5, 16.5, "B_C", 2), ("E_P", None, None, None, "P", 1)}
    plan = info._jdf.queryExecution().executedPlan().toString().splitlines()
    stays = [line for line in plan if "Aggregate(" in line][-1]  # the one that reads the stays
    assert "HashAggregate(" in stays, stays
