import datetime as dt

import pytest

from wayfare.operators import quality as Q
from small_tables import flights_df, hotels_df, users_df

D = dt.date(2024, 1, 1)


def test_validate_fails_on_null_and_nonpositive(spark):
    u = users_df(spark, [(1, "A", None, "male", 30)])
    f = flights_df(spark, [(1, 1, "X", "Y", "economic", None, 1.0, 500, "g", D),
                           (2, 1, "X", "Y", "economic", 0.0, 1.0, 500, "g", D)])
    h = hotels_df(spark, [])
    checks = {(r.table, r.check): r for r in Q.validate_data(u, f, h).collect()}
    assert not checks[("users", "users_no_nulls")].passed
    assert checks[("flights", "prices_positive")].bad_rows == 2  # NULL counts as a failure
    assert not checks[("hotels", "hotels_not_empty")].passed
    with pytest.raises(Q.DataQualityError):
        Q.raise_on_fail(Q.validate_data(u, f, h))


def test_validate_empty_prices_pass(spark):
    u = users_df(spark, [(1, "A", "a", "male", 30)])
    f = flights_df(spark, [])
    checks = {r.check: r.passed for r in Q.validate_data(u, f, hotels_df(spark, [])).collect()}
    assert checks["prices_positive"] and not checks["flights_not_empty"]


def test_clean_and_preprocess(spark):
    f = flights_df(spark, [(1, 1, "X", "Y", "e", p, 1.0, 500, "g", D) for p in (None, -1.0, 0.0, 5.0)])
    h = hotels_df(spark, [(1, 1, "H", "Y", 1, 10.0, t, D) for t in (None, 10.0)])
    cf, ch, counts = Q.preprocess(f, h)
    assert cf.count() == 1 and ch.count() == 1
    c = {r.table: (r.rows_before, r.rows_after) for r in counts.collect()}
    assert c == {"flights": (4, 1), "hotels": (2, 1)}


def test_describe_and_missing(spark):
    f = flights_df(spark, [(1, 1, "X", "Y", "e", p, 1.0, 500, "g", D) for p in (1.0, 2.0, 4.0, None)])
    d = {r.column: r for r in Q.describe(f, ["price"]).collect()}
    assert d["price"]["count"] == 3 and d["price"].p50 == 2.0 and d["price"].p25 == 1.5
    m = {r.column: r.missing for r in Q.missing_counts(f).collect()}
    assert m == {"price": 1}


def test_audits(spark):
    f = flights_df(spark, [(1, 1, "X", "X", "economic", 150.0, 2.5, 1000, "g", D),
                           (2, 1, "X", "Y", "business", 300.0, 2.7, 1000, "g", D)])
    a = {r.check: r.bad_rows for r in Q.audit_flights(f).collect()}
    assert a == {"from_differs_to": 1, "distance_in_range": 0, "time_matches_distance": 0,
                 "price_in_class_band": 0}
    h = hotels_df(spark, [(2, 1, "H", "Y", 2, 100.0, 200.0, D), (2, 1, "H", "Q", 2, 100.0, 201.0, D)])
    b = {r.check: r.bad_rows for r in Q.audit_hotels(h, f.unionByName(f)).collect()}
    assert b == {"total_matches_days_price": 1, "days_in_range": 0, "price_in_range": 0,
                 "place_is_flight_destination": 1}
