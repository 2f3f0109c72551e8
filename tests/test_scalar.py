import datetime as dt

from pyspark.sql import functions as F

from wayfare.functions import scalar as S


def test_age_group_right_closed(spark):
    df = spark.createDataFrame([(a,) for a in [0, 18, 25, 26, 35, 36, 55, 56, 100, 101]], "age int")
    got = dict(df.select("age", S.age_group("age").alias("g")).collect())
    assert got == {0: None, 18: "18-25", 25: "18-25", 26: "26-35", 35: "26-35", 36: "36-45",
                   55: "46-55", 56: "55+", 100: "55+", 101: None}


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 1),), (dt.date(2024, 6, 2),), (dt.date(2024, 6, 3),)], "d date")
    got = df.select(*S.date_features("d")).collect()
    assert [(r.day_of_week, r.is_weekend) for r in got] == [(5, 1), (6, 1), (0, 0)]


def test_day_name_map(spark):
    df = spark.createDataFrame([("Saturday",), ("Monday",), ("Funday",)], "n string")
    assert [r[0] for r in df.select(S.day_name_to_index("n")).collect()] == [5, 0, None]


def test_route_and_hotel_id(spark):
    df = spark.createDataFrame([("A", "B", "Hx_y", "P"), (None, "B", "H", None)], "f string, t string, n string, p string")
    r = df.select(S.route("f", "t").alias("r"), S.hotel_id("n", "p").alias("h"),
                  S.hotel_name_from_id(S.hotel_id("n", "p")).alias("name")).collect()
    assert r[0].r == "A → B" and r[0].h == "Hx_y_P" and r[0].name == "Hx"
    assert r[1].r is None and r[1].h is None


def test_exact_sum_order_independent(spark):
    vals = [(0.1,), (0.2,), (0.3,), (1e6 + 0.01,)] * 50
    a = spark.createDataFrame(vals, "x double").agg(S.exact_sum("x")).first()[0]
    b = spark.createDataFrame(list(reversed(vals)), "x double").repartition(7).agg(S.exact_sum("x")).first()[0]
    assert a == b


def test_round_and_stable(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.5,)], "x double")
    r = df.select(S.round_half_up("x", 2).alias("a"), S.stable("x", 0).alias("b")).collect()
    assert [x.b for x in r] == [1.0, 3.0, -1.0]
