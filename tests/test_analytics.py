import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfare.operators import analytics as an
from wayfare.operators import quantiles as Q
from small_tables import flights_df, hotels_df, users_df

D1, D2 = dt.date(2024, 1, 5), dt.date(2024, 2, 7)


@pytest.fixture(scope="module")
def t(spark):
    users = users_df(spark, [(1, "A", "a", "male", 25), (2, "B", "b", "female", 26), (3, "A", "c", "male", 101),
                             (4, "B", "d", None, 40)])
    flights = flights_df(spark, [
        (1, 1, "X", "Y", "economic", 100.0, 2.0, 1000, "g1", D1),
        (2, 1, "X", "Y", "economic", 200.0, 2.0, 1000, "g1", D2),
        (3, 2, "Y", "X", "business", 300.0, 2.0, 1000, "g2", D2),
        (4, 2, "Z", "X", "firstClass", 5000.0, 2.0, 1000, "g2", D2),
        (5, None, "Z", None, None, None, None, None, None, None),
    ])
    hotels = hotels_df(spark, [(1, 1, "H", "Y", 2, 100.0, 200.0, D1)])
    return users, flights, hotels


def test_shares_sum_to_one(t):
    _, f, _ = t
    rows = an.category_share(f, "flightType").collect()
    assert abs(sum(r.share for r in rows) - 1.0) < 1e-12
    assert {r.flightType for r in rows} == {"economic", "business", "firstClass"}


def test_top_counts_tie_order(t):
    u, _, _ = t
    rows = an.top_counts(u, "company", 1).collect()
    assert [(r.company, r["count"]) for r in rows] == [("A", 2)]
    rows = an.top_counts(u.where("code in (1, 2)"), "company", 1).collect()
    assert rows[0].company == "A"  # equal counts: key ascending


def test_spend_by_age_all_labels(t):
    u, f, _ = t
    rows = {r.age_group: r.avg_spent for r in an.spend_by_age(u, f).collect()}
    assert set(rows) == {"18-25", "26-35", "36-45", "46-55", "55+"}
    assert rows["18-25"] == 300.0 and rows["26-35"] == 5300.0 and rows["46-55"] is None
    assert rows["36-45"] == 0.0  # user 4 has no flights -> 0 spend


def test_monthly_trend_and_routes(t):
    _, f, _ = t
    m = {r.month: (r.bookings, r.revenue) for r in an.monthly_trend(f).collect()}
    assert m == {"2024-01": (1, 100.0), "2024-02": (3, 5500.0)}
    r = an.top_routes(f, 10).collect()
    assert r[0].route == "X → Y" and r[0].bookings == 2


def test_histogram_empty_bins(t):
    u, _, _ = t
    h = an.histogram(u, "age", 4).orderBy("bin").collect()
    assert len(h) == 4 and sum(r["count"] for r in h) == 4 and h[0].bin_start == 25.0
    assert [r["count"] for r in h] == [3, 0, 0, 1]  # width 19: 25, 26, 40 | - | - | 101


def test_price_box(t):
    _, f, _ = t
    b = {r.flightType: r for r in an.price_box(f).collect()}
    e = b["economic"]
    assert (e.q1, e.median, e.q3) == (125.0, 150.0, 175.0) and e.outliers == 0


def test_similar_flights_fallback(spark, t):
    _, f, _ = t
    req = spark.createDataFrame([(1, "X", "economic", 120.0), (2, "Q", "business", 200.0), (3, "Q", "economy", 1.0)],
                                "request_id long, from string, flightType string, pred double")
    r = {x.request_id: x for x in an.similar_flights(req, f, "pred").collect()}
    assert r[1].basis == "route" and r[1].similar_avg_price == 150.0 and r[1].difference == -30.0
    assert r[2].basis == "type" and r[2].similar_avg_price == 300.0
    assert r[3].basis is None


def test_unknown_cities(spark, t):
    _, f, _ = t
    req = spark.createDataFrame([(1, "X", "X"), (2, "Atlantis", None), (3, None, "Lemuria"), (4, "", "X"), (5, "Atlantis", "Mu")],
                                "request_id long, from string, to string")
    got = {(r.request_id, r.field, r.city) for r in an.unknown_cities(req, f).collect()}
    assert got == {(2, "from", "Atlantis"), (3, "to", "Lemuria"), (5, "from", "Atlantis"), (5, "to", "Mu")}


def test_quantiles_with_an_extreme_value(spark):
    import numpy as np
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.random(4000), [1e15]])
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 1.0), ("b", 1.0), ("c", 2.0), (None, 1.0)], "g string, x double")
    counts = df.where("g IS NOT NULL").groupBy("g", "x").agg(F.count(F.lit(1)).alias("_c"))
    ranged = Q.in_value_order(counts, ["g"], "x")
    longest = max(r["n"] for r in ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect())
    assert longest < 0.6 * len(values), "no task ranks a whole group"
    got = {r["g"]: r for r in Q.exact_quantiles(df, "g", "x", [0.0, 0.25, 0.5, 0.99, 1.0]).collect()}
    want = np.quantile(values, [0.0, 0.25, 0.5, 0.99, 1.0])
    assert np.allclose([got["a"][f"q{i}"] for i in range(5)], want, rtol=1e-12)
    assert got["b"]["q2"] == 1.0 and got["c"]["q0"] == 2.0 and set(got) == {"a", "b", "c"}



def test_brackets_move_a_small_part_and_wrong_ones_are_noticed(spark, monkeypatch):
    import numpy as np
    rng = np.random.default_rng(5)
    values = {g: rng.normal(size=20_000) for g in "ab"}
    df = spark.createDataFrame([(g, float(v)) for g in "ab" for v in values[g]], "g string, x double")
    bound = Q.brackets(df, "g", "x", [0.25, 0.5, 0.75], 1000)
    moved = Q.inside(df, "g", "x", bound).where("x IS NOT NULL").agg(F.sum("_c")).first()[0]
    assert moved < 0.05 * 40_000
    plain = Q.brackets

    def off(rows, group, value, probs, accuracy):
        """Brackets that miss group b's ranks, below and above."""
        shift = lambda t: F.struct(t["i"].alias("i"), t["pos"].alias("pos"), (t["lo"] + 1 - t["i"]).alias("lo"), (t["hi"] + 1 - t["i"]).alias("hi"))
        t = plain(rows, group, value, probs, accuracy)
        return t.withColumn("_t", F.when(F.col("g") == "b", F.transform("_t", shift)).otherwise(F.col("_t")))
    for f in (plain, off):
        monkeypatch.setattr(Q, "brackets", f)
        for r in Q.exact_quantiles(df, "g", "x", [0.25, 0.5, 0.75], accuracy=1000).collect():
            assert [r["q0"], r["q1"], r["q2"]] == pytest.approx(np.quantile(values[r["g"]], [0.25, 0.5, 0.75]).tolist(), rel=1e-12)
            assert (r["n"], r["min"], r["max"]) == (20_000, values[r["g"]].min(), values[r["g"]].max())


def test_sample_points_reproducible(t):
    _, f, _ = t
    a = an.sample_points(f, 3).collect()
    b = an.sample_points(f.repartition(3), 3).collect()
    assert a == b and len(a) == 3


def test_kpis(t):
    u, f, h = t
    k = an.kpi_metrics(u, f, h).first()
    assert k.total_revenue == 5800.0 and k.active_users == 4 and k.avg_hotel_spend == 200.0


def test_exact_quantiles_match_numpy_on_skewed_groups(spark):
    import collections

    import numpy as np
    rng = np.random.default_rng(1)
    # a hot value holding most of a group, a far outlier (all other values
    # fall in the first histogram bucket), single-row and all-equal groups
    rows = [("hot", float(x)) for x in np.concatenate([np.full(3000, 5.0), rng.exponential(10, 2000), [1e9]])]
    rows += [("one", 3.0), ("two", 1.0), ("two", 2.0)] + [("dup", 7.0)] * 10 + [(None, 1.0), ("two", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.999, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(len(probs))]
           for r in Q.exact_quantiles(df, "g", "v", probs).collect()}
    d = collections.defaultdict(list)
    for g, v in rows:
        if g is not None and v is not None:
            d[g].append(v)
    assert set(got) == set(d)
    for g, vs in d.items():
        exp = [float(np.quantile(np.array(vs), p)) for p in probs]
        assert got[g] == pytest.approx(exp, rel=1e-12, abs=1e-12), g
