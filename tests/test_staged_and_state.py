"""Checked publication (one scan per table) and mergeable flight state."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from small_tables import flights_df, hotels_df, users_df

from wayfare.operators import analytics as an
from wayfare.operators import features as FT
from wayfare.operators import state as ST
from wayfare.operators.quality import DataQualityError
from wayfare.sources import staged

D0 = dt.date(2023, 1, 1)


def flight(k, user, price, day, kind="economic"):
    return (k, user, "A", "B", kind, price, 2.5, 700 + k, "CloudFy", D0 + dt.timedelta(days=day))


def sources(spark, bad_price=False):
    u = users_df(spark, [(1, "C", "n", "male", 30), (2, "C", "m", "female", 40)])
    f = flights_df(spark, [flight(k, 1 + k % 2, 100.0 + k, k) for k in range(20)] + ([flight(99, 1, -1.0, 1), flight(98, 1, 0.0, 1)] if bad_price else []))
    h = hotels_df(spark, [(1, 1, "H", "P", 2, 50.0, 100.0, D0), (2, 2, "H", "P", 2, 50.0, 0.0, D0), (3, 2, "H", "P", 1, 5.0, None, D0)])
    return staged.booking_sources(u, f, h)


def test_publish_splits_counts_and_marks(spark, tmp_path):
    out = str(tmp_path)
    s = sources(spark)
    report, good = staged.publish(spark, s, out, "a")
    assert good and staged.newest(spark, out) == (1, "a")
    got = {(r["table"], r["check"]): (r["passed"], r["bad_rows"], r["rows_before"], r["rows_after"]) for r in report.collect()}
    assert got[("hotels", "totals_positive")] == (False, 2, 3, 1) and got[("flights", "prices_positive")] == (True, 0, 20, 20)
    h = s["hotels"].table
    assert [r["travelCode"] for r in staged.read_published(spark, out, "hotels", h.schema).collect()] == [1]
    thrown = {r["travelCode"]: r["_reasons"] for r in staged.read_published(spark, out, "hotels", h.schema, "quarantine").collect()}
    assert thrown == {2: ["totals_positive"], 3: ["totals_positive"]}


def test_nothing_is_published_on_failure_and_readers_keep_the_last_good_run(spark, tmp_path):
    out = str(tmp_path)
    staged.publish(spark, sources(spark), out, "good")
    report, good = staged.publish(spark, sources(spark, bad_price=True), out, "bad")
    assert not good and staged.newest(spark, out) == (1, "good")
    with pytest.raises(DataQualityError, match="flights.prices_positive .2 bad."):
        staged.raise_unless(report, good)
    schema = sources(spark)["flights"].table.schema
    assert staged.read_published(spark, out, "flights", schema).count() == 20
    empty = sources(spark)
    empty["users"].table = empty["users"].table.limit(0)
    assert not staged.publish(spark, empty, out, "empty")[1]
    with pytest.raises(ValueError):
        staged.read_published(spark, out + "/none", "flights", schema)
    staged.publish(spark, sources(spark), out, "later")
    assert staged.newest(spark, out) == (2, "later")


def test_one_scan_per_raw_table(spark, tmp_path):
    """A scan is a read of the raw rows: counted by an accumulator in their plan."""
    raw = sources(spark)["flights"].table
    path = str(tmp_path / "raw")
    raw.repartition(2).write.parquet(path)
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: (seen.add(1), x)[1], "double").asNondeterministic()
    s = sources(spark)
    s["flights"].table = spark.read.schema(raw.schema).parquet(path).withColumn("price", count("price"))
    staged.publish(spark, s, str(tmp_path / "out"))
    assert seen.value == 20


def as_rows(df, key):
    return {r[key]: {c: v for c, v in r.asDict().items() if c != key} for r in df.collect()}


def same(got, want):
    assert set(got) == set(want)
    for k in want:
        for c, v in want[k].items():
            assert got[k][c] == (pytest.approx(v, rel=1e-9, abs=1e-9) if v is not None else None), (k, c)


def test_state_after_many_days_equals_a_full_recompute(spark, tmp_path):
    rows = {d: [flight(100 * d + k, None if k == 7 else 1 + (d + k) % 5, 10.0 + d * k + 0.37, d, "firstClass" if k % 3 == 0 else "economic")
                for k in range(8)] for d in range(10)}
    rows[4][2] = flight(402, 3, None, 4)
    rows[5] = [(*r[:7], None, *r[8:]) if k == 1 else r for k, r in enumerate(rows[5])]
    state = ST.FlightState(spark, str(tmp_path))
    now = {}

    def run(days, emptied=()):
        state.apply(flights_df(spark, [r for d in days for r in now[d]]), [D0 + dt.timedelta(days=d) for d in emptied])
        whole = flights_df(spark, [r for d in sorted(now) for r in now[d]])
        same(as_rows(state.flight_agg(), "userCode"), as_rows(FT.flight_agg(whole), "userCode"))
        same(as_rows(state.monthly_trend(), "month"), as_rows(an.monthly_trend(whole), "month"))
        users = whole.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("userCode")).alias("active_users"))
        same(as_rows(state.active_users(), "month"), as_rows(users, "month"))
    now |= {d: rows[d] for d in (0, 1, 2, 4, 5)}
    run([0, 1, 2, 4, 5])
    now[6] = rows[6]
    run([6])
    now |= {3: rows[3], 1: rows[1][:2], 7: rows[7]}  # a late day, a corrected one, a new one
    run([1, 3, 7])
    now[2] = []
    run([], emptied=[2])
    now |= {2: rows[2], 8: [flight(900, 9, 5.0, 8)]}
    run([2, 8])
    now[8] = [flight(900, 4, 6.0, 8)]  # user 9 goes away again
    run([8])
    run([])


def test_a_run_that_dies_changes_nothing(spark, tmp_path):
    state = ST.FlightState(spark, str(tmp_path))
    day = flights_df(spark, [flight(1, 1, 5.0, 0), flight(2, 2, 7.0, 0)])
    state.apply(day)
    before = as_rows(state.flight_agg(), "userCode")
    # What a run writes before its manifest rows.
    state._write(ST.day_partials(day), "user_day", "000002-dead")
    state._write(ST.day_summary(day), "day", "000002-dead")
    same(as_rows(state.flight_agg(), "userCode"), before)
    state.apply(day)
    same(as_rows(state.flight_agg(), "userCode"), before)
    assert len(glob.glob(os.path.join(str(tmp_path), "total", "*"))) == 2


def test_a_run_reads_only_the_days_it_replaces(spark, tmp_path):
    state = ST.FlightState(spark, str(tmp_path))
    state.apply(flights_df(spark, [flight(d, 1, 5.0 + d, d) for d in range(60)]))
    _, days, _ = state.current()
    old = state._days("user_day", state.USER_DAY, {d: run for d, run in days.items() if d == D0})
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(day" in plan or "In(day" in plan
    assert old.count() == 1


def test_quantiles_read_their_input_once(spark, monkeypatch):
    from wayfare.operators import quantiles as Q
    names, plain = [], Q.written
    monkeypatch.setattr(Q, "written", lambda df, name: names.append(name) or plain(df, name))
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), (None, 1.0), ("b", None)], "g string, v double")
    got = Q.exact_quantiles(df, "g", "v", [0.5]).collect()
    assert names[0] == "quantile-rows" and [(r["g"], r["n"], r["q0"]) for r in got] == [("a", 3, 2.0)]


def booking_base(spark, folder):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    import datetime
    put("customer", [(k, f"c{k}", "BUILDING", k % 2) for k in range(1, 5)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey int")
    put("supplier", [(1, 0), (2, 1)], "s_suppkey long, s_nationkey int")
    put("part", [(1, "Brand#1"), (2, "Brand#2")], "p_partkey long, p_brand string")
    put("nation", [(0, "A"), (1, "B")], "n_nationkey int, n_name string")
    put("orders", [(k, 1 + k % 4, "1-URGENT") for k in range(1, 13)], "o_orderkey long, o_custkey long, o_orderpriority string")
    put("lineitem", [(1 + k % 12, 1 + k % 2, 1 + k % 2, float(1 + k % 9), 100.0 + k, 0.01, "ANR"[k % 3], datetime.datetime(2020, 1, 1 + k % 28))
                     for k in range(60)], "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
        "l_tax double, l_returnflag string, l_shipdate timestamp")


def test_line_items_are_merged_with_orders(spark, tmp_path):
    from wayfare.sources import adapters as A
    booking_base(spark, str(tmp_path))
    for view in (A.flights, A.hotels):
        df = view(spark, str(tmp_path))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 60 and "SortMergeJoin [l_orderkey" in plan


def test_tasks_of_the_order_join_grow_with_the_rows(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from wayfare.sources import adapters as A
    booking_base(spark, str(tmp_path))
    sides = [A.base(spark, str(tmp_path), t) for t in ("lineitem", "orders")]
    assert A.join_tasks(spark, *sides) == 0, "72 rows are left to Spark"
    for rows_a_task in (10_000, 6):
        monkeypatch.setattr(A, "TASK_ROWS", rows_a_task)
        got = [sorted(map(str, view.collect())) for view in A.booking_tables(spark, str(tmp_path))]
        if rows_a_task == 10_000:
            left = got
    assert got == left and len(got[1]) == len(got[2]) == 60
    assert A.join_tasks(spark, *sides) == 12
    for view in A.booking_tables(spark, str(tmp_path))[1:]:
        held = view.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("travelCode").alias("keys")).collect()
        assert len(held) > 4 and sum(r["keys"] for r in held) == 12, "Spark alone would make one partition of them"


def test_stored_differences_counts_rows_of_both_sides(spark):
    from wayfare.plans.q_ml import stored_differences
    schema = "a long, b string"
    one = spark.createDataFrame([(1, "x"), (1, "x"), (None, None), (2, "y")], schema)
    two = spark.createDataFrame([(1, "x"), (None, None), (2, "z"), (2, "z")], schema)
    assert tuple(stored_differences(one, two).first()) == (4, 4)
    assert tuple(stored_differences(one, one).first()) == (4, 0)
    assert tuple(stored_differences(one.limit(0), one.limit(0)).first()) == (0, 0)
    lost = one.exceptAll(two).unionByName(two.exceptAll(one)).count()
    assert lost == 4
