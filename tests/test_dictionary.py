"""Distributed dictionaries: many values, hot values, nulls and unseen ones."""

from pyspark.sql import functions as F

from wayfare.operators import dictionary as D


def test_a_million_values_without_a_single_task_stage(spark):
    df = spark.range(1_000_000).select(F.concat(F.lit("v"), F.pmod(F.col("id") * 7919, F.lit(1_000_000))).alias("x"))
    d = D.distributed_dictionary(df, ["x"])
    assert "SinglePartition" not in d._jdf.queryExecution().executedPlan().toString()
    got = d.agg(F.count(F.lit(1)).alias("n"), F.min("code").alias("a"), F.max("code").alias("b"), F.countDistinct("code").alias("d")).first()
    assert tuple(got) == (1_000_000, 0, 999_999, 1_000_000)
    some = {r["value"]: r["code"] for r in d.where("code % 100003 = 0").collect()}
    ordered = sorted(f"v{k}" for k in range(1_000_000))
    assert all(ordered[c] == v for v, c in some.items())


def test_encode_and_decode(spark):
    values = ["b"] * 4000 + [f"k{k:04d}" for k in range(3000)] + [None] * 50 + ["", "Ä", "a"]
    df = spark.createDataFrame([(k, v, k % 7) for k, v in enumerate(values)], "id long, x string, y int").repartition(5)
    d = D.distributed_dictionary(df, ["x", "y"])
    x = sorted({v for v in values if v is not None})
    assert {(r["field"], r["value"]): (r["code"], r["n"]) for r in d.collect()} == {
        **{("x", v): (k, values.count(v)) for k, v in enumerate(x)},
        **{("y", str(k)): (k, sum(i % 7 == k for i in range(len(values)))) for k in range(7)}}
    assert {r["value"] for r in D.hot_values(d.where("field = 'x'")).collect()} == {"b"}
    asked = df.unionByName(spark.createDataFrame([(-1, "new", 99)], "id long, x string, y int"))
    got = {r["id"]: r for r in D.encode_by(asked, d, ["x", "y"]).collect()}
    assert len(got) == len(values) + 1
    for k, v in enumerate(values):
        assert got[k]["x_encoded"] == (0 if v is None else x.index(v)) and got[k]["y_encoded"] == k % 7
    assert got[-1]["x_encoded"] == 0 == got[-1]["y_encoded"]
    strict = D.encode_by(asked, d, ["x"], unseen=None)
    back = {r["id"]: r["label"] for r in D.decode_by(strict, d, "x", "x_encoded", "label").collect()}
    assert back == {**dict(enumerate(values)), -1: None}
    assert D.distributed_dictionary(df.limit(0), ["x"]).count() == 0
    assert D.encode_by(asked, d.limit(0), ["x"]).agg(F.max("x_encoded")).first()[0] == 0
