import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from wayfare.sources import sinks
from wayfare.sources.tables import read_table, scan_tables


def test_csv_round_trip_with_fixed_schema(spark, tmp_path):
    rows = "code,company,name,gender,age\n1,A,Ann Lee,female,30\n2,B,Bo Li,male,\n"
    (tmp_path / "users.csv").write_text(rows)
    fl = ("travelCode,userCode,from,to,flightType,price,time,distance,agency,date\n"
          "1,1,X,Y,economic,NaN,1.5,500,ag,2024-06-01\n2,2,Y,X,business,300.5,2.0,900,ag,2024-06-02\n")
    (tmp_path / "flights.csv").write_text(fl)
    (tmp_path / "hotels.csv").write_text("travelCode,userCode,name,place,days,price,total,date\n")
    u, f, h = scan_tables(spark, str(tmp_path))
    assert dict(u.dtypes)["age"] == "int" and u.where("age is null").count() == 1
    r = {x.travelCode: x for x in f.collect()}
    assert r[1].price is None          # NaN -> NULL
    assert r[2].date == dt.date(2024, 6, 2)
    assert h.count() == 0


def test_bad_date_fails(spark, tmp_path):
    (tmp_path / "f.csv").write_text("travelCode,userCode,from,to,flightType,price,time,distance,agency,date\n"
                                    "1,1,X,Y,e,1.0,1.0,500,a,not-a-date\n")
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path / "f.csv"), "flights").collect()


def test_processed_sink_round_trip(spark, tmp_path):
    from wayfare.sources.tables import FLIGHTS_SCHEMA, HOTELS_SCHEMA
    f = spark.createDataFrame([(1, 1, "X", "Y", "e", 10.25, 1.0, 500, "a", dt.date(2024, 1, 1))], FLIGHTS_SCHEMA)
    h = spark.createDataFrame([(1, 1, "H", "Y", 2, 5.0, 10.0, dt.date(2024, 1, 1))], HOTELS_SCHEMA)
    out = str(tmp_path / "p")
    for fmt in ("parquet", "csv"):
        sinks.write_processed({"flights": f, "hotels": h}, out + fmt, fmt)
        back = sinks.read_processed(spark, out + fmt, fmt, ("flights", "hotels"))
        s = {r.table: (r.rows, r.checksum) for r in sinks.processed_summary(back).collect()}
        assert s == {"flights": (1, 10.25), "hotels": (1, 10.0)}
