import os

import pytest

from wayfare.operators.quality import DataQualityError
from wayfare.plans.jobs import daily_pipeline
from wayfare.sources import adapters as A
from wayfare.sources import staged

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_daily_pipeline_end_to_end(spark, tmp_path):
    u, f, h = A.booking_tables(spark, SF)
    with pytest.raises(DataQualityError, match="flights_no_nulls"):
        daily_pipeline(spark, u, f, h, str(tmp_path), num_trees=10)
    assert staged.newest(spark, str(tmp_path / "processed")) is None, "a failed run is not published"
    f = f.where("userCode IS NOT NULL")
    rep = {(r.section, r.metric): r.value for r in daily_pipeline(spark, u, f, h, str(tmp_path), num_trees=10).collect()}
    assert rep[("data", "users")] == u.count()
    assert {("flight_price_model", "rmse"), ("flight_price_model", "r2"),
            ("gender_classifier", "accuracy"), ("gender_classifier", "f1")} <= set(rep)
    assert 0.0 <= rep[("gender_classifier", "accuracy")] <= 1.0
    _, run = staged.newest(spark, str(tmp_path / "processed"))
    for p in (f"processed/{run}/flights_processed", f"processed/{run}/users_processed", "models/flight_price", "models/gender",
              "models/recommender/hotel_features", "report"):
        assert os.path.isdir(tmp_path / p), p
