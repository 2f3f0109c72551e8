import os

import pytest

from wayfare.ml import features as MF
from wayfare.ml import split as SP
from wayfare.ml import train as T
from wayfare.sources import adapters as A
from wayfare.streaming.scoring import score_requests, start_price_scoring

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_stream_scores_every_request_once(spark, tmp_path):
    f = A.flights(spark, SF)
    dicts = MF.flight_dictionaries(f)
    ff = MF.flight_features(f, dicts, keep=["travelCode"]).where(SP.split_flag("travelCode"))
    model = T.train_price_model(ff, MF.FLIGHT_FEATURES, "ridge")
    req = A.price_requests(f)
    src = str(tmp_path / "requests")
    req.repartition(3).write.parquet(src)
    q = start_price_scoring(spark, src, str(tmp_path / "out"), model, dicts,
                            checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == req.count()
    batch = score_requests(req, model, dicts)
    a = sorted((r.request_id, r.predicted_price, r.error) for r in got.collect())
    b = sorted((r.request_id, r.predicted_price, r.error) for r in batch.collect())
    assert a == b
    # restart: nothing new, nothing duplicated
    q2 = start_price_scoring(spark, src, str(tmp_path / "out"), model, dicts, checkpoint=str(tmp_path / "ckpt"))
    q2.awaitTermination(300)
    assert spark.read.parquet(str(tmp_path / "out")).count() == req.count()
