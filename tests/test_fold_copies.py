"""Folds are dealt once for all searches; a search reads rows, not the shuffle that deals them."""

from __future__ import annotations

from fleetfeatures.constants import TARGET
from fleetfeatures.operators.features import Encoding
from fleetfeatures.plans import train


def test_searches_read_folds_that_are_stored(spark, monkeypatch):
    rows = [(i, float(i % 7), i % 2) for i in range(120)]
    part = spark.createDataFrame(rows, f"unique_id long, x double, {TARGET} int")
    encoding: Encoding = []
    frames = train.Frames(part, part, part, encoding, {}, ["x"])
    given = []
    monkeypatch.setattr(train, "grid_search", lambda name, folded, *_, **__: given.append(folded))
    train.fit_models(frames, {"Logistic_Regression": {}, "Random_Forest": {}})
    for folded in given:
        assert "Window" not in folded._jdf.queryExecution().optimizedPlan().toString()
        assert folded.cache().rdd.getNumPartitions() <= 16
        folded.unpersist()
        counts = {(r[TARGET], r["fold"]): r["count"] for r in folded.groupBy(TARGET, "fold").count().collect()}
        assert counts == {(label, fold): 20 for label in (0, 1) for fold in range(3)}
