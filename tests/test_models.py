"""Training, evaluation, run log and scoring on the wide table."""

import pytest
from pyspark.sql import functions as F

from fleetfeatures.catalogue.modelling import SMALL_GRIDS, TRAIN_END, VALID_END
from fleetfeatures.catalogue.views import ORDER, trip_tables
from fleetfeatures.operators import models
from fleetfeatures.operators.features import load_preprocessing
from fleetfeatures.operators.rows import newest
from fleetfeatures.plans import merge, score, train
from fleetfeatures.session import cut_lineage


@pytest.fixture(scope="module")
def wide(spark):
    return cut_lineage(merge.wide_trips(trip_tables(spark, "/root/testdata/sf0.01"), ORDER, hot=merge.HotKeys()))


def test_frames_are_encoded_and_scaled_on_train(spark, wide):
    frames = train.build_frames(wide, TRAIN_END, VALID_END)
    counts = [f.count() for f in (frames.train, frames.valid, frames.test)]
    assert sum(counts) == wide.count() and min(counts) > 0
    row = frames.train.agg(F.avg("temp_origin"), F.stddev_pop("temp_origin"), F.max("precip_origin")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1) and row[2] == 0.0
    assert set(frames.features) <= set(frames.valid.columns) == set(frames.test.columns)
    assert "fuel_type_BUILDING" in frames.features and "fuel_type" not in frames.train.columns


def test_train_log_and_score(spark, wide, tmp_path):
    grids = {name: SMALL_GRIDS[name] for name in ("Logistic_Regression", "Random_Forest")}
    evaluation = train.train_models(wide, str(tmp_path / "out"), grids, TRAIN_END, VALID_END)
    rows = {(r.model, r.part): r for r in evaluation.collect()}
    assert len(rows) == 6 and all(0 <= r.accuracy <= 1 for r in rows.values())
    assert rows["Random_Forest", "train"].accuracy > 0.5
    runs = spark.read.parquet(str(tmp_path / "out" / "runs"))
    assert runs.count() == 2 and newest(runs, "start_time", ["run_id"]).count() == 1
    logged = {r.key for r in spark.read.parquet(str(tmp_path / "out" / "metrics")).collect()}
    assert {"accuracy", "val_f1_score", "test_recall"} <= logged
    assert "regParam" in {r.key for r in spark.read.parquet(str(tmp_path / "out" / "params")).collect()}

    chosen = score.choose_trips(wide, dates=("2024-01-10", "2024-01-20"), route="click")
    scored = score.score_saved(spark, str(tmp_path / "out" / "best"), chosen)
    assert scored.count() == chosen.count() > 0
    assert sorted(scored.columns) == sorted(wide.columns)
    assert {r.delay for r in scored.select("delay").distinct().collect()} <= {0, 1}
    own = [c for c in wide.columns if c != "delay"]
    assert sorted(scored.select(own).collect(), key=lambda r: r.unique_id) == sorted(
        chosen.select(own).collect(), key=lambda r: r.unique_id)
    encoding, scaling = load_preprocessing(spark, str(tmp_path / "out" / "best"))
    assert len(scaling) == 27 and ("gender", "female") in encoding
    with pytest.raises(ValueError, match="missing"):
        score.score_saved(spark, str(tmp_path / "out" / "best"), chosen.drop("gender"))


def test_category_names_may_hold_anything(spark):
    names = ["sky_St. Rain", "sky_a`b", "sky_two words"]
    rows = [(float(i % 2), float(i % 3), float(i % 5), i % 2, i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, [*names, "delay", "fold"])
    fitted = models.grid_search("Logistic_Regression", df, names, {"C": [1.0], "maxIter": [5]})
    scored = models.predict(fitted.model, df)
    assert scored.columns == [*df.columns, "prediction"] and scored.count() == 60
    assert fitted.params["regParam"] == pytest.approx(1 / 60)


def test_first_of_equally_good_models_is_picked(spark):
    evaluation = spark.createDataFrame(
        [(0, "A", "valid", 0.8), (1, "B", "valid", 0.9), (2, "C", "valid", 0.9), (0, "A", "train", 1.0)],
        "position int, model string, part string, accuracy double")
    assert train.pick_best(evaluation) == "B"
    assert train.pick_best(evaluation, "train") == "A"
    with pytest.raises(ValueError):
        train.pick_best(evaluation, "test")
