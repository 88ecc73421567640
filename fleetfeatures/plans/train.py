"""Wide trips to fitted and compared models."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfeatures.constants import CATEGORICAL, CONTINUOUS, ENCODED, TARGET, TRAIN_UNTIL, VALID_UNTIL
from fleetfeatures.operators.columns import available
from fleetfeatures.operators.features import (
    Encoding,
    Scaling,
    apply_one_hot,
    apply_scaling,
    fit_one_hot,
    fit_scaling,
    one_hot_names,
    save_preprocessing,
)
from fleetfeatures.operators.metrics import scores
from fleetfeatures.operators.models import Fitted, Grid, default_grids, grid_search, predict, with_folds
from fleetfeatures.operators.rows import split_by_time
from fleetfeatures.session import cut_lineage

TRIP_ID = ["unique_id"]


@dataclass(frozen=True)
class Frames:
    """Encoded and scaled train, validation and test frames with what was fitted on train."""

    train: DataFrame
    valid: DataFrame
    test: DataFrame
    encoding: Encoding
    scaling: Scaling
    features: list[str]


def build_frames(wide: DataFrame, train_until: str = TRAIN_UNTIL, valid_until: str = VALID_UNTIL,
                 time_column: str = "estimated_arrival") -> Frames:
    """Split by time, encode and scale all three parts with what train holds.

    The parts are written to the shared folder: every fit and evaluation
    reads them, none should repeat the joins and encodings behind them.
    """
    parts = split_by_time(wide, time_column, train_until, valid_until)
    continuous, categorical = available(wide, CONTINUOUS), available(wide, CATEGORICAL)
    encoded = available(wide, ENCODED)
    keys = available(wide, TRIP_ID)
    encoding = fit_one_hot(parts[0], encoded)
    scaling = fit_scaling(parts[0], continuous)
    ready = []
    for part in parts:
        chosen = part.select(*keys, *continuous, *categorical, TARGET)
        ready.append(cut_lineage(apply_scaling(apply_one_hot(chosen, encoding), scaling)))
    features = continuous + [c for c in categorical if c not in encoded] + one_hot_names(encoding)
    return Frames(*ready, encoding, scaling, features)


def fit_models(frames: Frames, grids: Mapping[str, Grid] | None = None, *, parallelism: int = 4) -> list[Fitted]:
    """M7: one grid search per classifier. Fitted once; all evaluations use these models.

    The folds are dealt once and written for all searches. A forest's draws follow the partitions of its rows.
    """
    # a search runs hundreds of short jobs: stored, the folds have partitions by their size, not one per shuffle partition
    folded = cut_lineage(with_folds(frames.train, available(frames.train, TRIP_ID) or frames.features))
    return [grid_search(name, folded, frames.features, grid, parallelism=parallelism)
            for name, grid in (grids or default_grids()).items()]


def evaluate(fitted: Sequence[Fitted], frames: Frames) -> DataFrame:
    """M7-M9: accuracy and weighted scores of every model on train, validation and test."""
    parts = {"train": frames.train, "valid": frames.valid, "test": frames.test}
    together = None
    for part, df in parts.items():
        tagged = df.withColumn("part", F.lit(part))
        together = tagged if together is None else together.unionByName(tagged)
    rows = None
    for position, f in enumerate(fitted):
        row = scores(predict(f.model, together), TARGET, "prediction", ["part"]).select(
            F.lit(position).alias("position"), F.lit(f.name).alias("model"), "*")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def pick_best(evaluation: DataFrame, part: str = "valid") -> str:
    """O3: the model with the highest accuracy on ``part``, the first of equals."""
    row = (evaluation.where((F.col("part") == part) & F.col("accuracy").isNotNull())
           .agg(F.max_by("model", F.struct("accuracy", -F.col("position"))).alias("model")).first())
    if row["model"] is None:
        raise ValueError(f"no model was scored on {part}")
    return row["model"]


def save_model(fitted: Fitted, frames: Frames, path: str) -> None:
    """M7: the model and the preprocessing fitted with it, in one place."""
    spark = frames.train.sparkSession
    fitted.model.write().overwrite().save(f"{path}/model")
    save_preprocessing(spark, path, frames.encoding, frames.scaling)


# --- run log --------------------------------------------------------------

RUN_SCHEMA = "run_id string, run_name string, status string, start_time timestamp, end_time timestamp"
PARAM_SCHEMA = "run_id string, key string, value string"
METRIC_SCHEMA = "run_id string, key string, value double"
_METRIC_NAMES = {"train": "", "valid": "val_", "test": "test_"}


def log_runs(spark: SparkSession, fitted: Sequence[Fitted], evaluation: DataFrame, path: str,
             start: float | None = None) -> None:
    """Append one run per model: its parameters and its metrics, three narrow tables under ``path``."""
    end = time.time()
    ids = {f.name: uuid.uuid4().hex for f in fitted}
    runs = spark.createDataFrame([(ids[f.name], f.name, "FINISHED", start or end, end) for f in fitted],
                                 "run_id string, run_name string, status string, s double, e double")
    runs = runs.select("run_id", "run_name", "status", F.timestamp_seconds("s").alias("start_time"),
                       F.timestamp_seconds("e").alias("end_time"))
    params = [(ids[f.name], key, json.dumps(value)) for f in fitted for key, value in sorted(f.params.items())]
    # models x parts rows, each already an aggregate
    metrics = [(ids[r["model"]], f"{_METRIC_NAMES[r['part']]}{m}", r[m])
               for r in evaluation.collect() for m in ("accuracy", "f1_score", "precision", "recall")
               if r[m] is not None]
    runs.coalesce(1).write.mode("append").parquet(f"{path}/runs")
    spark.createDataFrame(params, PARAM_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/params")
    spark.createDataFrame(metrics, METRIC_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/metrics")


def train_models(wide: DataFrame, path: str, grids: Mapping[str, Grid] | None = None,
                 train_until: str = TRAIN_UNTIL, valid_until: str = VALID_UNTIL) -> DataFrame:
    """The training entry: split, fit, evaluate, log, save the best. Returns the evaluation."""
    spark, start = wide.sparkSession, time.time()
    frames = build_frames(wide, train_until, valid_until)
    fitted = fit_models(frames, grids)
    lines = evaluate(fitted, frames)
    evaluation = spark.createDataFrame(lines.collect(), lines.schema)
    log_runs(spark, fitted, evaluation, path, start)
    best = pick_best(evaluation)
    save_model(next(f for f in fitted if f.name == best), frames, f"{path}/best")
    return evaluation
