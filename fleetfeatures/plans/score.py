"""Score chosen trips with a saved model."""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfeatures.constants import CATEGORICAL, CONTINUOUS, TARGET
from fleetfeatures.operators.columns import available, missing_columns
from fleetfeatures.operators.features import (
    Encoding,
    Scaling,
    apply_one_hot,
    apply_scaling,
    load_preprocessing,
)
from fleetfeatures.operators.models import predict
from fleetfeatures.operators.rows import between_dates, where_equals


def choose_trips(wide: DataFrame, *, dates: tuple[str, str] | None = None, truck: object = None,
                 route: object = None, inclusive_day: bool = False) -> DataFrame:
    """Trips departing in a date range, of one truck, or of one route; the choices combine."""
    if dates:
        wide = between_dates(wide, "departure_date", *dates, inclusive_day=inclusive_day)
    if truck is not None:
        wide = where_equals(wide, "truck_id", truck)
    if route is not None:
        wide = where_equals(wide, "route_id", route)
    return wide


def preprocess(df: DataFrame, encoding: Encoding, scaling: Scaling) -> DataFrame:
    """Model inputs beside the trip's own columns, under names no own column has."""
    needed = available(df, CONTINUOUS + CATEGORICAL)
    lacking = missing_columns(df, [*scaling, *{c for c, _ in encoding}])
    if lacking:
        raise ValueError(f"missing columns: {lacking}")
    inputs = df.select(F.struct(*df.columns).alias("__trip"), *needed)
    return apply_scaling(apply_one_hot(inputs, encoding), scaling)


def score(model: Model, df: DataFrame, encoding: Encoding, scaling: Scaling) -> DataFrame:
    """The trips, unchanged but for ``delay``, which is the prediction."""
    predicted = predict(model, preprocess(df, encoding, scaling))
    own = [F.col(f"__trip.{c}").alias(c) for c in df.columns if c != TARGET]
    return predicted.select(*own, F.col("prediction").cast("int").alias(TARGET))


def score_saved(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """M12 with the model and preprocessing saved together under ``path``."""
    encoding, scaling = load_preprocessing(spark, path)
    return score(PipelineModel.load(f"{path}/model"), df, encoding, scaling)
