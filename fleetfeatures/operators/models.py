"""Classifiers, stratified folds and grid search on Spark ML (M3-M6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetfeatures.constants import BOOSTED_GRID, FOLDS, FOREST_GRID, LOGISTIC_GRID, TARGET
from fleetfeatures.operators.joins import join_on

Grid = Mapping[str, Sequence[Any]]
SEED = 42


@dataclass(frozen=True)
class Fitted:
    """The refitted best model of one grid, its parameters and mean fold accuracy."""

    name: str
    model: PipelineModel
    params: dict[str, Any]
    fold_accuracy: float


def estimator(name: str) -> Any:
    """M3-M5: the untrained classifier."""
    common = {"featuresCol": "features", "labelCol": TARGET, "predictionCol": "prediction"}
    if name == "Logistic_Regression":
        # the penalty is on the columns as they come, and C counts the rows a fit sees
        return LogisticRegression(elasticNetParam=0.0, standardization=False, **common)
    if name == "Random_Forest":
        return RandomForestClassifier(seed=SEED, **common)
    if name == "Boosted_Trees":
        return GBTClassifier(seed=SEED, **common)
    raise ValueError(f"no classifier named {name}")


def default_grids() -> dict[str, Grid]:
    """The full parameter grids."""
    return {"Logistic_Regression": LOGISTIC_GRID, "Random_Forest": FOREST_GRID, "Boosted_Trees": BOOSTED_GRID}


#: Rows of a label that are numbered in one task, on average.
FOLD_ROWS = 1 << 20


def with_folds(df: DataFrame, keys: Sequence[str], folds: int = FOLDS, label: str = TARGET, *, rows: int = FOLD_ROWS) -> DataFrame:
    """M6: a ``fold`` column; every fold has each label in the same share, to within a row.

    A hash of the keys deals the rows into parts. Rows are numbered inside a
    label and part, in the order of another hash, and the counts per label and
    part say where each part's numbers go on; consecutive numbers go round the
    folds. One shuffle, no sort of the whole frame and no copy of it; the folds
    depend on the keys alone, not on how the frame is partitioned.
    """
    parts = max(8, -(-df.count() // rows))
    dealt = df.withColumns({"__part": F.pmod(F.xxhash64(*keys), F.lit(parts)), "__mix": F.xxhash64(F.lit(SEED), *keys)})
    before = Window.partitionBy(label).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(label, "__part").agg(F.count("*").alias("__size"))
    starts = sizes.select(label, "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(label, "__part").orderBy("__mix", *keys)
    numbered = join_on(dealt.withColumn("__place", F.row_number().over(inside) - 1), starts, [label, "__part"])
    return numbered.withColumn("fold", F.pmod(F.col("__start") + F.col("__place"), F.lit(folds)).cast("int")).drop("__part", "__mix", "__place", "__start")


def grid_search(name: str, train: DataFrame, features: Sequence[str] | str, grid: Grid, *, folds: int = FOLDS,
                parallelism: int = 4) -> Fitted:
    """M6: every parameter choice on every fold, best mean accuracy refitted on all of ``train``.

    ``train`` has flat double features, the label and ``fold``. The vector is
    assembled once and shared by all fits. A single name stands for a column
    ``features`` of vectors that are there already (:mod:`operators.sparse`).
    """
    if isinstance(features, str):
        assembled = train.withColumn(TARGET, F.col(TARGET).cast("double")).withColumnRenamed(features, "features")
        return _search(name, assembled, [], grid, folds, parallelism)
    # categories are in the names, and a dot or quote there would be read as a path to a field
    plain = [f"__feature_{i}" for i in range(len(features))]
    named = ", ".join(f"`{f.replace('`', '``')}` AS {p}" for f, p in zip(features, plain))
    renamer = SQLTransformer(statement=f"SELECT *, {named} FROM __THIS__")
    assembler = VectorAssembler(inputCols=plain, outputCol="features")
    labelled = train.withColumn(TARGET, F.col(TARGET).cast("double"))
    return _search(name, assembler.transform(renamer.transform(labelled)), [renamer, assembler], grid, folds, parallelism)


def _search(name: str, assembled: DataFrame, stages: list, grid: Grid, folds: int, parallelism: int) -> Fitted:
    classifier = estimator(name)
    vectors = assembled.select("features", TARGET, "fold").persist()
    try:
        builder = ParamGridBuilder()
        if "C" in grid:
            rows = vectors.count()
            builder = builder.addGrid(classifier.regParam, [1.0 / (c * rows) for c in grid["C"]])
        for param, values in grid.items():
            if param != "C":
                builder = builder.addGrid(getattr(classifier, param), list(values))
        accuracy = MulticlassClassificationEvaluator(labelCol=TARGET, metricName="accuracy")
        search = CrossValidator(estimator=classifier, estimatorParamMaps=builder.build(), evaluator=accuracy,
                                numFolds=folds, foldCol="fold", parallelism=parallelism)
        found = search.fit(vectors)
    finally:
        vectors.unpersist()
    best = max(range(len(found.avgMetrics)), key=lambda i: found.avgMetrics[i])
    chosen = {p.name: v for p, v in found.getEstimatorParamMaps()[best].items()}
    return Fitted(name, PipelineModel([*stages, found.bestModel]), chosen, found.avgMetrics[best])


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Predicted class in ``prediction``; no helper columns stay."""
    scored = model.transform(df)
    return scored.drop("features", "rawPrediction", "probability", *[c for c in scored.columns if c.startswith("__feature_")])
