"""Classification metrics from (label, prediction) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_class(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class; a zero denominator gives 0.

    The rows are counted per (label, prediction) once; all else is on the few
    counts. Every count serves twice, as a row of its label and as a row of its
    prediction, so no join is needed. ``by`` rates several sets of rows at once.
    """
    cells = (df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
             .groupBy(*by, F.col(label).cast("double").alias("l"), F.col(prediction).cast("double").alias("p"))
             .agg(F.count("*").alias("n")))
    hit = F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("l").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 hit.cast("long").alias("hits")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("hits")))
    totals = cells.select(*by, F.inline(sides)).groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
    rated = totals.withColumns({
        "precision": F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0)),
        "recall": F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))})
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rated.withColumn("f1", F.coalesce(f1, F.lit(0.0)))


def scores(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted F1, precision and recall, one row per ``by`` group."""
    weighted = {m: F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support"))
                for m in ("f1", "precision", "recall")}
    return per_class(df, label, prediction, by).groupBy(*by).agg(
        F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        weighted["f1"].alias("f1_score"), weighted["precision"].alias("precision"),
        weighted["recall"].alias("recall"))


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """A row per class, then accuracy, plain and support-weighted averages."""
    rated = per_class(df, label, prediction)
    measures = ("precision", "recall", "f1")
    classes = rated.select(F.col("class").cast("int").cast("string").alias("row"), *measures, "support")
    total = F.sum("support").alias("support")
    accuracy = F.try_divide(F.sum("hits"), F.sum("support"))
    summary = rated.agg(
        F.struct(*[F.avg(m).alias(m) for m in measures], total).alias("macro avg"),
        F.struct(*[F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m)
                   for m in measures], total).alias("weighted avg"),
        F.struct(*[accuracy.alias(m) for m in measures], total).alias("accuracy"))
    parts = [F.struct(F.lit(name).alias("row"), *[F.col(f"`{name}`.{m}").alias(m) for m in (*measures, "support")])
             for name in ("accuracy", "macro avg", "weighted avg")]
    return classes.unionByName(summary.select(F.inline(F.array(*parts))))
