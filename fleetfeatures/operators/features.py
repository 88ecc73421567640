"""One-hot columns and standard scaling, fitted on one frame and applied to others (M1, M2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_CATEGORIES = 10_000

Encoding = list[tuple[str, str | None]]
Scaling = dict[str, tuple[float, float]]


def fit_one_hot(train: DataFrame, columns: Sequence[str]) -> Encoding:
    """M1: the (column, category) pairs of the training rows, categories sorted, null last.

    Categories become columns, so a column with more than ``MOST_CATEGORIES``
    of them is refused rather than cut.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("value"))
                      for i, c in enumerate(columns)])
    found = train.select(F.inline(pairs)).distinct()
    rows = found.limit(MOST_CATEGORIES * len(columns) + 1).collect()
    by_column: dict[int, list[str | None]] = {i: [] for i in range(len(columns))}
    for r in rows:
        by_column[r["i"]].append(r["value"])
    for i, values in by_column.items():
        if len(values) > MOST_CATEGORIES:
            raise ValueError(f"{columns[i]} has more than {MOST_CATEGORIES} categories")
    return [(columns[i], v) for i in by_column
            for v in sorted(by_column[i], key=lambda v: (v is None, v or ""))]


def one_hot_names(encoding: Encoding) -> list[str]:
    """``<column>_<category>`` per pair."""
    return [f"{c}_{v}" for c, v in encoding]


def apply_one_hot(df: DataFrame, encoding: Encoding) -> DataFrame:
    """M1: a 0/1 double column per category in place of the encoded columns; unseen values are all 0."""
    encoded = {c for c, _ in encoding}
    flags = [F.when(F.col(c).cast("string").eqNullSafe(F.lit(v)), 1.0).otherwise(0.0).alias(name)
             for (c, v), name in zip(encoding, one_hot_names(encoding))]
    return df.select(*[F.col(c) for c in df.columns if c not in encoded], *flags)


def fit_scaling(train: DataFrame, columns: Sequence[str]) -> Scaling:
    """M2: mean and population deviation per column, one pass; a deviation of 0 counts as 1."""
    row = train.agg(*[F.struct(F.avg(c).cast("double").alias("m"), F.stddev_pop(c).alias("s")).alias(c)
                      for c in columns]).first()
    return {c: (row[c]["m"], row[c]["s"] or 1.0) for c in columns}


def apply_scaling(df: DataFrame, scaling: Scaling) -> DataFrame:
    """M2: subtract the mean, divide by the deviation."""
    return df.withColumns({c: (F.col(c) - F.lit(m).cast("double")) / F.lit(s) for c, (m, s) in scaling.items()})


def save_preprocessing(spark: SparkSession, path: str, encoding: Encoding, scaling: Scaling) -> None:
    """The fitted parameters as two small tables under ``path``."""
    spark.createDataFrame([(i, c, v) for i, (c, v) in enumerate(encoding)],
                          "position int, column string, category string").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/encoding")
    spark.createDataFrame([(i, c, m, s) for i, (c, (m, s)) in enumerate(scaling.items())],
                          "position int, column string, mean double, deviation double").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/scaling")


def load_preprocessing(spark: SparkSession, path: str) -> tuple[Encoding, Scaling]:
    """What :func:`save_preprocessing` wrote."""
    encoding = spark.read.parquet(f"{path}/encoding").orderBy("position").collect()
    scaling = spark.read.parquet(f"{path}/scaling").orderBy("position").collect()
    return ([(r["column"], r["category"]) for r in encoding],
            {r["column"]: (r["mean"], r["deviation"]) for r in scaling})
